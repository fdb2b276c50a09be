"""What the plans must look like to hold at scale."""

import random
from datetime import date, timedelta
from pathlib import Path

import pytest
from conftest import SITES, frame, t
from pyspark.sql import functions as F

from rovelog.operators import lookback as L
from rovelog.operators import timeline
from rovelog.operators.dwell import dwell_summary
from rovelog.operators.rules import RED_FLAG_PATTERNS, pattern_hits
from rovelog.plans.compliance import Settings, compliance, disconnect_feature
from rovelog.sources.sinks import shared_folder
from rovelog.sources.tables import SCHEMAS, load_fleet


@pytest.fixture(scope="module")
def tables(spark):
    base = shared_folder(spark)
    rng = random.Random(5)

    def at():
        return t("10 00:00") + timedelta(minutes=rng.randrange(1440))

    data = {
        "sites": SITES,
        "removals": [{"site_id": "NO", "botnumber": i % 7, "timestamp": at(), "action": "Removed"} for i in range(60)],
        "bot_health": [{"bot_id": i % 7, "timestamp": at(), "safety_reason": "x"} for i in range(200)],
    }
    for name in SCHEMAS:
        frame(spark, name, data.get(name, ())).write.parquet(f"{base}/{name}")
    return load_fleet(spark, base)


def explained(df) -> str:
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def scans(plan: str, table: str) -> list[str]:
    blocks = plan.split("\n\n")
    return [b for b in blocks if "Scan parquet" in b and f"/{table}]" in b.replace("\n", " ")]


def test_no_nested_loops_or_cross_products(tables):
    plan = explained(compliance(tables, "2024-01-15 12:00:00"))
    assert "CartesianProduct" not in plan
    assert "NestedLoop" not in plan


def test_health_scan_is_bounded_and_pruned(tables):
    found = scans(explained(compliance(tables, "2024-01-15 12:00:00")), "bot_health")
    assert found
    for scan in found:
        assert "GreaterThanOrEqual(timestamp,2024-01-02T11:00" in scan
        assert "environment" not in scan and "bot_location_changed" not in scan


def test_error_and_message_scans_are_bounded(tables, monkeypatch):
    monkeypatch.setattr("rovelog.plans.compliance.written", lambda df: df)
    plan = explained(compliance(tables, "2024-01-15 12:00:00", settings=Settings(error_days=10)))
    assert scans(plan, "bot_errors")
    assert all("GreaterThan(datetime,2024-01-05T16:00" in s for s in scans(plan, "bot_errors"))
    assert all("GreaterThanOrEqual(datetime,2024-01-02T10:00" in s for s in scans(plan, "diagnostic_message"))


def test_upper_bounds_only_with_until(tables):
    open_end = explained(compliance(tables, "2024-01-15 12:00:00"))
    assert not any("LessThan" in s for s in scans(open_end, "bot_health"))
    closed = explained(compliance(tables, "2024-01-15 12:00:00", until="2024-01-15 12:00:00"))
    assert all("LessThanOrEqual(timestamp,2024-01-15T18:00" in s for s in scans(closed, "bot_health"))


def test_telemetry_is_read_once(spark, tables):
    """The combined rows feed both the state before a cell and the rows in it."""
    events = tables.removals.select(F.col("botnumber").alias("bot_id"), F.col("timestamp").alias("event_ts"))
    found = L.lookback_flags(
        events, tables.bot_health, ["bot_id"], "event_ts", "timestamp", timedelta(hours=1),
        {"system_flagged": F.col("system_flagged") == 1}, "America/New_York",
    )
    found.collect()
    final = found._jdf.queryExecution().executedPlan().toString()
    ran = final.split("== Initial Plan ==")[0]
    assert len([line for line in ran.split("\n") if "FileScan" in line and "system_flagged" in line]) == 1
    assert "ReusedExchange" in ran


def test_window_passes_work_on_cells_not_on_whole_keys(tables):
    """Only the short lists (one row per key and cell) are brought together by key alone."""
    plan = explained(compliance(tables, "2024-01-15 12:00:00"))
    windows = [b for b in plan.split("\n\n") if "] Window" in b or ") Window" in b.split("\n")[0]]
    assert windows
    for w in windows:
        spec = [line for line in w.split("\n") if line.startswith("Arguments:")][0]
        # _sum: totals per key and cell
        assert "_cell" in spec or "_minute" in spec or "sum(_sum" in spec, spec


def test_the_list_of_a_key_follows_the_period_not_its_history(spark):
    """200,000 old rows of one key reach the window by key as one row, and rows after the last event not at all."""
    first, last = 5_000 * timeline.CELL, 5_010 * timeline.CELL
    old = spark.range(200_000).select((F.col("id") % 4_990 * timeline.CELL).alias("_cell"), F.col("id").alias("v"))
    late = spark.range(500).select((F.col("id") * timeline.CELL + last).alias("_cell"), F.col("id").alias("v"))
    rows = old.union(late).withColumn("k", F.lit(1))
    track = timeline.Track(rows, F.lit(None), latest={"v": F.col("v")})
    found = timeline._history(rows, track, ["k"], first, last).collect()
    assert [(r["_cell"], r["v"]) for r in found if r["_cell"] < first] == [(first - timeline.CELL, 199_999)]
    assert len(found) <= (last - first) // timeline.CELL + 2


def test_sites_reach_every_scan_that_knows_its_site(tables, monkeypatch):
    monkeypatch.setattr("rovelog.plans.compliance.written", lambda df: df)
    plan = explained(compliance(tables, "2024-01-15 12:00:00", sites=["NO"]))
    assert scans(plan, "bot_errors") and all("north-one" in s for s in scans(plan, "bot_errors"))
    assert any("north-one" in s for s in scans(plan, "bot_recs"))
    assert scans(plan, "bot_disconnect") and all("Site Id" in s and "NO" in s for s in scans(plan, "bot_disconnect"))
    assert not any("north-one" in s for s in scans(explained(compliance(tables, "2024-01-15 12:00:00")), "bot_errors"))


def test_dwell_reads_the_snapshot_minutes_and_disconnects_their_kinds(spark, tables):
    plan = explained(dwell_summary(tables.bot_health, date(2024, 1, 10), 2))
    for day in ("08", "09", "10"):
        assert any(f"2024-01-{day}T23:05" in s and f"2024-01-{day}T23:56" in s for s in scans(plan, "bot_health"))
    lost = tables.bot_disconnect.select(
        F.col("Bot Id").alias("bot_id"), F.col("Disconnect Type").alias("kind"), F.col("Disconnect Duration").alias("duration"),
        F.col("Lost Time").alias("lost"),
    )
    plan = explained(L.disconnect_last_times(lost, ["bot_id"], "kind", "duration", "lost", [L.Threshold("Flicker", 5)]))
    assert any("Flicker" in s.split("PushedFilters")[-1] for s in scans(plan, "bot_disconnect"))


def test_many_cells_shuffle_telemetry_once(spark, tables, monkeypatch):
    monkeypatch.setattr(timeline, "BROADCAST_ROWS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = tables.removals.select(F.col("botnumber").alias("bot_id"), F.col("timestamp").alias("event_ts"))
        health = tables.bot_health.select("bot_id", "timestamp", "system_flagged")
        track = timeline.Track(
            health, F.col("timestamp"), latest={"f": F.col("system_flagged")}, reach=timeline.Reach(F.col("timestamp"), timedelta(hours=1))
        )
        cells = events.select("bot_id", timeline.cell_of(F.col("event_ts")).alias("_cell")).distinct()
        rows = timeline._positioned(track, ["bot_id"])
        by = ["bot_id", "_cell", "_at", "_side"]
        seen = timeline.within_reach(rows, lambda r: timeline._combined(r, track, by), cells, ["bot_id"], track.reach, False)
        tree = explained(seen).split("\n\n")[0]
        scan = next(i for i, line in enumerate(tree.split("\n")) if "Scan parquet" in line)
        above = tree.split("\n")[:scan]
        assert "SortAggregate" not in tree
        # one exchange between the scan of telemetry and the result; the other side has its own
        left = [line for line in above if "Exchange" in line]
        assert len(left) <= 1, tree
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_last_plan_is_no_larger_than_it_must_be(tables):
    """The driver plans every copy of a source, so the report reads each once, or from a step."""
    report = compliance(tables, "2024-01-15 12:00:00")
    plan = report._jdf.queryExecution().analyzed().toString()
    assert sum(") AS _event#" in line for line in plan.split("\n")) == 1
    assert "diagnostic" not in "".join(scans(explained(report), "diagnostic_message"))


def test_no_step_looks_back_over_all_sources(tables, monkeypatch):
    """What the driver holds of a plan grows with the sources that are looked back over in it."""
    plans, kept = [], compliance.__globals__["written"]

    def noted(df):
        plans.append(explained(df))
        return kept(df)

    monkeypatch.setattr("rovelog.plans.compliance.written", noted)
    plans.append(explained(compliance(tables, "2024-01-15 12:00:00")))
    over = [[t for t in ("bot_recs", "bot_errors", "bot_disconnect", "diagnostic_message", "bot_health") if scans(p, t)] for p in plans]
    assert all(len(found) <= 2 for found in over), over
    assert sorted({t for found in over for t in found}) == ["bot_disconnect", "bot_errors", "bot_health", "bot_recs", "diagnostic_message"]
    assert not any({"bot_recs", "bot_errors"} <= set(found) or {"bot_recs", "bot_health"} <= set(found) for found in over), over


def test_a_filter_goes_out_in_few_rows(spark, monkeypatch):
    """Filters of all sources are in the driver at a time; one row for each 64 bits took 40 bytes."""
    monkeypatch.setattr(timeline, "FILTER_BITS", 1 << 16)
    source, wanted = spark.range(10), spark.range(100_000)
    found = timeline.thinned(source, wanted, ["id"])
    assert found.count() == 10
    (bits,) = [n for n in _nodes(found._jdf.queryExecution().analyzed()) if n.nodeName() == "Aggregate"]
    names = [bits.output().apply(i).name() for i in range(bits.output().size())]
    assert names == ["_row", "_bits"] and timeline.FILTER_BITS // 64 // timeline.FILTER_WORDS == 64


def _nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from _nodes(plan.children().apply(i))


def test_patterns_are_not_lowered_by_the_driver(spark):
    """Spark lowers a literal with tables of all characters, built while it plans."""
    df = spark.createDataFrame([("A pOWER fault_x",), ("other",), ("Größe ÄB",)], "x string")
    plan = pattern_hits(df, "x", RED_FLAG_PATTERNS, ["x"])._jdf.queryExecution().analyzed().toString()
    assert "lower(x" in plan and "ilike" not in plan.lower()
    assert [r["x"] for r in pattern_hits(df, "x", ("%Power FAULT\\_X%", "%äb"), ["x"]).orderBy("x").collect()] == ["A pOWER fault_x", "Größe ÄB"]


@pytest.mark.parametrize("broadcast_rows", [0, timeline.BROADCAST_ROWS])
def test_the_cells_of_the_removals_are_found_once_a_report(tables, monkeypatch, broadcast_rows):
    """Each lookback found them again, up to five times a plan; now they are two steps."""
    plans, kept = [], compliance.__globals__["written"]

    def noted(df):
        plans.append((df.columns, explained(df)))
        return kept(df)

    monkeypatch.setattr("rovelog.plans.compliance.written", noted)
    report = compliance(tables, "2024-01-15 12:00:00", settings=Settings(broadcast_rows=broadcast_rows))
    assert [c for c, _ in plans if c[-1] == "_cell"] == [["site_id", "bot_id", "_cell"], ["bot_id", "_cell"]]
    times = "ReadSchema: struct<bot_id:bigint,event_ts:timestamp_ntz>"
    assert not any(times in s for s in explained(report).split("\n\n"))
    looked = [p for c, p in plans if "has_disconnect_issue" in c and "removal_sessions" not in c]
    assert looked and not any("struct<site_id:string,bot_id:bigint,event_ts:timestamp_ntz>" in p for p in looked)


def test_rows_of_an_aggregate_go_without_a_filter(tables):
    """Disconnects come as a row for each machine and type: a filter to thin them out cost more than their shuffle."""
    tracks = disconnect_feature(tables.bot_disconnect, Settings()).tracks
    assert [t.grouped for t in tracks] == [True]
    events = tables.removals.select("site_id", F.col("botnumber").alias("bot_id"), F.col("timestamp").alias("event_ts"))
    keys = ["site_id", "bot_id"]
    plan = timeline.enrich(events, keys, "event_ts", [disconnect_feature(tables.bot_disconnect, Settings())], few=False)
    assert "getbit" not in plan._jdf.queryExecution().analyzed().toString()


def test_steps_that_nothing_reads_are_removed(tables, monkeypatch):
    made, kept = [], compliance.__globals__["written"]

    def noted(df):
        made.append(kept(df))
        return made[-1]

    monkeypatch.setattr("rovelog.plans.compliance.written", noted)
    report = compliance(tables, "2024-01-15 12:00:00")
    gone = [df.columns for df in made if not Path(df.inputFiles()[0].removeprefix("file://").removeprefix("file:")).exists()]
    assert gone == [["site_id", "bot_id", "_cell"], ["bot_id", "event_ts", "stale_group"]]
    assert report.count() == 60
