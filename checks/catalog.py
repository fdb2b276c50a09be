"""Every operator as a query on the sample tables, next to the same in SQL for DuckDB."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import roles
from checks.session import own_folder
from rovelog.functions.timeops import EASTERN, to_zone
from rovelog.operators import asof, dwell, events, lookback, reinduct, rules, sites, stale
from rovelog.operators.failures import FailedSites
from rovelog.operators.keyed import COPIES
from rovelog.operators.places import in_order
from rovelog.operators.timeline import cell_of
from rovelog.plans.compliance import COLUMNS, DISCONNECT_TOTALS, Settings, compliance, in_service
from rovelog.sources.kept import refresh, totals
from rovelog.sources.sinks import publish, published, shared_folder, write_report
from rovelog.sources.tables import SCHEMAS, load_fleet, read_site_removals

AS_OF = "2024-01-30 00:00:00"
AS_OF_DAY = date(2024, 1, 30)
DAYS = 13
HOURS = lambda n: timedelta(hours=n)
KEYS = ["site_id", "bot_id"]

# The sample events are sparse, so the periods are longer than in the report.
WIDE = Settings(
    gap_minutes=1440,
    health=HOURS(12),
    disconnect=HOURS(72),
    thresholds=(lookback.Threshold("Flicker", 8), lookback.Threshold("Disconnect", 5, 100)),
    red_flag=HOURS(36),
    stale=HOURS(72),
    stale_minutes=1440,
    min_wrangles=2,
    min_suspects=2,
)


def removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = events.recent_events(roles.removals(spark, sf_dir), "timestamp", AS_OF, DAYS, action="Removed")
    return recent.select("site_id", F.col("botnumber").alias("bot_id"), F.col("timestamp").alias("event_ts"))


def recent_events(spark, sf_dir):
    return events.recent_events(roles.removals(spark, sf_dir), "timestamp", AS_OF, DAYS, action="Removed")


def flag_new_events(spark, sf_dir):
    return events.flag_new_events(removed(spark, sf_dir), KEYS, "event_ts", 30)


def flag_new_events_day(spark, sf_dir):
    return events.flag_new_events(removed(spark, sf_dir), KEYS, "event_ts", 1440)


def session_total(spark, sf_dir):
    flagged = events.flag_new_events(removed(spark, sf_dir), KEYS, "event_ts", 1440)
    return events.session_total(flagged, KEYS, "event_ts").drop("prev_ts")


def lookback_flags(spark, sf_dir):
    flags = {n: F.col(n) == 1 for n in ("case_handling_disabled", "system_flagged", "drive_system_not_ok")}
    return lookback.lookback_flags(
        removed(spark, sf_dir), roles.bot_health(spark, sf_dir), ["bot_id"], "event_ts", "timestamp",
        HOURS(12), flags, EASTERN,
    )


def latest_nonblank(spark, sf_dir):
    return lookback.latest_in_lookback(
        removed(spark, sf_dir), roles.bot_health(spark, sf_dir), ["bot_id"], "event_ts", "timestamp",
        HOURS(12), ["bot_state", "health_state", "safety_reason"], lookback.non_blank("safety_reason"), EASTERN,
    )


def latest_in_lookback(spark, sf_dir):
    return lookback.latest_in_lookback(
        removed(spark, sf_dir), roles.bot_health(spark, sf_dir), ["bot_id"], "event_ts", "timestamp",
        HOURS(12), ["bot_state", "health_state"], zone=EASTERN,
    )


def errors(spark, sf_dir):
    found = rules.classified_errors(roles.bot_errors(spark, sf_dir), AS_OF)
    short = sites.short_site_codes(found, roles.sites(spark, sf_dir), cell_of(F.col("datetime")))
    return short.select("site_id", "bot_id", "datetime", "error_ts", "error_category")


def bounded_counts(spark, sf_dir):
    counts = {name: lookback.Count(kind, period) for name, kind, period in WIDE.counts}
    return lookback.bounded_counts(
        removed(spark, sf_dir), errors(spark, sf_dir), KEYS, "event_ts", "error_ts", "error_category", counts, "datetime"
    )


def disconnect_issue(spark, sf_dir):
    lost = roles.bot_disconnect(spark, sf_dir).where(
        "connect_operational_status = 'Operating' and lost_operational_status = 'Operating'"
    )
    lost = lost.withColumnsRenamed(
        {"Bot Id": "bot_id", "Site Id": "site_id", "Disconnect Type": "kind",
         "Disconnect Duration": "duration", "Lost Time": "lost"}
    )
    return lookback.disconnect_issue(
        removed(spark, sf_dir), lost, KEYS, "event_ts", "kind", "duration", "lost", WIDE.thresholds, HOURS(72)
    )


def kept_disconnects(spark, sf_dir):
    """The same from totals kept by day: of the first days, then of all, then with late rows for an old day."""
    own_folder(spark)
    path = shared_folder(spark)
    rows = in_service(roles.bot_disconnect(spark, sf_dir)).withColumn("day", F.to_date("lost"))
    late = (F.dayofmonth("day") == 3) & (F.xxhash64("bot_id") % 2 == 0)
    arrived = [F.col("day") < F.lit(date(2024, 1, 15)), F.col("day") >= F.lit(date(2024, 1, 15)), late]
    for turn, part in enumerate(arrived):
        fresh = rows.where(part if turn == 2 else part & ~late)
        fresh.write.mode("append").partitionBy("day").parquet(f"{path}/lost")
        refresh(spark.read.parquet(f"{path}/lost"), f"{path}/lost", f"{path}/kept", DISCONNECT_TOTALS)
    last = lookback.past_thresholds(totals(spark, f"{path}/kept", DISCONNECT_TOTALS), KEYS, "kind", WIDE.thresholds)
    return lookback.flag_if_hit(removed(spark, sf_dir), last, KEYS, "event_ts", "last_lost_time", HOURS(72), "has_disconnect_issue")


def red_flags(spark, sf_dir):
    recs = roles.bot_recs(spark, sf_dir).withColumn("flagged_at", to_zone(F.col("last_updated")))
    return rules.pattern_hits(recs, "issue_classifications", rules.RED_FLAG_PATTERNS, ["bot_id", "flagged_at"])


def pattern_hits(spark, sf_dir):
    docs = roles.table(spark, sf_dir, "documents")
    return rules.pattern_hits(docs, "text", ("%the on%", "%le la%"), ["doc_id", "lang"])


def flag_if_hit(spark, sf_dir):
    return lookback.flag_if_hit(
        removed(spark, sf_dir), red_flags(spark, sf_dir), ["bot_id"], "event_ts", "flagged_at", HOURS(36), "red_flag"
    )


def stale_group(spark, sf_dir):
    return stale.stale_group(
        removed(spark, sf_dir), roles.diagnostic_message(spark, sf_dir), ["bot_id"], "event_ts", "datetime",
        "casegroupid", HOURS(72), 1440,
    )


def asof_join(spark, sf_dir):
    recs = roles.bot_recs(spark, sf_dir)
    recs = sites.short_site_codes(recs, roles.sites(spark, sf_dir), cell_of(F.col("last_updated")))
    return asof.asof_join(
        removed(spark, sf_dir), recs, KEYS, "event_ts", "last_updated", ["pull_score", "tcts_daily_avg"], zone=EASTERN
    )


def asof_join_one(spark, sf_dir):
    recs = roles.bot_recs(spark, sf_dir)
    recs = sites.short_site_codes(recs, roles.sites(spark, sf_dir), cell_of(F.col("last_updated")))
    return asof.asof_join(
        removed(spark, sf_dir), recs, KEYS, "event_ts", "last_updated", ["pull_score", "tcts_daily_avg"],
        zone=EASTERN, tie="one",
    )


def compliance_wide(spark, sf_dir):
    own_folder(spark)
    return compliance(roles.fleet(spark, sf_dir), AS_OF, DAYS, WIDE)


def compliance_report(spark, sf_dir):
    own_folder(spark)
    return compliance(roles.fleet(spark, sf_dir), AS_OF, DAYS)


def compliance_one_site(spark, sf_dir):
    own_folder(spark)
    return compliance(roles.fleet(spark, sf_dir), AS_OF, DAYS, WIDE, sites=["NATION_7"])


def verdict_counts(spark, sf_dir):
    own_folder(spark)
    rows = compliance(roles.fleet(spark, sf_dir), AS_OF, DAYS, WIDE, ordered=False)
    return rows.groupBy("valid_removal", "valid_removal_reason").agg(F.count(F.lit(1)).alias("removals"))


def daily_snapshot(spark, sf_dir):
    return dwell.daily_snapshot(roles.bot_health(spark, sf_dir))


def dwell_days(spark, sf_dir):
    return dwell.dwell_days(dwell.daily_snapshot(roles.bot_health(spark, sf_dir))).select(
        "environment", "bot_id", "event_date", "dwell_days"
    )


def dwell_summary(spark, sf_dir):
    return dwell.dwell_summary(roles.bot_health(spark, sf_dir), AS_OF_DAY, DAYS)


def weekly_reinduct(spark, sf_dir):
    return reinduct.weekly_reinduct(roles.removals(spark, sf_dir), AS_OF_DAY, DAYS)


def all_sites(spark, sf_dir):
    """The removals of each region as a table of its own, tagged and put together again."""
    nations = roles.table(spark, sf_dir, "nation").join(
        roles.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    region = nations.select(F.col("n_name").alias("site_id"), F.col("r_name").alias("region"))
    rows = roles.removals(spark, sf_dir).join(region, "site_id")
    names = [row["region"] for row in region.select("region").distinct().collect()]  # of the dimension
    per_region = {n: rows.where(F.col("region") == n).select("botnumber", "timestamp", "action") for n in names}
    return reinduct.weekly_reinduct(sites.union_sites(per_region), AS_OF_DAY, DAYS)


def site_report(spark, sf_dir):
    recent = events.recent_events(roles.removals(spark, sf_dir), "timestamp", AS_OF, DAYS, action="Removed")
    return sites.site_report(roles.sites(spark, sf_dir), recent)


def to_site_local(spark, sf_dir):
    rows = roles.removals(spark, sf_dir)
    return sites.to_site_local(rows, "timestamp", roles.sites(spark, sf_dir), cell_of(F.col("timestamp")))


def classify(spark, sf_dir):
    return errors(spark, sf_dir)


def _written(spark, sf_dir):
    """Writes the report, one folder per site, and the dwell summary; the path."""
    own_folder(spark)
    path = shared_folder(spark)
    tables = roles.fleet(spark, sf_dir)
    write_report(
        compliance(tables, AS_OF, DAYS, WIDE, ordered=False),
        dwell.dwell_summary(tables.bot_health, AS_OF_DAY, DAYS, ordered=False),
        path,
    )
    return path


def write_by_site(spark, sf_dir):
    """All rows of the report as read back from its folders."""
    return spark.read.parquet(f"{_written(spark, sf_dir)}/compliance").select(*COLUMNS)


def published_report(spark, sf_dir):
    """The report as read back after one site was run again and put in its place."""
    own_folder(spark)
    path, tables = shared_folder(spark), roles.fleet(spark, sf_dir)
    publish(compliance(tables, AS_OF, DAYS, WIDE, ordered=False), dwell.dwell_summary(tables.bot_health, AS_OF_DAY, DAYS, ordered=False), path)
    publish(compliance(tables, AS_OF, DAYS, WIDE, sites=["NATION_7"], ordered=False), None, path, sites=["NATION_7"])
    return published(spark, path)[0].select(*COLUMNS)


def failed_sites(spark, sf_dir):
    """The sites that a strict report leaves out, with the reasons, and the rows of those that go on."""
    own_folder(spark)
    failed = FailedSites()
    report = compliance(roles.fleet(spark, sf_dir), AS_OF, DAYS, replace(WIDE, strict_levels=True), ordered=False, failed=failed)
    told = failed.table(spark)
    others = report.groupBy("site_id").agg(F.count(F.lit(1)).alias("rows"))
    return told.unionByName(others.select("site_id", F.lit("report").alias("source"), F.lit(None).cast("string").alias("reason"), "rows"))


def write_dwell(spark, sf_dir):
    """The dwell summary as read back."""
    return spark.read.parquet(f"{_written(spark, sf_dir)}/dwell")


def ordered_report(spark, sf_dir):
    return in_order(compliance_wide(spark, sf_dir).select("removed_timestamp_est", "site_id", "botnumber"))


def ordered_dwell(spark, sf_dir):
    own_folder(spark)
    return in_order(dwell_summary(spark, sf_dir).select("event_date"))


def ordered_reinduct(spark, sf_dir):
    own_folder(spark)
    return in_order(weekly_reinduct(spark, sf_dir).select("week_start", "botnumber"))


def site_folders(spark, sf_dir):
    """The removals written as one folder a site, as a fleet keeps them, and read back in one scan."""
    own_folder(spark)
    path = shared_folder(spark)
    rows = roles.removals(spark, sf_dir).where(F.col("site_id").isNotNull())
    rows.withColumn("site", F.col("site_id")).drop("site_id").write.partitionBy("site").parquet(path)
    return read_site_removals(spark, f"{path}/site={{site}}")


def loaded_report(spark, sf_dir):
    """The report over a fleet that is read from files."""
    own_folder(spark)
    path, tables = shared_folder(spark), roles.fleet(spark, sf_dir)
    for name in SCHEMAS:
        getattr(tables, name).write.parquet(f"{path}/{name}")
    rows = compliance(load_fleet(spark, path), AS_OF, DAYS, WIDE, ordered=False)
    return rows.groupBy("site_id", "valid_removal_reason").agg(F.count(F.lit(1)).alias("removals"))


QUERIES = {
    f.__name__: f
    for f in (
        recent_events, flag_new_events, flag_new_events_day, session_total, lookback_flags, latest_nonblank,
        latest_in_lookback, classify, bounded_counts, disconnect_issue, red_flags, pattern_hits, flag_if_hit,
        stale_group, asof_join, asof_join_one, compliance_wide, compliance_report, compliance_one_site,
        verdict_counts, daily_snapshot, dwell_days, dwell_summary, weekly_reinduct, all_sites, site_report,
        to_site_local, write_by_site, write_dwell, ordered_report, ordered_dwell, ordered_reinduct,
        site_folders, loaded_report, kept_disconnects, published_report, failed_sites,
    )
}
