"""Lookbacks: flags, latest states, counts and hits in a period before each event.

Periods include both ends.  A source in another zone is compared by its local
time; "latest" goes by its raw time, which matters in the hour that the clock
repeats in autumn.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rovelog.functions.timeops import EASTERN, EASTERN_BEHIND, in_repeated_hour, span, to_zone
from rovelog.operators.events import event_times
from rovelog.operators.keyed import COPIES
from rovelog.operators.timeline import Feature, Reach, Track, enrich
from rovelog.sources.kept import Totals

LOCAL = "_local"


@dataclass(frozen=True)
class Pick:
    """Columns to take from the latest row of the period for which ``where`` holds."""

    columns: Sequence[str]
    where: Column | None = None


@dataclass(frozen=True)
class Count:
    """Count rows of one category in the ``lookback`` before the event."""

    category: str
    lookback: timedelta


def non_blank(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def states_before(
    rows: DataFrame,
    ts: str,
    event_ts: str,
    lookback: timedelta,
    *,
    flags: dict[str, Column] | None = None,
    picks: dict[str, Pick] | None = None,
    zone: str | None = None,
    matched: str | None = None,
) -> Feature:
    """Flags and latest states of one source, all from the same pass.

    ``flags`` maps a name to a condition: 1 if it held on any row of the period.
    Each pick gives one struct column (null if no row).  ``matched`` names a column
    that is 1 if the period holds any row.
    """
    start = F.col(event_ts) - span(lookback)
    raw = F.col(ts)
    rows = rows.withColumn(LOCAL, to_zone(raw, zone) if zone else raw)
    local = F.col(LOCAL)
    # local time rises with raw time within each pass through the repeated hour,
    # so the last row of a pass up to the event is also the last one in the period
    passes = {"": None}
    if zone:
        rows = rows.withColumn("_is_second", in_repeated_hour(raw, local, zone))
        passes = {"": ~F.col("_is_second"), "_second": F.col("_is_second")}

    latest: dict[str, Column] = {}
    columns: dict[str, Column] = {}
    seen = {name: condition for name, condition in (flags or {}).items()}
    if matched:
        seen[matched] = F.lit(True)
    for name, condition in seen.items():
        latest[f"_seen_{name}"] = F.when(condition, local)
        columns[name] = F.when(F.col(f"_seen_{name}") >= start, 1).otherwise(0)
    for name, pick in (picks or {}).items():
        candidates = []
        for suffix, in_pass in passes.items():
            keep = [c for c in (pick.where, in_pass) if c is not None]
            value = F.struct(raw.alias("_raw"), *pick.columns)
            for condition in keep:
                value = F.when(condition, value)
            state = f"_pick_{name}{suffix}"
            latest[state] = value
            found = F.col(f"{state}._raw")
            candidates.append(F.when((to_zone(found, zone) if zone else found) >= start, F.col(state)))
        columns[name] = F.greatest(*candidates) if len(candidates) > 1 else candidates[0]
    return Feature([Track(rows, local, latest=latest, reach=_reach(raw, local, lookback, zone))], columns)


def _reach(raw: Column, local: Column, lookback: timedelta, zone: str | None) -> Reach:
    """Rows are dropped by raw time where the distance of the clocks is known."""
    return Reach(raw, lookback, EASTERN_BEHIND) if zone == EASTERN else Reach(local, lookback)


def counts_before(
    rows: DataFrame, ts: str, category: str, counts: dict[str, Count], raw: str | None = None
) -> Feature:
    """Rows per category in a period before the event, 0 if none.

    A row adds 1 at its own time and takes it away right after its period ends.
    ``raw`` names the UTC time from which an Eastern ``ts`` was made.
    """
    longest = max(spec.lookback for spec in counts.values())
    reach = Reach(F.col(raw), longest, EASTERN_BEHIND) if raw else Reach(F.col(ts), longest)
    entries = None
    for kind in sorted({spec.category for spec in counts.values()}):
        both = F.array(
            *[
                F.struct(
                    F.lit(name).alias("name"),
                    F.lit(spec.lookback if leaving else timedelta(0)).alias("delay"),
                    F.lit(-1 if leaving else 1).alias("step"),
                )
                for name, spec in counts.items()
                if spec.category == kind
                for leaving in (False, True)
            ]
        )
        holds = F.col(category) == kind
        entries = F.when(holds, both) if entries is None else entries.when(holds, both)
    moves = rows.withColumn("_entry", F.explode(entries))  # no entry, no row
    track = Track(
        moves,
        F.col(ts) + F.col("_entry.delay"),
        total={n: F.when(F.col("_entry.name") == n, F.col("_entry.step")).otherwise(0) for n in counts},
        after=F.col("_entry.step") < 0,
        reach=reach,
    )
    return Feature([track], {name: F.col(name).cast("bigint") for name in counts})


def seen_before(rows: DataFrame, ts: str, event_ts: str, lookback: timedelta, name: str, grouped: bool = False) -> Feature:
    """1 if any row lies in the period, else 0.  ``grouped`` is that of a Track."""
    state = f"_seen_{name}"
    hit = F.when(F.col(state) >= F.col(event_ts) - span(lookback), 1).otherwise(0)
    reach = Reach(F.col(ts), lookback)
    return Feature([Track(rows, F.col(ts), latest={state: F.col(ts)}, reach=reach, grouped=grouped)], {name: hit})


def lookback_flags(
    events: DataFrame,
    telemetry: DataFrame,
    keys: Sequence[str],
    ts: str,
    telemetry_ts: str,
    lookback: timedelta,
    flags: dict[str, Column],
    zone: str | None = None,
) -> DataFrame:
    """Per event with any telemetry in the period: 1 per flag that was ever up."""
    feature = states_before(
        telemetry, telemetry_ts, ts, lookback, flags=flags, zone=zone, matched="_matched"
    )
    found = enrich(event_times(events, [*keys, ts]), keys, ts, [feature])
    return found.where("_matched = 1").drop("_matched", COPIES)


def latest_in_lookback(
    events: DataFrame,
    telemetry: DataFrame,
    keys: Sequence[str],
    ts: str,
    telemetry_ts: str,
    lookback: timedelta,
    columns: Sequence[str],
    where: Column | None = None,
    zone: str | None = None,
) -> DataFrame:
    """Per event with such a row: ``columns`` of the latest row of the period.

    Rows with the same raw time are ranked by ``columns``, greatest first.
    """
    feature = states_before(
        telemetry, telemetry_ts, ts, lookback, picks={"_pick": Pick(columns, where)}, zone=zone
    )
    found = enrich(event_times(events, [*keys, ts]), keys, ts, [feature]).where(F.col("_pick").isNotNull())
    return found.select(*keys, ts, *[F.col(f"_pick.{c}").alias(c) for c in columns])


def bounded_counts(
    events: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    ts: str,
    rows_ts: str,
    category: str,
    counts: dict[str, Count],
    raw: str | None = None,
) -> DataFrame:
    """Per event time, rows per category in the period before it.

    An event that occurs n times counts each row n times, as a join would.
    """
    found = enrich(event_times(events, [*keys, ts]), keys, ts, [counts_before(rows, rows_ts, category, counts, raw)])
    return found.select(*keys, ts, *[(F.col(n) * F.col(COPIES)).alias(n) for n in counts])


def flag_if_hit(
    events: DataFrame,
    hits: DataFrame,
    keys: Sequence[str],
    ts: str,
    hits_ts: str,
    lookback: timedelta,
    name: str,
) -> DataFrame:
    """Per event time, 1 if a hit lies in the period before it, else 0."""
    times = event_times(events, [*keys, ts])
    return enrich(times, keys, ts, [seen_before(hits, hits_ts, ts, lookback, name)]).drop(COPIES)


@dataclass(frozen=True)
class Threshold:
    """A disconnect type that is an issue from this many events and this much duration on."""

    kind: str
    min_events: int
    min_duration: float | None = None


def disconnect_last_times(
    disconnects: DataFrame,
    keys: Sequence[str],
    kind: str,
    duration: str,
    lost: str,
    thresholds: Sequence[Threshold],
) -> DataFrame:
    """Last lost time per key and type, over all history, of the types past their threshold."""
    spec = disconnect_totals(keys, kind, duration, lost)
    kinds = sorted({t.kind for t in thresholds})
    return past_thresholds(spec.of(disconnects.where(F.col(kind).isin(kinds))), keys, kind, thresholds)


def disconnect_totals(keys: Sequence[str], kind: str, duration: str, lost: str) -> Totals:
    """What is to be known of all disconnects of a key and type; ``sources.kept`` keeps it by day."""
    return Totals([*keys, kind], {"_events": "1L", "_duration": f"`{duration}`"}, {"last_lost_time": f"`{lost}`"})


def past_thresholds(totals: DataFrame, keys: Sequence[str], kind: str, thresholds: Sequence[Threshold]) -> DataFrame:
    """Last lost time per key and type of the types past their threshold, from their totals."""
    past = F.lit(False)
    for t in thresholds:
        rule = (F.col(kind) == t.kind) & (F.col("_events") >= t.min_events)
        if t.min_duration is not None:
            rule = rule & (F.col("_duration") >= t.min_duration)
        past = past | rule
    return totals.where(past).select(*keys, "last_lost_time")


def disconnect_issue(
    events: DataFrame,
    disconnects: DataFrame,
    keys: Sequence[str],
    ts: str,
    kind: str,
    duration: str,
    lost: str,
    thresholds: Sequence[Threshold],
    lookback: timedelta,
    name: str = "has_disconnect_issue",
) -> DataFrame:
    """Per event time, 1 if a type past its threshold was last lost in the period before it."""
    last = disconnect_last_times(disconnects, keys, kind, duration, lost, thresholds)
    return flag_if_hit(events, last, keys, ts, "last_lost_time", lookback, name)
