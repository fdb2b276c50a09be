"""Choosing events, and telling new events from repeats of the last one."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rovelog.functions.timeops import minutes_between, span, wall
from rovelog.operators.keyed import COPIES, collapse, expand, key_total
from rovelog.operators.timeline import Feature, Track, cell_of, enrich


def recent_events(
    df: DataFrame,
    ts: str,
    as_of: datetime | str,
    days: int,
    *,
    action: str | None = None,
    action_col: str = "action",
    until: datetime | str | None = None,
) -> DataFrame:
    """Rows of one action from ``days`` days before ``as_of`` on; no upper bound unless ``until``."""
    keep = F.col(ts) >= wall(as_of) - span(timedelta(days=days))
    if action is not None:
        keep = keep & (F.col(action_col) == action)
    if until is not None:
        keep = keep & (F.col(ts) <= wall(until))
    return df.where(keep)


def event_times(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per key and time, with ``copies`` saying how many rows it stands for."""
    return collapse(df, columns)


def previous_event(events: DataFrame, ts: str, name: str = "prev_ts") -> Feature:
    """Time of the previous event of the key, among events at other times."""
    track = Track(
        events, F.col(ts), latest={name: F.col(ts)}, after=F.lit(True), whole=True, null_keys=True
    )
    return Feature([track], {name: F.col(name)})


def is_new(prev: str, ts: str, gap_minutes: int) -> Column:
    """1 for no previous event or a gap of at least that many minute boundaries."""
    gap = minutes_between(F.col(prev), F.col(ts))
    return F.when(F.col(prev).isNull() | (gap >= gap_minutes), 1).otherwise(0)


def flag_new_events(df: DataFrame, keys: Sequence[str], ts: str, gap_minutes: int = 30) -> DataFrame:
    """Per row of ``df``: keys, time, previous event time and ``is_new_event``.

    The previous *event* counts, not the previous *new* event, so a chain of close
    events is one session.  Of several events at the same time one is compared with
    the time before; the others have a gap of 0.
    """
    times = event_times(df, [*keys, ts])
    rows = expand(enrich(times, keys, ts, [previous_event(times, ts)]))
    first = F.col("copy_number") == 1
    rows = rows.withColumn("prev_ts", F.when(first, F.col("prev_ts")).otherwise(F.col(ts)))
    return rows.withColumn(
        "is_new_event",
        is_new("prev_ts", ts, gap_minutes),
    ).drop("copy_number")


def session_total(
    df: DataFrame, keys: Sequence[str], ts: str, flag: str = "is_new_event", name: str = "removal_sessions"
) -> DataFrame:
    """Every row with the number of new events of its key."""
    value = F.col(flag) * F.col(COPIES) if COPIES in df.columns else F.col(flag)
    return key_total(df, keys, cell_of(F.col(ts)), value, name)
