"""Wall-clock time expressions that do not depend on the session time zone.

Every timestamp in this package is TIMESTAMP_NTZ.  ``date_trunc``,
``timestampdiff`` and ``date_format`` push NTZ values through the session zone
and shift the hour skipped in spring, so none of them is used here.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

EASTERN = "America/New_York"
# Eastern wall clocks are this much behind UTC
EASTERN_BEHIND = (timedelta(hours=4), timedelta(hours=5))

_EPOCH = "1970-01-01 00:00:00"


def wall(moment: datetime | date | str) -> Column:
    """A literal TIMESTAMP_NTZ."""
    if isinstance(moment, datetime):
        moment = moment.isoformat(sep=" ")
    elif isinstance(moment, date):
        moment = f"{moment.isoformat()} 00:00:00"
    return F.to_timestamp_ntz(F.lit(moment))


def span(length: timedelta) -> Column:
    return F.lit(length)


def seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 00:00 on the same wall clock, as bigint."""
    return (ts - wall(_EPOCH)).cast("bigint")


def micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 on the same wall clock, as bigint."""
    return ((ts - wall(_EPOCH)).cast("decimal(20,6)") * 1_000_000).cast("bigint")


def from_micros(us: Column) -> Column:
    return wall(_EPOCH) + F.make_dt_interval(secs=(us.cast("decimal(26,0)") / 1_000_000).cast("decimal(18,6)"))


def mirrored(ts: Column) -> Column:
    """The time as far on the other side of 1970: later times come first."""
    return wall(_EPOCH) - (ts - wall(_EPOCH))


def floor_to(number: Column, width: int) -> Column:
    """Start of the ``width`` wide cell that holds the number; floors below zero too."""
    return number - F.pmod(number, F.lit(width).cast("bigint"))


def minute_number(ts: Column) -> Column:
    return F.datediff(ts, F.lit("1970-01-01")).cast("bigint") * 1440 + F.hour(ts) * 60 + F.minute(ts)


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from ``start`` to ``end`` (10:00:59 to 10:01:00 is 1)."""
    return minute_number(end) - minute_number(start)


def day_start(ts: Column) -> Column:
    return F.to_date(ts).cast("timestamp_ntz")


def week_start(ts: Column) -> Column:
    """Monday 00:00 of the week."""
    return F.trunc(F.to_date(ts), "week").cast("timestamp_ntz")


def second_text(ts: Column) -> Column:
    """``2024-01-31 09:08:07``, without the fraction."""
    return F.substring(ts.cast("string"), 1, 19)


def to_zone(ts: Column, zone: Column | str = EASTERN, source: str = "UTC") -> Column:
    zone = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(F.lit(source), zone, ts.cast("timestamp_ntz"))


def in_repeated_hour(raw: Column, local: Column, zone: str = EASTERN, source: str = "UTC") -> Column:
    """True for the second pass through the hour that the clock repeats in autumn.

    Going back from ``local`` always lands in the first pass, so only second-pass
    rows come back different.  Within either pass local time rises with raw time.
    """
    return F.convert_timezone(F.lit(zone), F.lit(source), local) != raw
