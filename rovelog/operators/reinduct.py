"""Do machines that come back into service stay there for the week?"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rovelog.functions.timeops import wall, week_start


def weekly_reinduct(removals: DataFrame, as_of: date, days: int, ordered: bool = True) -> DataFrame:
    """Per site, machine and week: adds, removals, first add, last removal, pass or fail.

    Fail means that the last removal came after the first add of that week.
    """
    ts = F.col("timestamp")

    def when_action(action: str, value: Column) -> Column:
        return F.when(F.col("action") == action, value)

    weeks = (
        removals.where((ts >= wall(as_of - timedelta(days=days))) & (ts < wall(as_of + timedelta(days=1))))
        .groupBy("site_id", "botnumber", week_start(ts).alias("week_start"))
        .agg(
            F.count(when_action("Added", F.lit(1))).alias("inductions_per_week"),
            F.count(when_action("Removed", F.lit(1))).alias("removals_per_week"),
            F.min(when_action("Added", ts)).alias("first_induction_time"),
            F.max(when_action("Removed", ts)).alias("last_removal_time"),
        )
        .withColumn(
            "pass_fail",
            F.when(F.col("last_removal_time") > F.col("first_induction_time"), "Fail").otherwise("Pass"),
        )
    )
    if not ordered:
        return weeks
    return weeks.orderBy(F.col("week_start").desc_nulls_first(), F.col("botnumber").asc_nulls_last())
