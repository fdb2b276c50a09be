"""Site dimension: per-site inputs as one frame, row counts per site, local times."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rovelog.functions.timeops import to_zone
from rovelog.operators.keyed import lookup


def union_sites(per_site: Mapping[str, DataFrame], site: str = "site_id") -> DataFrame:
    """One frame from one table per site, each row tagged with its short site code."""
    tagged = [df.withColumn(site, F.lit(code)) for code, df in per_site.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def short_site_codes(
    df: DataFrame, sites: DataFrame, spread: Column, full: str = "site_id", small: bool | None = None
) -> DataFrame:
    """Replace full site names by short codes; rows of unknown sites are left out."""
    names = sites.select(F.col("site_full").alias("_full"), F.col("site_short").alias("_short"))
    found = lookup(df.withColumn("_full", F.col(full)), names, ["_full"], spread, "inner", small)
    return found.withColumn(full, F.col("_short")).drop("_full", "_short")


def site_report(sites: DataFrame, result: DataFrame, site: str = "site_id") -> DataFrame:
    """Rows per site, 0 for sites without any."""
    counts = result.groupBy(site).agg(F.count(F.lit(1)).alias("rows"))
    report = sites.join(counts, sites["site_short"] == counts[site], "left")
    return report.select(
        "site_full", "site_short", F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows")
    )


def to_site_local(
    df: DataFrame, ts: str, sites: DataFrame, spread: Column, site: str = "site_id", name: str = "site_local_ts"
) -> DataFrame:
    """Adds the UTC time ``ts`` on the clock of the row's site (null for unknown sites)."""
    zones = sites.select(F.col("site_short").alias(site), "tz")
    found = lookup(df, zones, [site], spread)
    return found.withColumn(name, to_zone(F.col(ts), F.col("tz"))).drop("tz")
