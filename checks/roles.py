"""The sample tables in the roles of the fleet tables.

Machines are ``events.user_id``, sites are the 25 nations in turn, ``error`` events are
removals and ``signup`` events additions; the other events feed telemetry, errors,
disconnects, scores and messages.  States are derived from the number ``k`` in ``props``.
The SQL below says the same for the comparison in DuckDB.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rovelog.functions.timeops import day_start
from rovelog.sources.tables import FleetTables

ZONES = (
    "America/New_York",
    "America/Chicago",
    "America/Denver",
    "America/Phoenix",
    "America/Los_Angeles",
)


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = F.array(*[F.lit(z) for z in ZONES])
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("site-"), F.lower("n_name")).alias("site_full"),
        F.col("n_name").alias("site_short"),
        F.get(zones, F.col("n_nationkey") % len(ZONES)).alias("tz"),
    )


def events(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    """Events of some types, with ``k``."""
    df = table(spark, sf_dir, "events")
    if kinds:
        df = df.where(F.col("event_type").isin(*kinds))
    number = F.substring_index(F.substring_index("props", ": ", -1), "}", 1)  # of {"k": 69}
    return df.withColumn("k", number.cast("int"))


def placed(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    """Events with the short code of the site of their machine."""
    home = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("site"))
    return events(spark, sf_dir, *kinds).join(home, F.col("user_id") % 25 == F.col("n_nationkey"))


def removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One removal in 17 is there three times; one in 19 has no machine."""
    copies = F.when(F.col("k") % 17 == 0, 3).otherwise(1)
    rows = placed(spark, sf_dir, "error", "signup").withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    return rows.select(
        F.col("site").alias("site_id"),
        F.when(F.col("k") % 19 != 0, F.col("user_id")).alias("botnumber"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") == "error", "Removed").otherwise("Added").alias("action"),
    )


def bot_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return events(spark, sf_dir, "click", "view").select(
        F.concat(F.lit("env-"), F.col("user_id") % 3).alias("environment"),
        F.col("user_id").alias("bot_id"),
        F.col("ts").alias("timestamp"),
        (F.col("ts") - F.make_dt_interval(hours=k - 5)).alias("bot_location_changed"),
        F.when(k % 3 == 0, "Disabled").when(k % 3 == 1, "Operating").otherwise("Idle").alias("bot_state"),
        F.when(k % 10 == 0, "Unknown").when(k % 10 == 1, F.lit(None)).when(k % 2 == 0, "Healthy")
        .otherwise("Faulted").alias("health_state"),
        F.when(k % 4 == 0, F.lit(None)).when(k % 4 == 1, "")
        .otherwise(F.concat(F.lit("reason-"), (k % 7).cast("string"))).alias("safety_reason"),
        (k % 23 == 0).cast("int").alias("case_handling_disabled"),
        (k % 29 == 1).cast("int").alias("system_flagged"),
        (k % 5 == 2).cast("int").alias("drive_system_not_ok"),
    )


def bot_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, value = F.col("k"), F.col("value")
    return placed(spark, sf_dir, "purchase", "view", "click").select(
        F.col("user_id").alias("bot_id"),
        F.concat(F.lit("site-"), F.lower("site")).alias("site_id"),
        F.col("ts").alias("datetime"),
        F.when(k % 6 == 0, "alarm").when(k % 6 == 1, "Alarm").when(k % 6 == 2, "caseHandlingDisabled")
        .when(k % 6 == 3, "suspect").when(k % 6 == 4, "logFileWritten").alias("event"),
        F.when(k % 5 == 0, "initialized_with_error").when(k % 5 == 1, "under_voltage")
        .when(k % 5 == 2, "other").alias("subevent"),
        F.when(value < 20, "N").when(value < 100, "Y").alias("recoverflag"),
        F.when(k % 7 < 4, "Operating").otherwise("disabled").alias("alarmoperationalstate"),
        F.when(k % 3 == 0, "PICK").when(k % 3 == 1, "PLACE").otherwise("MOVE").alias("actiontype"),
        F.when(k % 4 == 0, "OTHER").when(k % 4 == 1, "BUFFER_TRANSFER").otherwise("SHELF_TRANSFER")
        .alias("transfertype"),
        F.when(k % 11 == 0, "abc").when(k % 13 == 0, F.lit(None)).otherwise(k.cast("string")).alias("level"),
    )


def bot_disconnect(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return placed(spark, sf_dir, "signup", "click").select(
        F.col("user_id").alias("Bot Id"),
        F.col("site").alias("Site Id"),
        F.when(k % 2 == 0, "Flicker").otherwise("Disconnect").alias("Disconnect Type"),
        F.col("value").alias("Disconnect Duration"),
        F.col("ts").alias("Lost Time"),
        F.when(k % 10 == 7, "Down").otherwise("Operating").alias("connect_operational_status"),
        F.when(k % 10 == 8, "Down").otherwise("Operating").alias("lost_operational_status"),
    )


def bot_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores are dated by day, so two of one day tie.

    Issues are picked from an array: of a CASE of literals Spark would lower each while it plans, in the driver.
    """
    k = F.col("k")
    issues = ["x Drive Fault Alarm --> {CAN1Bus Error: 7}", "x Drive Fault Alarm --> {CAN1Bus Error: 7}, more", "POWER FAULT on bus", None, "nothing"]
    issue = F.get(F.array(*[F.lit(i) for i in issues]), F.when((k % 8 >= 0) & (k % 8 < 4), k % 8).otherwise(4))
    return placed(spark, sf_dir, "purchase").select(
        F.col("user_id").alias("bot_id"),
        F.concat(F.lit("site-"), F.lower("site")).alias("site_id"),
        day_start(F.col("ts")).alias("last_updated"),
        issue.alias("issue_classifications"),
        (k / 4 + 40).alias("pull_score"),
        F.when(k % 6 != 5, 150 - k * 1.5).alias("tcts_daily_avg"),
    )


def diagnostic_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = F.col("k") % 5
    return events(spark, sf_dir, "click", "view", "purchase").select(
        F.col("user_id").alias("bot_id"),
        F.col("ts").alias("datetime"),
        F.when(group < 4, group).cast("bigint").alias("casegroupid"),
    )


def fleet(spark: SparkSession, sf_dir: str) -> FleetTables:
    return FleetTables(
        removals(spark, sf_dir),
        bot_health(spark, sf_dir),
        bot_errors(spark, sf_dir),
        bot_disconnect(spark, sf_dir),
        bot_recs(spark, sf_dir),
        diagnostic_message(spark, sf_dir),
        sites(spark, sf_dir),
    )


SQL = """
sites AS (
  SELECT 'site-' || lower(n_name) AS site_full, n_name AS site_short,
         CASE n_nationkey % 5 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Chicago'
              WHEN 2 THEN 'America/Denver' WHEN 3 THEN 'America/Phoenix'
              ELSE 'America/Los_Angeles' END AS tz
  FROM nation),
ev AS (
  SELECT e.*, CAST(regexp_extract(e.props, '"k": *([0-9]+)', 1) AS INTEGER) AS k, n.n_name AS site
  FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25),
removals AS (
  SELECT site AS site_id, CASE WHEN k % 19 <> 0 THEN user_id END AS botnumber, ts AS "timestamp",
         CASE event_type WHEN 'error' THEN 'Removed' ELSE 'Added' END AS action
  FROM ev, range(3) AS copies(copy)
  WHERE event_type IN ('error', 'signup') AND (copy = 0 OR k % 17 = 0)),
bot_health AS (
  SELECT 'env-' || (user_id % 3) AS environment, user_id AS bot_id, ts AS "timestamp",
         ts - to_hours(k - 5) AS bot_location_changed,
         CASE k % 3 WHEN 0 THEN 'Disabled' WHEN 1 THEN 'Operating' ELSE 'Idle' END AS bot_state,
         CASE WHEN k % 10 = 0 THEN 'Unknown' WHEN k % 10 = 1 THEN NULL
              WHEN k % 2 = 0 THEN 'Healthy' ELSE 'Faulted' END AS health_state,
         CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'reason-' || (k % 7) END AS safety_reason,
         CAST(k % 23 = 0 AS INTEGER) AS case_handling_disabled,
         CAST(k % 29 = 1 AS INTEGER) AS system_flagged,
         CAST(k % 5 = 2 AS INTEGER) AS drive_system_not_ok
  FROM ev WHERE event_type IN ('click', 'view')),
bot_errors AS (
  SELECT user_id AS bot_id, 'site-' || lower(site) AS site_id, ts AS datetime,
         CASE k % 6 WHEN 0 THEN 'alarm' WHEN 1 THEN 'Alarm' WHEN 2 THEN 'caseHandlingDisabled'
              WHEN 3 THEN 'suspect' WHEN 4 THEN 'logFileWritten' END AS event,
         CASE k % 5 WHEN 0 THEN 'initialized_with_error' WHEN 1 THEN 'under_voltage'
              WHEN 2 THEN 'other' END AS subevent,
         CASE WHEN value < 20 THEN 'N' WHEN value < 100 THEN 'Y' END AS recoverflag,
         CASE WHEN k % 7 < 4 THEN 'Operating' ELSE 'disabled' END AS alarmoperationalstate,
         CASE k % 3 WHEN 0 THEN 'PICK' WHEN 1 THEN 'PLACE' ELSE 'MOVE' END AS actiontype,
         CASE k % 4 WHEN 0 THEN 'OTHER' WHEN 1 THEN 'BUFFER_TRANSFER' ELSE 'SHELF_TRANSFER' END AS transfertype,
         CASE WHEN k % 11 = 0 THEN 'abc' WHEN k % 13 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS level
  FROM ev WHERE event_type IN ('purchase', 'view', 'click')),
bot_disconnect AS (
  SELECT user_id AS "Bot Id", site AS "Site Id",
         CASE k % 2 WHEN 0 THEN 'Flicker' ELSE 'Disconnect' END AS "Disconnect Type",
         value AS "Disconnect Duration", ts AS "Lost Time",
         CASE WHEN k % 10 = 7 THEN 'Down' ELSE 'Operating' END AS connect_operational_status,
         CASE WHEN k % 10 = 8 THEN 'Down' ELSE 'Operating' END AS lost_operational_status
  FROM ev WHERE event_type IN ('signup', 'click')),
bot_recs AS (
  SELECT user_id AS bot_id, 'site-' || lower(site) AS site_id,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) AS last_updated,
         CASE k % 8 WHEN 0 THEN 'x Drive Fault Alarm --> {CAN1Bus Error: 7}'
              WHEN 1 THEN 'x Drive Fault Alarm --> {CAN1Bus Error: 7}, more'
              WHEN 2 THEN 'POWER FAULT on bus' WHEN 3 THEN NULL ELSE 'nothing' END AS issue_classifications,
         k / 4.0 + 40 AS pull_score,
         CASE WHEN k % 6 <> 5 THEN CAST(150 - k * 1.5 AS DOUBLE) END AS tcts_daily_avg
  FROM ev WHERE event_type = 'purchase'),
diagnostic_message AS (
  SELECT user_id AS bot_id, ts AS datetime,
         CASE WHEN k % 5 < 4 THEN CAST(k % 5 AS BIGINT) END AS casegroupid
  FROM ev WHERE event_type IN ('click', 'view', 'purchase'))
"""
