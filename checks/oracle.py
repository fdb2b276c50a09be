"""The queries of ``checks.catalog`` as DuckDB SQL.

Lookbacks are correlated subqueries here, one per value, so the SQL shares nothing
with the running-aggregate form of the library.
"""

from __future__ import annotations

from checks.catalog import AS_OF, DAYS, WIDE
from checks.roles import SQL as ROLES
from rovelog.plans.compliance import Settings


def _interval(length) -> str:
    return f"INTERVAL '{int(length.total_seconds())} seconds'"


def _local(column: str) -> str:
    return f"({column} AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York')"


def _minutes(a: str, b: str) -> str:
    return f"date_diff('minute', {a}, {b})"


def removed_cte(as_of: str = AS_OF, days: int = DAYS) -> str:
    return f"""
removed AS (
  SELECT site_id, botnumber AS bot_id, "timestamp" AS event_ts FROM removals
  WHERE action = 'Removed' AND "timestamp" >= TIMESTAMP '{as_of}' - INTERVAL '{days} days')"""


def flagged_cte(gap: int) -> str:
    return f"""
flagged AS (
  SELECT *, CAST(prev_ts IS NULL OR {_minutes('prev_ts', 'event_ts')} >= {gap} AS INTEGER) AS is_new_event
  FROM (SELECT *, lag(event_ts) OVER (PARTITION BY site_id, bot_id ORDER BY event_ts) AS prev_ts FROM removed))"""


# what the report calls usable errors, with the category rules of the library
def errors_cte(as_of: str = AS_OF, days: int = 10) -> str:
    return f"""
errors AS (
  SELECT s.site_short AS site_id, bot_id, datetime, {_local('datetime')} AS error_ts,
    CASE WHEN upper(event) = 'ALARM' AND recoverflag <> 'Y'
              AND (upper(alarmoperationalstate) = 'OPERATING'
                   OR upper(alarmoperationalstate) = 'DISABLED'
                      AND subevent NOT IN ('estimation_error', 'under_voltage')) THEN 'WRANGLE'
         WHEN event = 'caseHandlingDisabled' THEN 'CHD'
         WHEN event = 'alarm' AND subevent = 'initialized_with_error' THEN 'IWE'
         WHEN event = 'suspect' AND actiontype IN ('PICK', 'PLACE')
              AND transfertype IN ('BUFFER_TRANSFER', 'SHELF_TRANSFER') THEN 'SUSPECT'
    END AS error_category
  FROM bot_errors e JOIN sites s ON s.site_full = e.site_id
  WHERE {_local('datetime')} > TIMESTAMP '{as_of}' - INTERVAL '{days} days'
    AND (event IS NULL OR event NOT IN ('logFileWritten', 'behaviorStackTrace', 'constraintViolation'))
    AND try_cast(level AS DECIMAL(38,0)) IS NOT NULL)"""


def health_cte() -> str:
    return f"""
health AS (SELECT *, {_local('"timestamp"')} AS local_ts FROM bot_health)"""


# Texts of the issues that call for removal.
_RED_FLAGS = """issue_classifications ILIKE '%Drive Fault Alarm --> {CAN1Bus Error%}'
    OR issue_classifications ILIKE '%Traction Feedback Error%'
    OR issue_classifications ILIKE '%Power Fault%'
    OR issue_classifications ILIKE '%Caster Motor Current%'
    OR issue_classifications ILIKE '%Blade Motor Current%'"""


def flags_cte() -> str:
    return f"""
red AS (
  SELECT DISTINCT bot_id, {_local('last_updated')} AS flagged_at FROM bot_recs
  WHERE {_RED_FLAGS})"""


def recs_cte() -> str:
    return f"""
recs AS (
  SELECT s.site_short AS site_id, bot_id, last_updated, {_local('last_updated')} AS local_ts,
         pull_score, tcts_daily_avg
  FROM bot_recs r JOIN sites s ON s.site_full = r.site_id)"""


def lost_cte(settings: Settings) -> str:
    rules = " OR ".join(
        f"(kind = '{t.kind}' AND n >= {t.min_events}"
        + (f" AND total >= {t.min_duration})" if t.min_duration is not None else ")")
        for t in settings.thresholds
    )
    return f"""
lost AS (
  SELECT site_id, bot_id, last_lost FROM (
    SELECT "Site Id" AS site_id, "Bot Id" AS bot_id, "Disconnect Type" AS kind, count(*) AS n,
           sum("Disconnect Duration") AS total, max("Lost Time") AS last_lost
    FROM bot_disconnect
    WHERE connect_operational_status = 'Operating' AND lost_operational_status = 'Operating'
    GROUP BY ALL)
  WHERE {rules})"""


def stale_cte(settings: Settings) -> str:
    return f"""
spans AS (
  SELECT e.bot_id, e.event_ts, m.casegroupid, min(m.datetime) AS first_seen, max(m.datetime) AS last_seen
  FROM (SELECT DISTINCT bot_id, event_ts FROM removed) e
  JOIN diagnostic_message m ON m.bot_id = e.bot_id AND m.casegroupid IS NOT NULL
   AND m.datetime BETWEEN e.event_ts - {_interval(settings.stale)} AND e.event_ts
  GROUP BY ALL),
stale AS (
  SELECT bot_id, event_ts, casegroupid, last_seen, first_seen,
         {_minutes('first_seen', 'last_seen')} AS duration_minutes
  FROM spans WHERE {_minutes('first_seen', 'last_seen')} >= {settings.stale_minutes}
  QUALIFY row_number() OVER (PARTITION BY bot_id, event_ts ORDER BY last_seen DESC, casegroupid) = 1)"""


def _in_health(period: str, what: str, extra: str = "") -> str:
    return f"""(SELECT {what} FROM health h WHERE h.bot_id = e.bot_id {extra}
      AND h.local_ts BETWEEN e.event_ts - {period} AND e.event_ts)"""


def _count(category: str, period) -> str:
    return f"""(SELECT count(*) FROM errors x WHERE x.site_id = e.site_id AND x.bot_id = e.bot_id
      AND x.error_category = '{category}' AND x.error_ts BETWEEN e.event_ts - {_interval(period)} AND e.event_ts)"""


def _exists(table: str, on: str, column: str, period) -> str:
    return f"""CAST(EXISTS (SELECT 1 FROM {table} x WHERE {on}
      AND x.{column} BETWEEN e.event_ts - {_interval(period)} AND e.event_ts) AS INTEGER)"""


_STATE = "max({'r': h.\"timestamp\", 'b': h.bot_state, 'h': h.health_state, 's': h.safety_reason})"
_NONBLANK = "AND h.safety_reason <> ''"
_FLAG_NAMES = ("case_handling_disabled", "system_flagged", "drive_system_not_ok")
_SAME = "x.site_id = e.site_id AND x.bot_id = e.bot_id"


def compliance_sql(
    settings: Settings,
    as_of: str = AS_OF,
    days: int = DAYS,
    roles: str | None = ROLES,
    site: str | None = None,
    select: str = "SELECT * FROM report",
) -> str:
    health = _interval(settings.health)
    ctes = [
        removed_cte(as_of, days),
        flagged_cte(settings.gap_minutes),
        health_cte(),
        errors_cte(as_of, settings.error_days),
        lost_cte(settings),
        flags_cte(),
        recs_cte(),
        stale_cte(settings),
        f"""
matched AS (
  SELECT e.*, count(*) OVER (PARTITION BY site_id, bot_id, event_ts) AS copies,
    (SELECT max(last_updated) FROM recs x WHERE {_SAME} AND x.local_ts <= e.event_ts) AS rec_at,
    {_in_health(health, _STATE)} AS state,
    {_in_health(health, _STATE, _NONBLANK)} AS reason,
    {", ".join(f"coalesce({_in_health(health, f'max(CAST(h.{n} = 1 AS INTEGER))')}, 0) AS {n}" for n in _FLAG_NAMES)},
    {", ".join(f"{_count(c, p)} AS {n}" for n, c, p in settings.counts)},
    {_exists("lost", _SAME, "last_lost", settings.disconnect)} AS has_disconnect_issue,
    {_exists("red", "x.bot_id = e.bot_id", "flagged_at", settings.red_flag)} AS red_flag
  FROM flagged e),
scored AS (
  SELECT e.*, r.pull_score AS exact_score, r.tcts_daily_avg, g.casegroupid, coalesce(e.state.b, 'UNKNOWN') AS bot_state,
    {", ".join(f"e.{n} * e.copies AS n_{n}" for n, _, _ in settings.counts)},
    sum(is_new_event) OVER (PARTITION BY e.site_id, e.bot_id) AS sessions
  FROM matched e
  LEFT JOIN recs r ON r.site_id = e.site_id AND r.bot_id = e.bot_id AND r.last_updated = e.rec_at
  LEFT JOIN stale g ON g.bot_id = e.bot_id AND g.event_ts = e.event_ts),
judged AS (
  SELECT *, CASE
    WHEN exact_score > {settings.min_pull_score} AND tcts_daily_avg < {settings.max_tcts} THEN 'Pull Score + TCTS OK'
    WHEN case_handling_disabled = 1 THEN 'Case Handling Disabled'
    WHEN system_flagged = 1 THEN 'System Flagged'
    WHEN n_wrangle_count >= {settings.min_wrangles} THEN 'WRANGLE Count >= {settings.min_wrangles}'
    WHEN n_suspect_count >= {settings.min_suspects} THEN 'SUSPECT Count >= {settings.min_suspects}'
    WHEN has_disconnect_issue = 1 THEN 'Disconnect Issue'
    WHEN red_flag = 1 THEN 'Red Flag Trigger'
    WHEN bot_state = 'Disabled' AND n_chd_count >= 1 THEN 'Disabled + CHD'
    WHEN bot_state = 'Disabled' AND n_iwe_count >= 1 THEN 'Disabled + IWE'
    WHEN casegroupid IS NOT NULL AND reason.s IS NULL THEN 'Stale Case' END AS why
  FROM scored),
report AS (
  SELECT site_id, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS removed_timestamp_est,
    CAST(event_ts AS DATE) AS removed_date, bot_id AS botnumber, 'Removed' AS action, bot_state,
    coalesce(state.h, 'UNKNOWN') AS health_state, reason.s AS safety_reason,
    CAST(sessions AS BIGINT) AS "3_DAY_REMOVAL_COUNT", round(exact_score, 1) AS pull_score, tcts_daily_avg,
    {", ".join(_FLAG_NAMES)},
    {", ".join(f"CAST(n_{n} AS BIGINT) AS {n}" for n, _, _ in settings.counts)},
    has_disconnect_issue, red_flag, coalesce(CAST(casegroupid AS VARCHAR), '0') AS stale_case,
    CAST(why IS NOT NULL AS INTEGER) AS valid_removal, why AS valid_removal_reason
  FROM judged {f"WHERE site_id = '{site}'" if site else ""})""",
    ]
    if roles:
        ctes.insert(0, roles)
    return f"WITH {','.join(ctes)}\n{select}"


def _with(*ctes: str, select: str) -> str:
    return f"WITH {','.join((ROLES, *ctes))}\n{select}"


_SNAPSHOT = """
snapshot AS (
  SELECT environment, bot_id, CAST(CAST("timestamp" AS DATE) AS TIMESTAMP) AS event_date,
         min("timestamp") AS snapshot_time, max(bot_location_changed) AS entry_time
  FROM bot_health
  WHERE health_state <> 'Unknown' AND hour("timestamp") = 23 AND minute("timestamp") BETWEEN 5 AND 55
  GROUP BY ALL)"""
_DWELL = """
dwelt AS (
  SELECT environment, bot_id, event_date,
         CAST(CAST(snapshot_time AS DATE) - CAST(entry_time AS DATE) AS INTEGER) AS dwell_days
  FROM snapshot WHERE entry_time <= snapshot_time)"""
_REINDUCT = f"""
weeks AS (
  SELECT site_id, botnumber, CAST(date_trunc('week', CAST("timestamp" AS DATE)) AS TIMESTAMP) AS week_start,
    count(*) FILTER (WHERE action = 'Added') AS inductions_per_week,
    count(*) FILTER (WHERE action = 'Removed') AS removals_per_week,
    min("timestamp") FILTER (WHERE action = 'Added') AS first_induction_time,
    max("timestamp") FILTER (WHERE action = 'Removed') AS last_removal_time
  FROM removals
  WHERE CAST("timestamp" AS DATE) BETWEEN DATE '2024-01-30' - {DAYS} AND DATE '2024-01-30'
  GROUP BY ALL)
SELECT *, CASE WHEN last_removal_time > first_induction_time THEN 'Fail' ELSE 'Pass' END AS pass_fail FROM weeks"""
_H12 = "INTERVAL '12 hours'"
_BOT_EVENTS = "(SELECT DISTINCT bot_id, event_ts FROM removed)"

ORACLE = {
    "recent_events": _with(
        select=f"""SELECT * FROM removals WHERE action = 'Removed'
        AND "timestamp" >= TIMESTAMP '{AS_OF}' - INTERVAL '{DAYS} days'"""
    ),
    "flag_new_events": _with(removed_cte(), flagged_cte(30), select="SELECT * FROM flagged"),
    "flag_new_events_day": _with(removed_cte(), flagged_cte(1440), select="SELECT * FROM flagged"),
    "session_total": _with(
        removed_cte(),
        flagged_cte(1440),
        select="""SELECT site_id, bot_id, event_ts, is_new_event,
          CAST(sum(is_new_event) OVER (PARTITION BY site_id, bot_id) AS BIGINT) AS removal_sessions FROM flagged""",
    ),
    "lookback_flags": _with(
        removed_cte(),
        health_cte(),
        select=f"""SELECT e.bot_id, e.event_ts, {", ".join(f"max(CAST(h.{n} = 1 AS INTEGER)) AS {n}" for n in _FLAG_NAMES)}
        FROM removed e JOIN health h ON h.bot_id = e.bot_id AND h.local_ts BETWEEN e.event_ts - {_H12} AND e.event_ts
        GROUP BY ALL""",
    ),
    "latest_nonblank": _with(
        removed_cte(),
        health_cte(),
        select=f"""SELECT bot_id, event_ts, s.b AS bot_state, s.h AS health_state, s.s AS safety_reason
        FROM (SELECT *, {_in_health(_H12, _STATE, _NONBLANK)} AS s FROM {_BOT_EVENTS} e) WHERE s IS NOT NULL""",
    ),
    "latest_in_lookback": _with(
        removed_cte(),
        health_cte(),
        select=f"""SELECT bot_id, event_ts, s.b AS bot_state, s.h AS health_state
        FROM (SELECT *, {_in_health(_H12, _STATE)} AS s FROM {_BOT_EVENTS} e) WHERE s IS NOT NULL""",
    ),
    "classify": _with(errors_cte(), select="SELECT * FROM errors"),
    "bounded_counts": _with(
        removed_cte(),
        errors_cte(),
        select=f"""SELECT site_id, bot_id, event_ts, {", ".join(f"CAST(copies * {_count(c, p)} AS BIGINT) AS {n}" for n, c, p in WIDE.counts)}
        FROM (SELECT site_id, bot_id, event_ts, count(*) AS copies FROM removed GROUP BY ALL) e""",
    ),
    "disconnect_issue": _with(
        removed_cte(),
        lost_cte(WIDE),
        select=f"""SELECT site_id, bot_id, event_ts,
        {_exists("lost", _SAME, "last_lost", WIDE.disconnect)} AS has_disconnect_issue
        FROM (SELECT DISTINCT site_id, bot_id, event_ts FROM removed) e""",
    ),
    "red_flags": _with(flags_cte(), select="SELECT * FROM red"),
    "pattern_hits": """SELECT DISTINCT doc_id, lang FROM documents
        WHERE contains(lower(text), 'the on') OR contains(lower(text), 'le la')""",
    "flag_if_hit": _with(
        removed_cte(),
        flags_cte(),
        select=f"""SELECT bot_id, event_ts, {_exists("red", "x.bot_id = e.bot_id", "flagged_at", WIDE.red_flag)} AS red_flag
        FROM {_BOT_EVENTS} e""",
    ),
    "stale_group": _with(removed_cte(), stale_cte(WIDE), select="SELECT * FROM stale"),
    "asof_join": _with(
        removed_cte(),
        recs_cte(),
        select=f"""SELECT e.*, r.pull_score, r.tcts_daily_avg FROM
        (SELECT *, (SELECT max(last_updated) FROM recs x WHERE {_SAME} AND x.local_ts <= e.event_ts) AS matched_ts
         FROM removed e) e
        LEFT JOIN recs r ON r.site_id = e.site_id AND r.bot_id = e.bot_id AND r.last_updated = e.matched_ts""",
    ),
    "asof_join_one": _with(
        removed_cte(),
        recs_cte(),
        select=f"""SELECT site_id, bot_id, event_ts, b.u AS matched_ts, b.p AS pull_score, b.t AS tcts_daily_avg FROM
        (SELECT *, (SELECT max({{'u': last_updated, 'p': pull_score, 't': tcts_daily_avg}}) FROM recs x
          WHERE {_SAME} AND x.local_ts <= e.event_ts) AS b FROM removed e)""",
    ),
    "compliance_wide": compliance_sql(WIDE),
    "compliance_report": compliance_sql(Settings()),
    "compliance_one_site": compliance_sql(WIDE, site="NATION_7"),
    "verdict_counts": compliance_sql(
        WIDE,
        select="SELECT valid_removal, valid_removal_reason, count(*) AS removals FROM report GROUP BY ALL",
    ),
    "daily_snapshot": _with(_SNAPSHOT, select="SELECT * FROM snapshot"),
    "dwell_days": _with(_SNAPSHOT, _DWELL, select="SELECT * FROM dwelt"),
    "dwell_summary": _with(
        _SNAPSHOT,
        _DWELL,
        select=f"""SELECT environment, event_date, count(DISTINCT bot_id) AS unique_bot_count, avg(dwell_days) AS avg_dwell_days
        FROM dwelt WHERE event_date BETWEEN DATE '2024-01-30' - {DAYS} AND DATE '2024-01-30' GROUP BY ALL""",
    ),
    "weekly_reinduct": f"WITH {ROLES}, {_REINDUCT}",
    "all_sites": f"WITH {ROLES}, {_REINDUCT}".replace(
        "SELECT site_id, botnumber, CAST", "SELECT r_name AS site_id, botnumber, CAST"
    ).replace(
        "  FROM removals\n",
        "  FROM removals JOIN nation ON n_name = site_id JOIN region ON r_regionkey = n_regionkey\n",
    ),
    "site_report": _with(
        removed_cte(),
        select="""SELECT site_full, site_short, (SELECT count(*) FROM removed r WHERE r.site_id = s.site_short) AS rows
        FROM sites s""",
    ),
    "to_site_local": _with(
        select="""SELECT r.*, r."timestamp" AT TIME ZONE 'UTC' AT TIME ZONE s.tz AS site_local_ts
        FROM removals r LEFT JOIN sites s ON s.site_short = r.site_id"""
    ),
    "write_by_site": compliance_sql(WIDE),
    "ordered_report": compliance_sql(
        WIDE,
        select="""SELECT row_number() OVER (ORDER BY removed_timestamp_est, site_id, botnumber NULLS FIRST) - 1 AS place,
          removed_timestamp_est, site_id, botnumber FROM report""",
    ),
}
ORACLE["site_folders"] = _with(select="SELECT * FROM removals WHERE site_id IS NOT NULL")
ORACLE["loaded_report"] = compliance_sql(
    WIDE, select="SELECT site_id, valid_removal_reason, count(*) AS removals FROM report GROUP BY ALL"
)
_WRONG_LEVELS = f"""(SELECT s.site_short AS site_id, count(*) AS wrong FROM bot_errors e JOIN sites s ON s.site_full = e.site_id
  WHERE {_local('datetime')} > TIMESTAMP '{AS_OF}' - INTERVAL '10 days'
    AND (event IS NULL OR event NOT IN ('logFileWritten', 'behaviorStackTrace', 'constraintViolation'))
    AND level IS NOT NULL AND try_cast(level AS DECIMAL(38,0)) IS NULL GROUP BY ALL)"""
ORACLE["failed_sites"] = compliance_sql(
    WIDE,
    select=f"""SELECT site_id, 'bot_errors' AS source, 'level is not a number' AS reason, wrong AS rows FROM {_WRONG_LEVELS}
    UNION ALL SELECT site_id, 'report', NULL, count(*) FROM report
    WHERE site_id IS NULL OR site_id NOT IN (SELECT site_id FROM {_WRONG_LEVELS}) GROUP BY ALL""",
)
ORACLE["published_report"] = ORACLE["write_by_site"]
ORACLE["kept_disconnects"] = ORACLE["disconnect_issue"]
ORACLE["write_dwell"] = ORACLE["dwell_summary"]
ORACLE["ordered_dwell"] = f"""SELECT row_number() OVER (ORDER BY event_date DESC) - 1 AS place, event_date
FROM ({ORACLE["dwell_summary"]})"""
ORACLE["ordered_reinduct"] = f"""SELECT row_number() OVER (ORDER BY week_start DESC, botnumber NULLS LAST) - 1 AS place, week_start, botnumber
FROM ({ORACLE["weekly_reinduct"]})"""
