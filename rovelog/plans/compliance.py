"""Was each removal justified?  All sites in one plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rovelog.functions.timeops import EASTERN, second_text, span, to_zone, wall
from rovelog.operators.asof import attach_records, latest_time_before, record_variants
from rovelog.operators.events import event_times, is_new, previous_event, recent_events
from rovelog.operators.failures import REJECTED, FailedSites
from rovelog.operators.keyed import COPIES, expand, is_small, key_total
from rovelog.operators.lookback import (
    Count,
    Pick,
    Threshold,
    counts_before,
    disconnect_last_times,
    disconnect_totals,
    non_blank,
    past_thresholds,
    seen_before,
    states_before,
)
from rovelog.operators.rules import (
    RED_FLAG_PATTERNS,
    classified_errors,
    pattern_hits,
    removal_rules,
    verdict,
)
from rovelog.operators.sites import short_site_codes
from rovelog.operators.stale import stale_group
from rovelog.operators.timeline import BROADCAST_ROWS, cell_of, enrich, event_cells, fit_broadcast, thinned
from rovelog.sources.sinks import remove_steps, written
from rovelog.sources.tables import DAY_PART, OF_SITES, FleetTables

SITE, BOT, TS = "site_id", "bot_id", "event_ts"
FLAGS = ("case_handling_disabled", "system_flagged", "drive_system_not_ok")


@dataclass(frozen=True)
class Settings:
    """Periods and thresholds; the defaults are those of the report.

    ``broadcast_rows`` bounds what a source is thinned out with before its shuffle;
    with more (machine, step) rows than that the steps are shuffled too.  ``site_scoped``
    also matches health, red flags and messages by site, for fleets whose machine
    numbers are not unique; these sources then need a ``site_id`` with short codes.
    """

    gap_minutes: int = 30
    health: timedelta = timedelta(hours=1)
    counts: tuple[tuple[str, str, timedelta], ...] = (
        ("wrangle_count", "WRANGLE", timedelta(days=3)),
        ("chd_count", "CHD", timedelta(days=3)),
        ("suspect_count", "SUSPECT", timedelta(days=3)),
        ("iwe_count", "IWE", timedelta(days=1)),
    )
    error_days: int = 10
    strict_levels: bool = False
    disconnect: timedelta = timedelta(hours=72)
    thresholds: tuple[Threshold, ...] = (
        Threshold("Flicker", 500),
        Threshold("Disconnect", 5, 1800),
    )
    red_flag: timedelta = timedelta(hours=1)
    red_flag_patterns: tuple[str, ...] = RED_FLAG_PATTERNS
    stale: timedelta = timedelta(hours=2)
    stale_minutes: int = 120
    min_pull_score: float = 50
    max_tcts: float = 100
    min_wrangles: int = 3
    min_suspects: int = 20
    broadcast_rows: int = BROADCAST_ROWS
    site_scoped: bool = False


# The columns of the report.
COLUMNS = (
    SITE,
    "removed_timestamp_est",
    "removed_date",
    "botnumber",
    "action",
    "bot_state",
    "health_state",
    "safety_reason",
    "3_DAY_REMOVAL_COUNT",
    "pull_score",
    "tcts_daily_avg",
    *FLAGS,
    "wrangle_count",
    "chd_count",
    "suspect_count",
    "iwe_count",
    "has_disconnect_issue",
    "red_flag",
    "stale_case",
    "valid_removal",
    "valid_removal_reason",
)


def within_days(rows: DataFrame, first: Column, last: Column | None) -> DataFrame:
    """Leaves out the day folders before ``first`` and after ``last``, where a source has them."""
    if DAY_PART not in rows.columns:
        return rows
    rows = rows.where(F.col(DAY_PART) >= F.to_date(first))
    return (rows if last is None else rows.where(F.col(DAY_PART) <= F.to_date(last))).drop(DAY_PART)


def removal_events(
    removals: DataFrame, as_of: datetime | str, days: int, until: datetime | str | None = None
) -> DataFrame:
    """One row per site, machine and removal time."""
    removed = recent_events(removals, "timestamp", as_of, days, action="Removed", until=until)
    named = removed.select(
        SITE, F.col("botnumber").alias(BOT), F.col("timestamp").alias(TS), "action"
    )
    return event_times(named, [SITE, BOT, TS, "action"])


def compliance(
    tables: FleetTables,
    as_of: datetime | str,
    days: int = 13,
    settings: Settings = Settings(),
    *,
    sites: Sequence[str] | None = None,
    until: datetime | str | None = None,
    ordered: bool = True,
    lost_totals: DataFrame | None = None,
    failed: FailedSites | None = None,
) -> DataFrame:
    """One row per removal (and per tied score record) with features and verdict.

    Health, red flags and diagnostic messages are matched by machine only (see
    ``Settings.site_scoped``), errors, disconnects and scores by site and machine, as in
    the report.  ``sites`` (short codes) limits every source that knows its site.  The
    call itself writes nine steps to the shared folder: the removals; their cells by site and machine, and by machine; the removals with the times of
    the scores before them, and then with errors and disconnects; the scores that matched one; the removals with their sessions, and then with red flags
    and stale cases; and the stale cases.  ``lost_totals``, kept by
    ``sources.kept`` for DISCONNECT_TOTALS, stand for the disconnects of all history, which are then not read.

    With ``failed`` a site is left out, and noted there, if a removal or usable error of the period is
    rejected (``sources.tables.checked(aside=True)``) or, with ``strict_levels``, such an error has a
    level that is not a number; the others go on.  Sites noted before are left out as well.
    """
    marked = [t for t in OF_SITES if REJECTED in getattr(tables, t).columns]
    if marked and failed is None:
        raise ValueError(f"{marked} may hold rejected rows: pass failed=")
    scored = tables.bot_recs
    if sites is not None:
        tables, scored = of_sites(tables, sites)
    if lost_totals is not None and sites is not None:
        lost_totals = lost_totals.where(F.col(SITE).isin(list(sites)))
    removals = tables.removals
    if REJECTED in removals.columns:
        recent = recent_events(removals, "timestamp", as_of, days, action="Removed", until=until)
        removals = failed.without(recent, "removals", SITE, REJECTED)
    events = written(removal_events(removals, as_of, days, until))
    start = wall(as_of) - span(timedelta(days=days))

    by_site = [SITE, BOT]
    n_events, most_copies = events.agg(F.count(F.lit(1)), F.max(COPIES)).first()
    few_sites, few = is_small(tables.sites), fit_broadcast(n_events, settings.broadcast_rows)
    recs = short_site_codes(
        scored, tables.sites, cell_of(F.col("last_updated")), small=few_sites
    )
    noted = "_wrong_level" if failed is not None and settings.strict_levels else None
    marks = [F.col(c) for c in (noted, REJECTED if "bot_errors" in marked else None) if c]
    errors = short_site_codes(
        classified_errors(
            tables.bot_errors, as_of, error_days=settings.error_days, strict=settings.strict_levels, wrong=noted
        ),
        tables.sites,
        cell_of(F.col("datetime")),
        small=few_sites,
    )
    if marks:
        errors = errors.select(SITE, BOT, "datetime", "error_ts", "error_category", F.coalesce(*marks).alias("_reason"))
        errors = failed.without(errors, "bot_errors", SITE, "_reason")
    if failed is not None:
        events = failed.others(events, SITE)

    # steps of their own: the driver holds one of these plans and its broadcasts at a time
    scored_before = [previous_event(events, TS, "_prev"), latest_time_before(recs, "last_updated", "_rec_at", EASTERN)]
    found = event_cells(events, by_site, F.col(TS))
    cells = written(found)
    rows = written(enrich(events, by_site, TS, scored_before, cells=cells, few=few))
    failures = [error_feature(errors, settings), disconnect_feature(tables.bot_disconnect, settings, lost_totals)]
    rows = written(enrich(rows, by_site, TS, failures, cells=cells, few=few))
    if marks:
        remove_steps(errors)
    scores = written(matched_scores(rows, recs, few))
    most = (most_copies or 1) * (scores.agg(F.max("_tied")).first()[0] or 1)  # rows that one row of the report stands for
    by_bot = by_site if settings.site_scoped else [BOT]
    rows = timed = written(_with_sessions(rows, scores, settings.gap_minutes))
    if not settings.site_scoped:
        _used_up(cells, found)
        cells = written(event_cells(events, by_bot, F.col(TS)))
    found = stale_cases(events, tables.diagnostic_message, start, settings, few, until, by_bot, cells)
    stale = written(found)

    red_flags = red_flag_feature(recs if settings.site_scoped else tables.bot_recs, start, settings, by_bot)
    rows = enrich(rows, by_bot, TS, [red_flags], cells=cells, few=few)
    rows = written(rows.join(stale, [*by_bot, TS], "left"))
    _used_up(stale, found)
    rows = enrich(rows, by_bot, TS, [health_feature(tables.bot_health, start, settings, until)], cells=cells, few=few)

    rows = attach_records(rows, scores, by_site, TS, "_rec_at", times=timed)
    rows = _assembled(rows, settings).withColumn(COPIES, F.col(COPIES) * F.coalesce("_tied", F.lit(1)))
    rows = expand(rows.select(TS, COPIES, *COLUMNS), most=most)
    if ordered:
        # the copy number lets a range sort split even one hot time
        rows = rows.orderBy(F.col(TS).asc_nulls_last(), SITE, "botnumber", "copy_number")
    return rows.select(*COLUMNS)


def of_sites(tables: FleetTables, sites: Sequence[str]) -> tuple[FleetTables, DataFrame]:
    """``tables`` with the rows of some sites, given by short code, and the scores of these sites.

    Names reach the scans as literals, one or two for each site asked for.  In the tables
    the scores keep all sites, because red flags are matched by machine.
    """
    codes = list(sites)
    dimension = tables.sites.where(F.col("site_short").isin(codes))
    names = [row["site_full"] for row in dimension.select("site_full").distinct().collect()]
    short = {"removals": SITE, "bot_disconnect": "Site Id"}
    kept = {name: getattr(tables, name).where(F.col(column).isin(codes)) for name, column in short.items()}
    kept["bot_errors"] = tables.bot_errors.where(F.col(SITE).isin(names))
    return replace(tables, sites=dimension, **kept), tables.bot_recs.where(F.col(SITE).isin(names))


def matched_scores(rows: DataFrame, recs: DataFrame, few: bool) -> DataFrame:
    """The different scores at the times that matched an event, with their numbers of copies."""
    times = rows.where(F.col("_rec_at").isNotNull()).select(SITE, BOT, F.col("_rec_at").alias("last_updated")).distinct()
    by = [SITE, BOT, "last_updated"]
    wanted = recs.join(F.broadcast(times), by, "left_semi") if few else thinned(recs, times, by).join(times, by, "left_semi")
    return record_variants(wanted, [SITE, BOT], "last_updated", "_rec_at", ["pull_score", "tcts_daily_avg"], "_tied")


def _used_up(step: DataFrame, made_from: DataFrame) -> None:
    """Deletes a step that nothing reads any more, if it was written."""
    if step is not made_from:
        remove_steps(step)


def _with_sessions(rows: DataFrame, scores: DataFrame, gap_minutes: int) -> DataFrame:
    """Adds the number of new events of the machine.

    The report sums the flags after joining the scores, so an event with n tied
    scores counts n times.
    """
    ties = scores.groupBy(SITE, BOT, "_rec_at").agg(F.sum("_tied").alias("_ties"))
    rows = attach_records(rows, ties, [SITE, BOT], TS, "_rec_at")
    weight = is_new("_prev", TS, gap_minutes) * F.coalesce("_ties", F.lit(1))
    total = key_total(rows, [SITE, BOT], cell_of(F.col(TS)), weight, "removal_sessions")
    return total.drop("_prev", "_ties")


def health_feature(health: DataFrame, start: Column, settings: Settings, until: datetime | str | None = None):
    """Flags, the latest state, and the latest state with a safety reason.

    Eastern time is behind UTC, so the raw bounds cannot drop a matching row.
    """
    first, last = start - span(settings.health), None
    rows = health.where(F.col("timestamp") >= first)
    if until is not None:
        last = wall(until) + span(timedelta(hours=6))
        rows = rows.where(F.col("timestamp") <= last)
    rows = within_days(rows, first, last)
    return states_before(
        rows,
        "timestamp",
        TS,
        settings.health,
        flags={name: F.col(name) == 1 for name in FLAGS},
        picks={
            "_state": Pick(["bot_state", "health_state"]),
            "_reason": Pick(["bot_state", "health_state", "safety_reason"], non_blank("safety_reason")),
        },
        zone=EASTERN,
    )


def red_flag_feature(recs: DataFrame, start: Column, settings: Settings, keys: Sequence[str] = (BOT,)):
    hits = pattern_hits(
        recs.where(F.col("last_updated") >= start - span(settings.red_flag)).withColumn(
            "flagged_at", to_zone(F.col("last_updated"))
        ),
        "issue_classifications",
        settings.red_flag_patterns,
        [*keys, "flagged_at"],
    )
    return seen_before(hits, "flagged_at", TS, settings.red_flag, "red_flag")


def error_feature(errors: DataFrame, settings: Settings):
    counts = {name: Count(category, period) for name, category, period in settings.counts}
    return counts_before(errors, "error_ts", "error_category", counts, raw="datetime")


DISCONNECT_TOTALS = disconnect_totals([SITE, BOT], "kind", "duration", "lost")


def in_service(disconnects: DataFrame) -> DataFrame:
    """The disconnects that count, with all their columns and the names of DISCONNECT_TOTALS."""
    operating = (F.col("connect_operational_status") == "Operating") & (F.col("lost_operational_status") == "Operating")
    names = {"Bot Id": BOT, "Site Id": SITE, "Disconnect Type": "kind", "Disconnect Duration": "duration", "Lost Time": "lost"}
    return disconnects.where(operating).withColumnsRenamed(names)


def disconnect_feature(disconnects: DataFrame, settings: Settings, totals: DataFrame | None = None):
    """From all disconnects, or from their kept ``totals``."""
    if totals is not None:
        last = past_thresholds(totals, [SITE, BOT], "kind", settings.thresholds)
    else:
        last = disconnect_last_times(in_service(disconnects), [SITE, BOT], "kind", "duration", "lost", settings.thresholds)
    return seen_before(last, "last_lost_time", TS, settings.disconnect, "has_disconnect_issue", grouped=True)


def stale_cases(
    events: DataFrame,
    messages: DataFrame,
    start: Column,
    settings: Settings,
    few: bool | None = None,
    until: datetime | str | None = None,
    keys: Sequence[str] = (BOT,),
    cells: DataFrame | None = None,
) -> DataFrame:
    rows = messages.where(F.col("datetime") >= start - span(settings.stale))
    if until is not None:
        rows = rows.where(F.col("datetime") <= wall(until))
    rows = within_days(rows, start - span(settings.stale), None if until is None else wall(until))
    found = stale_group(
        events,
        rows.withColumnRenamed("casegroupid", "stale_group"),
        list(keys),
        TS,
        "datetime",
        "stale_group",
        settings.stale,
        settings.stale_minutes,
        with_span=False,
        few=few,
        cells=cells,
    )
    return found.select(*keys, TS, "stale_group")


def _assembled(rows: DataFrame, settings: Settings) -> DataFrame:
    """Defaults, counts per copy of the removal, and the verdict on the exact score."""
    counted = {name: F.col(name) * F.col(COPIES) for name, _, _ in settings.counts}
    rows = rows.withColumns(
        {
            "bot_state": F.coalesce("_state.bot_state", F.lit("UNKNOWN")),
            "health_state": F.coalesce("_state.health_state", F.lit("UNKNOWN")),
            "safety_reason": F.col("_reason.safety_reason"),
            "removed_timestamp_est": second_text(F.col(TS)),
            "removed_date": F.to_date(TS),
            "botnumber": F.col(BOT),
            "3_DAY_REMOVAL_COUNT": F.col("removal_sessions"),
            "stale_case": F.coalesce(F.col("stale_group").cast("string"), F.lit("0")),
            **counted,
        }
    )
    rules = removal_rules(
        settings.min_pull_score, settings.max_tcts, settings.min_wrangles, settings.min_suspects
    )
    return verdict(rows, rules).withColumn("pull_score", F.round("pull_score", 1))
