"""First-match rules: error categories, text patterns and the verdict."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rovelog.functions.timeops import EASTERN_BEHIND, span, to_zone, wall

Rule = tuple[str, Column]


def first_match(rules: Sequence[Rule]) -> Column:
    """Label of the first rule that holds, null if none does (null counts as not holding)."""
    (label, condition), *rest = rules
    chain = F.when(condition, F.lit(label))
    for label, condition in rest:
        chain = chain.when(condition, F.lit(label))
    return chain


# Event names and codes in the error log.
IGNORED_EVENTS = ("logFileWritten", "behaviorStackTrace", "constraintViolation")
HARMLESS_WHEN_DISABLED = ("estimation_error", "under_voltage")
SUSPECT_ACTIONS = ("PICK", "PLACE")
SUSPECT_TRANSFERS = ("BUFFER_TRANSFER", "SHELF_TRANSFER")


def error_rules() -> list[Rule]:
    """Only the first rule ignores case.  ``!=`` and negated lists drop nulls on purpose."""
    event, subevent = F.col("event"), F.col("subevent")
    state = F.upper("alarmoperationalstate")
    stopped_it = (state == "OPERATING") | (
        (state == "DISABLED") & ~subevent.isin(*HARMLESS_WHEN_DISABLED)
    )
    return [
        ("WRANGLE", (F.upper(event) == "ALARM") & (F.col("recoverflag") != "Y") & stopped_it),
        ("CHD", event == "caseHandlingDisabled"),
        ("IWE", (event == "alarm") & (subevent == "initialized_with_error")),
        (
            "SUSPECT",
            (event == "suspect")
            & F.col("actiontype").isin(*SUSPECT_ACTIONS)
            & F.col("transfertype").isin(*SUSPECT_TRANSFERS),
        ),
    ]


def classify(df: DataFrame, rules: Sequence[Rule], name: str = "error_category") -> DataFrame:
    return df.withColumn(name, first_match(rules))


def classified_errors(
    errors: DataFrame,
    as_of: datetime | str,
    *,
    error_days: int = 10,
    strict: bool = False,
    wrong: str | None = None,
) -> DataFrame:
    """Usable error rows with ``error_ts`` (local) and ``error_category``.

    ``strict`` raises on a level that is not a number; otherwise the row is dropped, or kept
    with a text in the column ``wrong``, if that is named.
    Eastern time is 4 or 5 hours behind UTC, so the raw time alone settles the age of
    all rows but those of a few hours; only these are converted to be tested, and the
    bound reaches the file scan.
    """
    since = wall(as_of) - span(timedelta(days=error_days))
    level = F.col("level").try_cast("decimal(38,0)")
    no_number = F.col("level").isNotNull() & level.isNull()
    if wrong is not None:
        errors = errors.withColumn(wrong, F.when(no_number, F.lit("level is not a number")))
    elif strict:
        failed = F.raise_error(F.concat(F.lit("level is not a number: "), F.col("level")))
        level = F.when(no_number, failed.cast("decimal(38,0)")).otherwise(level)
    local = to_zone(F.col("datetime"))
    nearest, farthest = EASTERN_BEHIND
    usable = errors.where(
        (F.col("datetime") > since + span(nearest))
        & ((F.col("datetime") > since + span(farthest)) | (local > since))
        & (F.col("event").isNull() | ~F.col("event").isin(*IGNORED_EVENTS))
        & (level.isNotNull() if wrong is None else F.col("level").isNotNull())
    )
    return classify(usable, error_rules()).withColumn("error_ts", local)


# Texts of the issues that call for removal.  The first has to end the text.
RED_FLAG_PATTERNS = (
    "%Drive Fault Alarm --> {CAN1Bus Error%}",
    "%Traction Feedback Error%",
    "%Power Fault%",
    "%Caster Motor Current%",
    "%Blade Motor Current%",
)


def matches_any(text: Column, patterns: Sequence[str]) -> Column:
    """Spark would lower a literal while it plans, which fills the driver's heap; only patterns beyond ASCII need that."""
    lower = F.lower(text)
    return reduce(lambda a, b: a | b, [lower.like(p.lower()) if p.isascii() else text.ilike(p) for p in patterns])


def pattern_hits(df: DataFrame, text: str, patterns: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Distinct ``columns`` of the rows whose text matches a pattern in any case."""
    return df.where(matches_any(F.col(text), patterns)).select(*columns).distinct()


def removal_rules(
    pull_score: float = 50, tcts: float = 100, wrangles: int = 3, suspects: int = 20
) -> list[Rule]:
    """Reasons that justify a removal, the most important first."""
    disabled = F.col("bot_state") == "Disabled"
    return [
        ("Pull Score + TCTS OK", (F.col("pull_score") > pull_score) & (F.col("tcts_daily_avg") < tcts)),
        ("Case Handling Disabled", F.col("case_handling_disabled") == 1),
        ("System Flagged", F.col("system_flagged") == 1),
        (f"WRANGLE Count >= {wrangles}", F.col("wrangle_count") >= wrangles),
        (f"SUSPECT Count >= {suspects}", F.col("suspect_count") >= suspects),
        ("Disconnect Issue", F.col("has_disconnect_issue") == 1),
        ("Red Flag Trigger", F.col("red_flag") == 1),
        ("Disabled + CHD", disabled & (F.col("chd_count") >= 1)),
        ("Disabled + IWE", disabled & (F.col("iwe_count") >= 1)),
        ("Stale Case", F.col("stale_group").isNotNull() & F.col("safety_reason").isNull()),
    ]


def verdict(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Adds ``valid_removal`` (1 or 0) and ``valid_removal_reason``."""
    judged = df.withColumn("valid_removal_reason", first_match(rules or removal_rules()))
    return judged.withColumn("valid_removal", F.col("valid_removal_reason").isNotNull().cast("int"))
