import pytest
from conftest import frame, rows, t
from pyspark.sql import functions as F

from rovelog.operators.rules import (
    RED_FLAG_PATTERNS,
    classified_errors,
    first_match,
    pattern_hits,
    verdict,
)

AS_OF = "2024-01-15 12:00:00"
FIELDS = ("event", "subevent", "recoverflag", "alarmoperationalstate", "actiontype", "transfertype", "level")
DROPPED = "dropped"
CASES = [
    (("Alarm", "a", "N", "Operating"), "WRANGLE"),
    (("alarm", "a", None, "operating"), None),
    (("alarm", "a", "Y", "operating"), None),
    (("alarm", "under_voltage", "N", "disabled"), None),
    (("alarm", "estimation_error", "N", "Disabled"), None),
    (("alarm", None, "N", "disabled"), None),
    (("alarm", "a", "N", "disabled"), "WRANGLE"),
    (("alarm", "initialized_with_error", "N", "operating"), "WRANGLE"),
    (("alarm", "initialized_with_error", "Y", "operating"), "IWE"),
    (("ALARM", "initialized_with_error", "Y", "operating"), None),
    (("caseHandlingDisabled",), "CHD"),
    (("casehandlingdisabled",), None),
    (("suspect", None, None, None, "PICK", "SHELF_TRANSFER"), "SUSPECT"),
    (("suspect", None, None, None, "PLACE", "BUFFER_TRANSFER"), "SUSPECT"),
    (("suspect", None, None, None, "PICK", "OTHER"), None),
    (("suspect", None, None, None, None, "SHELF_TRANSFER"), None),
    (("logFileWritten",), DROPPED),
    (("behaviorStackTrace",), DROPPED),
    (("constraintViolation",), DROPPED),
    ((None, None, None, None, None, None, "3"), None),
    (("alarm", None, None, None, None, None, None), DROPPED),
    (("alarm", None, None, None, None, None, "abc"), DROPPED),
]


def error(values, when="14 12:00"):
    defaults = (None,) * 6 + ("1",)
    values = tuple(values) + defaults[len(values):]
    return {"bot_id": 1, "site_id": "north-one", "datetime": t(when), **dict(zip(FIELDS, values))}


def test_error_categories(spark):
    data = [{**error(values), "bot_id": i} for i, (values, _) in enumerate(CASES)]
    found = {r["bot_id"]: r["error_category"] for r in classified_errors(frame(spark, "bot_errors", data), AS_OF).collect()}
    assert [found.get(i, DROPPED) for i in range(len(CASES))] == [c for _, c in CASES]


def test_bad_level_raises_when_strict(spark):
    bad = frame(spark, "bot_errors", [error(("alarm", None, None, None, None, None, "abc"))])
    with pytest.raises(Exception, match="level is not a number"):
        classified_errors(bad, AS_OF, strict=True).collect()


def test_error_age_is_local_and_strict(spark, zone):
    at = ["2024-01-05 17:00:00", "2024-01-05 17:00:01", "2024-01-05 16:59:59"]
    df = frame(spark, "bot_errors", [error(("caseHandlingDisabled",), x) for x in at])
    assert rows(classified_errors(df, AS_OF), "datetime", "error_ts") == [(t(at[1]), t("2024-01-05 12:00:01"))]


@pytest.mark.parametrize(
    "text,hit",
    [
        ("x Drive Fault Alarm --> {CAN1Bus Error: 7}", True),
        ("x Drive Fault Alarm --> {CAN1Bus Error: 7}, more", False),
        ("POWER FAULT on bus", True),
        ("caster motor current", True),
        ("a Blade Motor Current b", True),
        ("Traction Feedback Error", True),
        ("Traction Error", False),
        (None, False),
    ],
)
def test_red_flag_texts(spark, text, hit):
    df = spark.createDataFrame([(1, text), (1, text)], "bot_id long, x string")
    assert pattern_hits(df, "x", RED_FLAG_PATTERNS, ["bot_id"]).count() == int(hit)


QUIET = {
    "pull_score": 0.0, "tcts_daily_avg": 500.0, "case_handling_disabled": 0, "system_flagged": 0,
    "drive_system_not_ok": 0, "wrangle_count": 0, "suspect_count": 0, "chd_count": 0, "iwe_count": 0,
    "has_disconnect_issue": 0, "red_flag": 0, "bot_state": "UNKNOWN", "stale_group": None, "safety_reason": None,
}


@pytest.mark.parametrize(
    "changes,reason",
    [
        ({}, None),
        ({"pull_score": 50.04, "tcts_daily_avg": 99.9}, "Pull Score + TCTS OK"),
        ({"pull_score": 50.0, "tcts_daily_avg": 99.9}, None),
        ({"pull_score": 60.0, "tcts_daily_avg": 100.0}, None),
        ({"pull_score": 60.0, "tcts_daily_avg": None}, None),
        ({"case_handling_disabled": 1}, "Case Handling Disabled"),
        ({"case_handling_disabled": 1, "pull_score": 60.0, "tcts_daily_avg": 1.0}, "Pull Score + TCTS OK"),
        ({"system_flagged": 1}, "System Flagged"),
        ({"drive_system_not_ok": 1}, None),
        ({"wrangle_count": 3}, "WRANGLE Count >= 3"),
        ({"wrangle_count": 2}, None),
        ({"suspect_count": 20}, "SUSPECT Count >= 20"),
        ({"has_disconnect_issue": 1}, "Disconnect Issue"),
        ({"red_flag": 1}, "Red Flag Trigger"),
        ({"chd_count": 1, "bot_state": "Disabled"}, "Disabled + CHD"),
        ({"chd_count": 1}, None),
        ({"iwe_count": 1, "bot_state": "Disabled"}, "Disabled + IWE"),
        ({"iwe_count": 1, "chd_count": 1, "bot_state": "Disabled"}, "Disabled + CHD"),
        ({"stale_group": 7}, "Stale Case"),
        ({"stale_group": 7, "safety_reason": "x"}, None),
    ],
)
def test_verdict(spark, changes, reason):
    schema = ", ".join(
        f"{n} {'string' if n in ('bot_state', 'safety_reason') else 'bigint' if n == 'stale_group' else 'double' if isinstance(v, float) else 'int'}"
        for n, v in QUIET.items()
    )
    df = spark.createDataFrame([tuple({**QUIET, **changes}.values())], schema)
    assert rows(verdict(df), "valid_removal", "valid_removal_reason") == [(int(reason is not None), reason)]


def test_first_match_goes_on_past_null_conditions(spark):
    df = spark.createDataFrame([(None,), (1,)], "a int")
    rules = [("one", F.col("a") == 1), ("rest", F.lit(True))]
    assert rows(df.select(first_match(rules).alias("r"))) == [("one",), ("rest",)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_levels_raise_in_either_mode(spark, ansi):
    errors = frame(spark, "bot_errors", [{"bot_id": 1, "datetime": t("14 10:00"), "level": "abc"}])
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert classified_errors(errors, "2024-01-15 00:00:00").count() == 0
        with pytest.raises(Exception, match="level is not a number: abc"):
            classified_errors(errors, "2024-01-15 00:00:00", strict=True).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
