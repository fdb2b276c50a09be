from datetime import date, datetime

from conftest import frame, rows, t

from rovelog.operators.dwell import daily_snapshot, dwell_days, dwell_summary
from rovelog.operators.reinduct import weekly_reinduct


def health(spark, *samples):
    data = []
    for bot, at, moved, *state in samples:
        data.append(
            {"environment": "e", "bot_id": bot, "timestamp": t(at), "bot_location_changed": moved and t(moved),
             "health_state": state[0] if state else "Healthy"}
        )
    return frame(spark, "bot_health", data)


def test_snapshot_minutes(spark, zone):
    df = health(
        spark, *[(1, f"10 {x}", f"09 {x}") for x in ("23:04:59", "23:05:00", "23:55:59", "23:56:00", "22:30:00")]
    )
    assert rows(daily_snapshot(df), "event_date", "snapshot_time", "entry_time") == [
        (t("10 00:00"), t("10 23:05:00"), t("09 23:55:59"))
    ]


def test_unknown_and_null_states_are_ignored(spark):
    df = health(spark, (1, "10 23:10", "09 10:00", "Unknown"), (1, "10 23:20", "09 10:00", None))
    assert daily_snapshot(df).count() == 0


def test_dwell(spark, zone):
    df = health(
        spark,
        (1, "10 23:10", "09 22:59"),  # one calendar day
        (2, "10 23:10", "10 23:05"), (2, "10 23:40", "10 23:30"),  # moved after the snapshot
        (3, "10 23:10", None),
        (4, "10 23:10", "10 23:10"),
    )
    assert rows(dwell_days(daily_snapshot(df)), "bot_id", "dwell_days") == [(1, 1), (4, 0)]


def test_summary_window_and_mean(spark, zone):
    df = health(
        spark,
        (1, "02 23:10", "01 10:00"), (2, "02 23:10", "2023-12-31 10:00"), (3, "02 23:10", "2023-12-31 11:00"),
        (1, "01 23:10", "01 10:00"), (1, "15 23:10", "15 10:00"), (1, "16 23:10", "15 10:00"),
    )
    found = dwell_summary(df, date(2024, 1, 15), 13)
    assert [tuple(r) for r in found.collect()] == [
        ("e", datetime(2024, 1, 15), 1, 0.0),
        ("e", datetime(2024, 1, 2), 3, 5 / 3),
    ]


def moves(spark, *items):
    data = [{"site_id": "NO", "botnumber": b, "timestamp": t(x), "action": a} for b, x, a in items]
    return frame(spark, "removals", data)


def weeks(spark, *items):
    return weekly_reinduct(moves(spark, *items), date(2024, 1, 15), 13)


def test_pass_and_fail(spark, zone):
    found = weeks(
        spark,
        (1, "08 10:00", "Added"), (1, "09 10:00", "Removed"),
        (2, "08 10:00", "Removed"), (2, "09 10:00", "Added"),
        (3, "08 10:00", "Removed"), (3, "09 10:00", "Added"), (3, "10 10:00", "Removed"),
        (4, "07 23:00", "Added"), (4, "08 00:00", "Removed"),
        (5, "08 10:00", "Added"), (5, "08 10:00", "Removed"),
        (6, "08 10:00", "Added"), (6, "08 11:00", "Added"),
        (7, "08 10:00", "Other"),
        (None, "08 10:00", "Added"),
    )
    got = [tuple(r) for r in found.select("botnumber", "week_start", "inductions_per_week", "removals_per_week", "pass_fail").collect()]
    w = t("08 00:00")
    assert got == [
        (1, w, 1, 1, "Fail"), (2, w, 1, 1, "Pass"), (3, w, 1, 2, "Fail"), (4, w, 0, 1, "Pass"), (5, w, 1, 1, "Pass"),
        (6, w, 2, 0, "Pass"), (7, w, 0, 0, "Pass"), (None, w, 1, 0, "Pass"), (4, t("01 00:00"), 1, 0, "Pass"),
    ]


def test_window_ends(spark):
    found = weeks(
        spark, (1, "01 23:59:59", "Added"), (2, "02 00:00", "Added"), (3, "15 23:59:59", "Added"), (4, "16 00:00", "Added")
    )
    assert [r[0] for r in rows(found, "botnumber")] == [2, 3]
