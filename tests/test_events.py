import pytest
from conftest import rows, t

from rovelog.operators.events import flag_new_events, recent_events, session_total
from rovelog.operators.keyed import collapse, expand


def events(spark, *items, schema="site_id string, bot_id long, event_ts timestamp_ntz"):
    return spark.createDataFrame([("A", *i) if len(i) == 2 else i for i in items], schema)


def flags(spark, *times):
    df = events(spark, *[(1, t(x)) for x in times])
    found = flag_new_events(df, ["site_id", "bot_id"], "event_ts", 30)
    return [r[1] for r in sorted(rows(found, "event_ts", "is_new_event"), key=lambda r: (r[0], -r[1]))]


@pytest.mark.parametrize(
    "times,expected",
    [
        (["10 10:00", "10 10:20", "10 10:40"], [1, 0, 0]),
        (["10 10:00:00", "10 10:30:00"], [1, 1]),
        (["10 10:00:59", "10 10:30:00"], [1, 1]),
        (["10 10:00:00", "10 10:29:59"], [1, 0]),
        (["10 10:00", "10 10:00"], [1, 0]),
        (["10 10:00", "10 10:00", "10 10:00", "10 10:40", "10 10:40"], [1, 0, 0, 1, 0]),
        (["10 23:50", "11 00:05", "12 00:00"], [1, 0, 1]),
    ],
)
def test_new_events(spark, times, expected):
    assert flags(spark, *times) == expected


def test_flags_do_not_depend_on_the_session_zone(spark, zone):
    assert flags(spark, "2024-03-10 01:59:30", "2024-03-10 02:29:00", "2024-03-10 03:30:00") == [1, 1, 1]


def test_same_machine_number_at_two_sites_and_null_machines(spark):
    df = events(
        spark,
        ("A", 1, t("10 10:00")), ("B", 1, t("10 10:10")),
        ("A", None, t("10 10:00")), ("A", None, t("10 10:10")),
    )
    found = flag_new_events(df, ["site_id", "bot_id"], "event_ts", 30)
    assert rows(found, "site_id", "bot_id", "is_new_event") == [
        ("A", 1, 1), ("A", None, 0), ("A", None, 1), ("B", 1, 1),
    ]
    total = session_total(found, ["site_id", "bot_id"], "event_ts")
    assert rows(total, "site_id", "bot_id", "removal_sessions") == [
        ("A", 1, 1), ("A", None, 1), ("A", None, 1), ("B", 1, 1),
    ]


def test_session_total_is_over_the_whole_key(spark):
    df = events(spark, *[(1, t(x)) for x in ("02 10:00", "02 10:10", "09 10:00", "10 10:00", "10 10:00")])
    found = session_total(flag_new_events(df, ["site_id", "bot_id"], "event_ts"), ["site_id", "bot_id"], "event_ts")
    assert [r[0] for r in rows(found, "removal_sessions")] == [3] * 5


def test_recent_events_window(spark):
    df = spark.createDataFrame(
        [(1, t(x), a) for x, a in [
            ("02 11:55", "Removed"), ("02 12:00", "Removed"), ("02 12:05", "Removed"), ("05 10:10", "Added"),
            ("20 10:00", "Removed")]],
        "bot_id long, timestamp timestamp_ntz, action string",
    )
    got = recent_events(df, "timestamp", "2024-01-15 12:00:00", 13, action="Removed")
    assert [r[0] for r in rows(got, "timestamp")] == [t("02 12:00"), t("02 12:05"), t("20 10:00")]
    got = recent_events(df, "timestamp", "2024-01-15 12:00:00", 13, action="Removed", until="2024-01-15 12:00:00")
    assert got.count() == 2


def test_collapse_and_expand_are_inverse_across_blocks(spark):
    df = spark.range(10_001).selectExpr("if(id < 9000, 1, id) as a")
    packed = collapse(df, ["a"])
    assert packed.where("a = 1").first()["copies"] == 9000
    back = expand(packed)
    assert back.count() == 10_001
    assert back.where("a = 1").selectExpr("min(copy_number)", "max(copy_number)", "count(distinct copy_number)").first()[
        :
    ] == (1, 9000, 9000)
