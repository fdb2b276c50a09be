import pytest
from conftest import SITES, frame, rows, t
from pyspark.sql import functions as F

from rovelog.operators.keyed import join_spread, lookup
from rovelog.operators.sites import short_site_codes, site_report, to_site_local, union_sites
from rovelog.operators.timeline import cell_of
from rovelog.sources.sinks import shared_folder, write_by_site, write_report
from rovelog.sources.tables import SCHEMAS, FleetTables, checked, load_fleet, read_table, schema_of, site_removals


def sample(spark):
    return spark.createDataFrame(
        [("NO", 1, t("2024-07-01 12:00")), ("SO", 2, t("2024-07-01 12:00")), ("SO", 3, t("2024-01-01 12:00")),
         ("??", 4, t("2024-01-01 12:00"))],
        "site_id string, bot_id long, ts timestamp_ntz",
    )


def test_report_lists_empty_sites(spark):
    found = site_report(frame(spark, "sites", SITES), sample(spark))
    assert rows(found, "site_short", "rows") == [("EM", 0), ("NO", 1), ("SO", 2)]


def test_site_local_time(spark, zone):
    found = to_site_local(sample(spark), "ts", frame(spark, "sites", SITES), cell_of(F.col("ts")))
    assert rows(found, "bot_id", "site_local_ts") == [
        (1, t("2024-07-01 05:00")), (2, t("2024-07-01 07:00")), (3, t("2024-01-01 06:00")), (4, None),
    ]


@pytest.mark.parametrize("small", [True, False])
def test_lookup_gives_the_same_by_broadcast_and_by_spreading(spark, small):
    full = spark.createDataFrame(
        [("north-one", i, t(f"10 {i % 24:02d}:00")) for i in range(50)] + [("nowhere", 99, t("10 10:00"))],
        "site_id string, bot_id long, ts timestamp_ntz",
    )
    found = short_site_codes(full, frame(spark, "sites", SITES), cell_of(F.col("ts")), small=small)
    assert rows(found, "site_id") == [("NO",)] * 50


def test_lookup_counts_before_it_broadcasts(spark):
    left = sample(spark)
    dim = spark.createDataFrame([("NO", "x"), ("SO", "y"), ("SO", "z")], "site_id string, v string")
    found = lookup(left, dim, ["site_id"], cell_of(F.col("ts")))
    assert rows(found, "bot_id", "v") == [(1, "x"), (2, "y"), (2, "z"), (3, "y"), (3, "z"), (4, None)]
    assert rows(join_spread(left, dim, ["site_id"], cell_of(F.col("ts")), "left"), "bot_id", "v") == rows(found, "bot_id", "v")


def test_union_sites_tags_rows(spark):
    one = sample(spark).drop("site_id")
    assert union_sites({"A": one, "B": one}).groupBy("site_id").count().count() == 2


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_write_and_read_back(spark, fmt):
    df = sample(spark).withColumn("removed_timestamp_est", F.col("ts").cast("string"))
    path = shared_folder(spark)
    write_by_site(df, path, fmt)
    back = spark.read.format(fmt).option("header", True).schema(df.schema).load(path)
    assert rows(back, *df.columns) == rows(df)
    sub = spark.read.format(fmt).option("header", True).load(f"{path}/site_id=SO")
    assert sub.count() == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_by_site(df, path, fmt)


def test_report_has_a_dwell_folder(spark):
    df = sample(spark).withColumn("removed_timestamp_est", F.col("ts").cast("string"))
    path = shared_folder(spark)
    write_report(df, spark.range(3), path)
    assert spark.read.parquet(f"{path}/dwell").count() == 3
    assert spark.read.parquet(f"{path}/compliance").count() == 4


def test_schema_check(spark):
    with pytest.raises(ValueError, match="action string .found nothing."):
        checked(frame(spark, "removals").drop("action"), "removals")
    with pytest.raises(ValueError, match="botnumber bigint .found string."):
        checked(frame(spark, "removals").withColumn("botnumber", F.lit("1")), "removals")


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_types_that_fit_are_converted_without_loss(spark, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        raw = spark.createDataFrame([(7, 1705312800123456, 3)], "id int, us long, d int").select(
            F.lit("NO").alias("site_id"),
            F.col("id").cast("decimal(38,0)").alias("botnumber"),
            F.timestamp_micros("us").alias("timestamp"),
            F.lit("Removed").alias("action"),
        )
        found = checked(raw, "removals", zone="America/New_York")
        assert found.dtypes == [(f.name, f.dataType.simpleString()) for f in schema_of("removals")]
        # 2024-01-15 10:00:00.123456 UTC
        assert rows(found, "botnumber", "timestamp") == [(7, t("2024-01-15 05:00:00.123456"))]
        large = raw.withColumn("botnumber", F.lit("99999999999999999999").cast("decimal(38,0)"))
        with pytest.raises(Exception, match="botnumber does not fit bigint"):
            checked(large, "removals").collect()
        with pytest.raises(ValueError, match="found decimal.10,2."):
            checked(raw.withColumn("botnumber", F.lit(1).cast("decimal(10,2)")), "removals")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_fleet_from_views(spark):
    for name in SCHEMAS:
        frame(spark, name, SITES if name == "sites" else ()).createOrReplaceTempView(name)
    try:
        assert load_fleet(spark, fmt="table").sites.count() == 3
    finally:
        for name in SCHEMAS:
            spark.catalog.dropTempView(name)


def test_removals_of_each_site(spark):
    one = frame(spark, "removals", [{"botnumber": 1, "timestamp": t("10 10:00"), "action": "Removed"}]).drop("site_id")
    found = site_removals({"NO": one, "SO": one.withColumn("botnumber", F.lit(2))})
    assert rows(found, "site_id", "botnumber") == [("NO", 1), ("SO", 2)]


def test_day_folders_outside_the_period_are_not_read(spark, tmp_path):
    from rovelog.plans.compliance import compliance

    data = [{"bot_id": 1, "timestamp": t(f"{d:02d} 09:30"), "bot_state": "Disabled"} for d in range(1, 21)]
    health = frame(spark, "bot_health", data)
    health.withColumn("day", F.to_date("timestamp")).write.partitionBy("day").parquet(str(tmp_path / "health"))
    back = read_table(spark, "bot_health", path=str(tmp_path / "health"), day="day")
    removals = frame(spark, "removals", [{"site_id": "NO", "botnumber": 1, "timestamp": t("15 05:00"), "action": "Removed"}])
    empty = {n: frame(spark, n, SITES if n == "sites" else ()) for n in SCHEMAS}
    tables = FleetTables(**{**empty, "bot_health": back, "removals": removals})
    found = compliance(tables, "2024-01-16 00:00:00", 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "FileScan" in line and "bot_state" in line)
    assert "PartitionFilters: [isnotnull(day" in scan and ">= 2024-01-12" in scan
    assert rows(found, "bot_state") == [("Disabled",)]


def test_load_fleet_from_files(spark):
    from rovelog.sources.tables import SCHEMAS, FleetTables, checked, load_fleet, read_table, schema_of, site_removals

    base = shared_folder(spark)
    for name in SCHEMAS:
        frame(spark, name, SITES if name == "sites" else ()).write.parquet(f"{base}/{name}")
    tables = load_fleet(spark, base)
    assert tables.sites.count() == 3
    assert tables.bot_disconnect.columns[0] == "Bot Id"


def test_the_shared_folder_is_named_or_an_error(spark, monkeypatch, tmp_path):
    from rovelog.sources import sinks

    assert sinks.shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))

    class Session:
        class conf:
            @staticmethod
            def get(key, default):
                return None

        class sparkContext:
            named = None

            @classmethod
            def getCheckpointDir(cls):
                return cls.named

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sinks.shared_folder(Session())
    monkeypatch.setattr(Session.sparkContext, "named", "hdfs://shared/dir/")
    assert sinks.shared_folder(Session()).startswith("hdfs://shared/dir/rovelog-steps/")
    assert "tempfile" not in open(sinks.__file__).read()


def test_a_written_report_leaves_no_steps(spark, tmp_path):
    from pathlib import Path

    from rovelog.sources.sinks import written

    df = sample(spark).withColumn("removed_timestamp_est", F.col("ts").cast("string"))
    step = written(df)
    folder = Path(step.inputFiles()[0].removeprefix("file://").removeprefix("file:")).parent
    assert folder.exists()
    write_report(step, spark.range(1), str(tmp_path / "kept"), keep_steps=True)
    assert folder.exists()
    write_report(step, spark.range(1), str(tmp_path / "done"))
    assert not folder.exists() and spark.read.parquet(str(tmp_path / "done" / "compliance")).count() == 4
