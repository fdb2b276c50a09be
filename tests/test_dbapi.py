from __future__ import annotations

import json
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import SITES, frame, rows, t
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, IsNull, Not, StringContains
from pyspark.sql.types import DoubleType, LongType, StructType

from rovelog.plans.compliance import compliance
from rovelog.sources import dbapi
from rovelog.sources.tables import SCHEMAS, FleetTables, load_fleet, read_table

DRIVER = "file_warehouse:connect"


@pytest.fixture
def warehouse(spark, tmp_path):
    """Removals of three sites and of none, errors, and the other tables."""
    spark.sparkContext.addPyFile(str(Path(__file__).with_name("file_warehouse.py")))
    removals = [
        {"site_id": s, "botnumber": b, "timestamp": t(f"{10 + b % 5} 05:00"), "action": "Removed"}
        for b, s in enumerate(["NO", "SO", "EM", None] * 5)
    ]
    errors = [
        {"bot_id": b, "site_id": "north-one", "datetime": t(f"{10 + b % 5} 09:30"), "event": "Flicker", "level": str(b)}
        for b in range(20)
    ]
    tables = {"removals": removals, "bot_errors": errors, "sites": SITES}
    frames = {name: frame(spark, name, tables.get(name, ())) for name in SCHEMAS}
    for name, df in frames.items():
        df.repartition(1).write.parquet(str(tmp_path / name))
    return tmp_path, FleetTables(**frames)


def asked(folder):
    found = [tuple(json.loads(p.read_text())) for p in folder.glob("asked-*.json")]
    for p in folder.glob("asked-*.json"):
        p.write_text("[]")
    return [f for f in found if f]


def options(folder, **more):
    return {"connect": DRIVER, "connect.folder": str(folder), "dbtable": "main.removals", **more}


@pytest.mark.parametrize(
    "parts, count",
    [
        ({}, 1),
        ({"partition_column": "botnumber", "bounds": "[5, 10, 15]"}, 4),
        ({"partition_column": "botnumber", "bounds": "[]"}, 1),
        ({"partition_column": "site_id", "values": '["NO", "SO", "EM", null]'}, 4),
        ({"partition_column": "site_id", "bounds": '["NO"]'}, 2),
    ],
)
def test_parts_hold_each_row_once(spark, warehouse, parts, count):
    folder, tables = warehouse
    found = read_table(spark, "removals", "dbapi", batch_rows="3", **options(folder, **parts))
    assert found.rdd.getNumPartitions() == count
    assert rows(found) == rows(tables.removals)


def test_one_site_is_asked_for_by_one_connection(spark, warehouse):
    folder, tables = warehouse
    found = read_table(spark, "removals", "dbapi", **options(folder, partition_column="site_id", values='["SO"]'))
    assert rows(found) == rows(tables.removals.where("site_id = 'SO'"))
    assert [(sql.partition(" WHERE ")[2], values) for sql, values in asked(folder)] == [('("site_id" = ?)', ["SO"])]


@pytest.mark.parametrize(
    "wanted, said",
    [
        ("timestamp >= timestamp_ntz'2024-01-12 05:00:00'", '("timestamp" >= ?)'),
        ("site_id = 'NO'", '("site_id" = ?)'),
        ("site_id <> 'NO'", 'NOT ("site_id" = ?)'),
        ("botnumber in (1, 2, 99)", '("botnumber" IN (?, ?, ?))'),
        ("site_id is null", '("site_id" IS NULL)'),
        ("site_id > 'NO'", None),
        ("contains(site_id, 'O')", None),
    ],
)
def test_filters_reach_the_statement_or_stay_with_spark(spark, warehouse, wanted, said):
    folder, tables = warehouse
    found = read_table(spark, "removals", "dbapi", **options(folder, partition_column="botnumber", bounds="[7]"))
    assert rows(found.where(wanted)) == rows(tables.removals.where(wanted))
    statements = [sql for sql, _ in asked(folder)]
    assert len(statements) >= 2 and (said is None or all(said in sql for sql in statements))


def test_what_is_not_certain_is_not_said():
    types = {f.name: f.dataType for f in StructType.fromDDL("a bigint, d double, s string")}
    assert dbapi.condition(GreaterThan(("a",), 3), types) == ('"a" > ?', (3,))
    assert dbapi.condition(Not(In(("s",), ("x", "y"))), types) == ('NOT ("s" IN (?, ?))', ("x", "y"))
    for unsaid in (
        EqualTo(("d",), 1.0), GreaterThan(("s",), "x"), StringContains(("s",), "x"), EqualTo(("a",), None),
        In(("a",), (1, None)), In(("a",), ()), EqualTo(("a", "b"), 1), EqualTo(("z",), 1), Not(IsNull(("a",))), Not(GreaterThan(("a",), 1)),
    ):
        assert dbapi.condition(unsaid, types) is None
    assert dbapi.condition(IsNotNull(('d',)), types) == ('"d" IS NOT NULL', ())
    assert dbapi.quoted('odd "name"') == '"odd ""name"""'


def test_wrong_options_raise():
    for column, values, bounds in [(None, ["x"], None), ("a", None, None), ("a", [1], [2]), ("a", None, [2, 1]), ("a", None, [1, None])]:
        with pytest.raises(ValueError):
            dbapi.parts_of(column, values, bounds)
    with pytest.raises(ValueError, match="connect, dbtable"):
        dbapi.WarehouseReader(StructType(), {})


def test_decimals_fit_or_raise():
    assert dbapi.fitted(Decimal(7), LongType()) == 7 and dbapi.fitted(Decimal("0.5"), DoubleType()) == 0.5
    with pytest.raises(ValueError, match="7.5 does not fit bigint"):
        dbapi.fitted(Decimal("7.5"), LongType())


def test_a_fleet_in_a_warehouse_gives_the_same_report(spark, warehouse):
    folder, tables = warehouse
    sites = json.dumps([s["site_short"] for s in SITES])
    each = {
        "removals": {"partition_column": "site_id", "values": sites},
        "bot_errors": {"partition_column": "bot_id", "bounds": "[5, 10]"},
    }
    loaded = load_fleet(
        spark, "main", "dbapi", zones={"removals": "UTC"}, each=each, connect=DRIVER, **{"connect.folder": str(folder)}
    )
    found = compliance(loaded, "2024-01-20 00:00:00", 13)
    named = FleetTables(**{**vars(tables), "removals": tables.removals.where("site_id is not null")})
    expected = compliance(named, "2024-01-20 00:00:00", 13)
    assert expected.count() == 15 and rows(found) == rows(expected)
    said = [sql for sql, _ in asked(folder) if "bot_errors" in sql]
    assert said and all('"datetime" >' in sql for sql in said)
