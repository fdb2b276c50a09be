from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.session import session  # noqa: E402
from rovelog.sources.tables import SCHEMAS, FleetTables, schema_of  # noqa: E402

ZONES = ("UTC", "America/New_York", "Asia/Kolkata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session(
        "4",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__python__sql__dataFrameDebugging__enabled="false",
    )
    yield s
    s.stop()


@pytest.fixture(params=ZONES)
def zone(request, spark):
    """Runs a test under several session time zones."""
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def t(text: str) -> datetime:
    """``2024-01-10 10:00[:00[.5]]`` or ``10 10:00`` for a day of January 2024."""
    if text[2] == " ":
        text = f"2024-01-{text}"
    return datetime.fromisoformat(text)


def frame(spark, table: str, rows=()):
    """A fleet table from dicts; columns left out are null."""
    schema = schema_of(table)
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def fleet(spark, **tables) -> FleetTables:
    tables.setdefault("sites", SITES)
    return FleetTables(**{name: frame(spark, name, tables.get(name, ())) for name in SCHEMAS})


SITES = [
    {"site_full": "north-one", "site_short": "NO", "tz": "America/Phoenix"},
    {"site_full": "south-two", "site_short": "SO", "tz": "America/Chicago"},
    {"site_full": "empty-three", "site_short": "EM", "tz": "America/New_York"},
]


def rows(df, *columns):
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))
