"""Run queries in Spark and DuckDB and compare the rows as bags.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def difference(df, relation) -> str:
    """Empty if both have the same columns and the same rows."""
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(set(df.columns) ^ set(relation.columns))}"
    mine, theirs = bag(df.columns, df.collect()), bag(relation.columns, relation.fetchall())
    if mine == theirs:
        return ""
    only, missing = mine - theirs, theirs - mine
    return (
        f"{sum(only.values())} extra of {sum(mine.values())}, {sum(missing.values())} missing of "
        f"{sum(theirs.values())}; columns {sorted(df.columns)}; extra {list(only)[:2]}; missing {list(missing)[:2]}"
    )


def main() -> int:
    from checks.catalog import QUERIES
    from checks.oracle import ORACLE
    from checks.session import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con, bad = session(), duck(sf_dir), 0
    for name in names:
        t = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            result = difference(df, con.sql(ORACLE[name]))
        except Exception as e:  # report and go on with the next query
            result = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += bool(result)
        print(f"{name:24s} {time.time() - t:6.1f}s  {result or 'equal'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
