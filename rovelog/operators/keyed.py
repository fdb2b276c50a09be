"""Helpers that keep hot keys and large groups of copies off a single task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COPIES = "copies"
_COPY_BLOCK = 4096


def all_known(*columns: str) -> Column:
    """No column is null.  Unlike ``dropna`` this reaches the scan, column by column."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def collapse(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Equal rows become one row with a ``copies`` count (combined map-side)."""
    n = F.sum(COPIES) if COPIES in df.columns else F.count(F.lit(1))
    return df.groupBy(*columns).agg(n.alias(COPIES))


def expand(df: DataFrame, number: str = "copy_number", most: int | None = None) -> DataFrame:
    """Undo :func:`collapse`; ``number`` counts the copies of a row from 1.

    Copies are made in blocks and the blocks are dealt out first, so a row that
    stands for a billion copies neither builds one array nor loads one task.  A caller
    that knows that no row stands for more than ``most`` copies saves this shuffle
    where they fit one block.
    """
    if most is not None and most <= _COPY_BLOCK:
        return df.withColumn(number, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(COPIES)))).drop(COPIES)
    blocks = df.withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.expr(f"({COPIES} - 1) div {_COPY_BLOCK}")))
    ).repartition(*[F.col(c) for c in _spread_columns(df)], F.col("_block"))
    first = F.col("_block") * _COPY_BLOCK
    last = F.least(F.col(COPIES), first + _COPY_BLOCK)
    return blocks.withColumn(number, F.explode(F.sequence(first + 1, last))).drop("_block", COPIES)


def _spread_columns(df: DataFrame) -> list[str]:
    # NTZ, numbers and text hash well; maps cannot be hashed at all
    return [name for name, kind in df.dtypes if not kind.startswith(("map", "variant"))]


def join_spread(
    left: DataFrame, right: DataFrame, keys: Sequence[str], spread: Column, how: str = "left", places: DataFrame | None = None
) -> DataFrame:
    """Join ``right`` on ``keys`` when one key may hold a third of ``left``.

    ``spread`` (a time cell) cuts a key of ``left`` into many parts.  The matches of
    ``right`` are first copied to the parts that exist, then the big side joins on
    key and part, so no task sees a whole hot key.  ``places`` may be a cheaper frame with the
    same keys and what ``spread`` reads, used to find the parts, so that ``left`` is planned once.
    """
    left = left.withColumn("_part", spread)
    parts = (left if places is None else places.withColumn("_part", spread)).select(*keys, "_part").distinct()
    matched = parts.join(right, list(keys))
    return left.join(matched, [*keys, "_part"], how).drop("_part")


def is_small(df: DataFrame, max_rows: int = 200_000) -> bool:
    """Counts; only one number a partition is sent on."""
    return df.count() <= max_rows


def lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread: Column,
    how: str = "left",
    small: bool | None = None,
) -> DataFrame:
    """Join a dimension: broadcast when counted to be small, otherwise :func:`join_spread`."""
    if is_small(right) if small is None else small:
        return left.join(F.broadcast(right), list(keys), how)
    return join_spread(left, right, keys, spread, how)


def key_total(df: DataFrame, keys: Sequence[str], part: Column, value: Column, name: str) -> DataFrame:
    """Add the sum of ``value`` over the whole key to every row, null keys being one key.

    Sums per key and part are combined map-side; only those few rows per key are
    brought together, and the rows themselves meet the total on key and part.
    """
    df = df.withColumn("_part", part)
    sums = (
        df.groupBy(*keys, "_part")
        .agg(F.sum(value).alias("_sum"))
        .withColumn(name, F.sum("_sum").over(Window.partitionBy(*keys)))
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_part").alias("_p"), name)
    )
    same = F.col("_part") == F.col("_p")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    return df.join(sums, same).drop("_part", "_p", *[f"_k_{k}" for k in keys])
