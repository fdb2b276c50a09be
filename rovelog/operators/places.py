"""Places of rows in a global order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rovelog.sources.sinks import written

# monotonically_increasing_id: the partition above these bits, the row of the partition in them
_ROW_BITS = 33


def in_order(df: DataFrame, name: str = "place") -> DataFrame:
    """``df`` with the place from 0 of each row in its own order, as ``orderBy`` gave it.

    Sorted rows lie in range partitions, each in order.  So a place is the row's number in its
    partition plus the rows of the partitions before, and these are added up from one
    row a partition; no row moves, and no task sees more than its partition.  The rows are written to
    the shared folder first, so that numbers and counts are of the same run.  A column called
    ``name`` is replaced; an empty frame stays empty.
    """
    id_, part, start = (_free(df, c) for c in ("_id", "_part", "_start"))
    rows = written(df.withColumn(id_, F.monotonically_increasing_id())).withColumn(part, F.shiftright(id_, _ROW_BITS))
    counts = rows.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # over one row a partition
    starts = counts.select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(start))
    nth = F.col(id_).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return rows.join(F.broadcast(starts), part).withColumn(name, F.col(start) + nth).drop(id_, part, start)


def _free(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name
