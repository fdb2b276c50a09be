"""Sharding along a Hilbert curve, in DataFrame functions alone.

Several metadata dimensions are quantised to a few bits each; the cells of that grid are put in the
order of a Hilbert curve, which keeps neighbours in space near each other, and the ordered rows are
cut into runs of equal count.  A shard then covers a compact part of the grid, so a filter on any
of the dimensions leaves out whole shards (and row groups, by their minima and maxima).

The grid has a fixed number of cells.  Only the table of cells is sorted in one task; rows are
ranked by counts per cell and bucket, so that a cell holding a third of all rows is spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rovelog.llm.common import ranked, table

SHARDS = 8
#: Bits of each dimension; three dimensions give 4096 cells.
BITS = 4


def hilbert_index(levels: list[Column], bits: int) -> Column:
    """The place on the Hilbert curve of a cell given by its level, 0 to 2**bits - 1, in each dimension.

    Bit by bit from the highest, the lower bits of the axes are exchanged or inverted, then the
    Gray code is undone and the bits of the axes are interleaved.
    """
    n = len(levels)
    state = F.array(*[level.cast("long") for level in levels])

    def turned(axes: Column, bit: int, i: int) -> Column:
        low = (1 << bit) - 1
        here = F.element_at(axes, i + 1)
        swap = F.element_at(axes, 1).bitwiseXOR(here).bitwiseAND(F.lit(low))
        inverted = F.transform(axes, lambda v, k: F.when(k == 0, v.bitwiseXOR(F.lit(low))).otherwise(v))
        swapped = F.transform(axes, lambda v, k: F.when((k == 0) | (k == i), v.bitwiseXOR(swap)).otherwise(v))
        return F.when(here.bitwiseAND(F.lit(1 << bit)) != 0, inverted).otherwise(swapped)

    steps = F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)])

    def step(axes: Column, at: Column) -> Column:
        out = axes
        for bit in range(bits - 1, 0, -1):
            for i in range(n):
                out = F.when((at["bit"] == bit) & (at["i"] == i), turned(axes, bit, i)).otherwise(out)
        return out

    axes = F.aggregate(steps, state, step)
    # Gray encoding: each axis takes the exclusive or of all axes before it and its own
    gray = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: F.aggregate(F.slice(axes, F.lit(1), k), F.lit(0).cast("long"), lambda a, v: a.bitwiseXOR(v)))
    last = F.element_at(gray, -1)
    flip = F.aggregate(
        F.array(*[F.lit(b) for b in range(bits - 1, 0, -1)]) if bits > 1 else F.expr("array()").cast("array<int>"),
        F.lit(0).cast("long"),
        lambda t, b: F.when(
            F.getbit(last, b) == 1, t.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), b) - 1)
        ).otherwise(t),
    )
    done = F.transform(gray, lambda v: v.bitwiseXOR(flip))
    places = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i + 1).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])
    return F.aggregate(
        places, F.lit(0).cast("long"), lambda total, p: total * 2 + F.getbit(F.element_at(done, p["i"]), p["b"]).cast("long")
    )


def hilbert_shards(
    rows: DataFrame, levels: list[Column], key: list[Column], shards: int = SHARDS, bits: int = BITS
) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: runs of the Hilbert order whose counts differ by one at most.

    ``levels`` quantise the dimensions to 0 .. 2**bits - 1; ``key`` orders rows within a cell (rows
    with equal keys come in any order).  Slots are gapless from 0 in each shard.  An empty frame stays empty.
    """
    spark = rows.sparkSession
    n = len(levels)
    packed = F.lit(0).cast("long")
    for level in levels:
        packed = packed * (1 << bits) + F.least(F.greatest(F.coalesce(level.cast("long"), F.lit(0)), F.lit(0)), F.lit((1 << bits) - 1))
    cells = spark.range(1 << (bits * n)).select(  # the whole grid, by rule; 2 ** (bits * n) rows
        F.col("id").alias("_grid"),
        hilbert_index(
            [F.call_function("shiftright", F.col("id"), F.lit(bits * (n - 1 - i))) % (1 << bits) for i in range(n)], bits
        ).alias("_curve"),
    )
    placed = rows.withColumn("_grid", packed).join(F.broadcast(cells), "_grid").drop("_grid")
    order = ranked(placed, "_curve", key, "_rank")
    small = F.floor(F.col("_rank_of") / shards)
    large_shards = F.col("_rank_of") % shards
    in_large = F.col("_rank") < large_shards * (small + 1)
    after = F.col("_rank") - large_shards * (small + 1)
    return (
        order.withColumn(
            "shard",
            F.when(in_large, F.floor(F.col("_rank") / (small + 1))).otherwise(large_shards + F.floor(after / small)).cast("int"),
        )
        .withColumn("slot", F.when(in_large, F.col("_rank") % (small + 1)).otherwise(after % small).cast("long"))
        .drop("_rank", "_rank_of", "_curve")
    )


def hashed_level(value: Column, bits: int = BITS) -> Column:
    """A category by its hash: equal values share a level; null is level 0."""
    return F.when(value.isNull(), 0).otherwise(F.pmod(F.crc32(value.cast("string")), F.lit(1 << bits)))


def size_level(size: Column, bits: int = BITS) -> Column:
    """A size by its binary logarithm."""
    return F.least(F.floor(F.log2(F.greatest(size, F.lit(1)))), F.lit((1 << bits) - 1))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, its rows in slot order."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard for every row of ``docs``.

    The dimensions are language, source and size of text.  A null text has size 1 and the crc32 of
    the empty text; null metadata is a value like others.  Rows that agree in doc_id, size and crc32
    come in any order among themselves.
    """
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    slim = docs.select(
        "doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        hashed_level(F.col("lang")).alias("_lang"), hashed_level(F.col("source")).alias("_source"),
    ).withColumn("_size", size_level(F.col("size")))
    placed = hilbert_shards(
        slim, [F.col("_lang"), F.col("_source"), F.col("_size")], [F.col("doc_id"), F.col("text_crc32"), F.col("size")], shards
    )
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
