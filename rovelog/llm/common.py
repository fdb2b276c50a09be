"""What several operators of this package need: tables, stored steps, ranks and connected components.

Long plans are cut by writing a step as Parquet below the folder that
``spark.checkpoint.dir`` names and reading it back.  Unlike cached or locally
checkpointed blocks such files outlive the executors that wrote them.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar
from typing import TypeVar

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

T = TypeVar("T")

#: The steps stored by the call of :func:`stored_alone` that is running.
_PASSING: ContextVar[list[DataFrame] | None] = ContextVar("passing", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share.

    ``spark.checkpoint.dir`` of the session, else the context's checkpoint folder.  Only a
    local session, whose executors are the driver, may go without either.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    named = f"file://{tempfile.mkdtemp(prefix='rovelog-')}"
    spark.sparkContext.setCheckpointDir(named)
    return spark.sparkContext.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, with no lineage left."""
    path = f"{shared_dir(df.sparkSession)}/steps/{uuid.uuid4().hex}"
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._stored_at = path
    passing = _PASSING.get()
    if passing is not None:
        passing.append(found)
    return found


def stored_alone(make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, stored; the steps that ``make`` stored on the way are removed.

    Only the result may be used afterwards.
    """
    outer = _PASSING.set([])
    try:
        found, passing = stored(make()), _PASSING.get()
    finally:
        _PASSING.reset(outer)
    for step in passing:
        if step is not found:
            dropped(step)
    if _PASSING.get() is not None:
        _PASSING.get().append(found)
    return found


def dropped(df: DataFrame) -> None:
    """Removes the files of a stored step that no later plan reads."""
    path = getattr(df, "_stored_at", None)
    if path:
        jvm, context = df.sparkSession._jvm, df.sparkSession.sparkContext
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores in front until none of them is a column of ``df``."""
    taken, front = {c.lower() for c in df.columns}, ""
    while any(f"{front}{name}".lower() in taken for name in names):
        front += "_"
    return [f"{front}{name}" for name in names]


#: Rows that go to a Python worker at once where the session leaves Spark's default: texts are long.
BATCH_ROWS = "1000"


def small_batches(spark: SparkSession) -> None:
    """Bounds what a worker holds of long texts, unless the session sets its own batch size."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, BATCH_ROWS)


def shipped(spark: SparkSession, value: T) -> Callable[[], T]:
    """``value`` for the tasks: broadcast once, unpacked once a task.  The caller bounds its size."""
    sent, unpacked = spark.sparkContext.broadcast(cloudpickle.dumps(value)), []

    def get() -> T:
        if not unpacked:
            unpacked.append(cloudpickle.loads(sent.value))
        return unpacked[0]

    return get


#: Bytes up to which a counted table is broadcast in :func:`join_counted`.
BROADCAST_BYTES = 32 << 20


def join_counted(large: DataFrame, small: DataFrame, on: Column, how: str, row_bytes: int | Column) -> DataFrame:
    """Joins a stored ``small``: broadcast if its rows fit BROADCAST_BYTES, counted or added up, else shuffled.

    ``row_bytes`` is the size of each row, a column of ``small`` where rows carry arrays.  The
    result is the same either way; only the large side's shuffle is saved.
    """
    size = small.count() * row_bytes if isinstance(row_bytes, int) else small.agg(F.sum(row_bytes)).first()[0] or 0
    fits = size <= BROADCAST_BYTES
    return large.join(F.broadcast(small) if fits else small.hint("shuffle_hash"), on, how)


def fold(column: str | Column, folds: int) -> Column:
    """crc32 of an id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string")) % folds


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def ranked(df: DataFrame, cell: str, order: list[Column], name: str, spread: int = 1024) -> DataFrame:
    """Adds ``name``, the gapless rank from 0 in the order of ``cell``, and ``name``_of, the number of rows.

    No task holds a whole cell.
    ``cell`` must have few distinct values (a table over them is sorted in one task).  Rows of a
    cell are dealt to ``spread`` buckets by the hash of ``order``; a bucket is sorted in one task,
    and offsets of cells and buckets come from counts.  Within a cell the order is by bucket, then
    by ``order``.
    """
    rows = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(spread)))
    counts = rows.groupBy(cell, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    of_cell = counts.groupBy(cell).agg(F.sum("_n").alias("_cell_n"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    of_cell = of_cell.withColumn(
        "_cell_from", F.coalesce(F.sum("_cell_n").over(before.orderBy(cell)), F.lit(0))
    ).withColumn(f"{name}_of", F.sum("_cell_n").over(whole))
    of_cell = of_cell.select(F.col(cell).alias("_cell"), "_cell_from", f"{name}_of")
    in_cell = Window.partitionBy(cell).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.withColumn("_in_cell", F.coalesce(F.sum("_n").over(in_cell), F.lit(0)))
        .join(F.broadcast(of_cell), F.col(cell).eqNullSafe(F.col("_cell")))
        .select(
            F.col("_cell").alias("_cell"),
            F.col("_bucket").alias("_b"),
            (F.col("_cell_from") + F.col("_in_cell")).alias("_from"),
            f"{name}_of",
        )
    )
    numbered = rows.withColumn(
        "_nth", F.row_number().over(Window.partitionBy(cell, "_bucket").orderBy(*order)) - 1
    )
    return (
        numbered.join(offsets, F.col(cell).eqNullSafe(F.col("_cell")) & (F.col("_bucket") == F.col("_b")))
        .withColumn(name, F.col("_from") + F.col("_nth"))
        .drop("_bucket", "_cell", "_b", "_from", "_nth")
    )


def block_tasks(rows: DataFrame, place: list[str], chosen: str, size: int) -> DataFrame:
    """``rows`` dealt to tasks (``place``, i, j) so that the ``chosen`` of a place meet all rows of it.

    A place that fits one task is one.  Else its chosen rows and all its rows are cut into blocks
    of about ``size`` by hash of ``id``, and every two blocks share a task.  ``target`` marks the
    chosen in their first role; a chosen row is there in its second role as well.
    """
    parts = lambda n: F.greatest(F.lit(1), F.ceil(n / size)).cast("int")
    sizes = rows.groupBy(*place).agg(
        parts(F.count_if(chosen)).alias("_chosen_blocks"), parts(F.count(F.lit(1))).alias("_all_blocks")
    )
    sized = rows.join(sizes, place)
    block = lambda of: F.pmod(F.xxhash64("id", F.lit(2)), F.col(of)).cast("int")
    each = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    targets = sized.where(chosen).withColumn("j", each("_all_blocks")).withColumn("i", block("_chosen_blocks"))
    others = sized.withColumn("i", each("_chosen_blocks")).withColumn("j", block("_all_blocks"))
    both = targets.withColumn("target", F.lit(True)).unionByName(others.withColumn("target", F.lit(False)))
    return both.drop("_chosen_blocks", "_all_blocks", chosen)


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): the least node of its connected group.

    Alternating large-star and small-star steps.  Each step takes a minimum per node, combined
    before the shuffle, and links neighbours to it, so that a node with very many links is never
    collected.  Each round is stored; the number of rounds grows with the logarithm of the size.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges, before = stored(ordered.distinct()), None
    for _ in range(rounds):
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        ).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            )).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        small = stored(small)
        dropped(edges)
        edges = small
    else:
        raise RuntimeError(f"components are not found after {rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
