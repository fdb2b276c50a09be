"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles, and a signature of minwise values, one for each of
COORDINATES hash functions.  In each of TREES independent trees a document starts at the root and
moves on by chosen minwise values: a node chooses one coordinate, or two with probability BRANCH,
and sends each of its documents to the child named by the document's minwise value there.  Which
coordinates a node chooses depends on the node alone, so a document finds its own way down without
seeing the others.  Documents that meet in a node DEPTH levels down are candidates; nodes with many
documents branch DEEPER levels more, RESTARTS times over by other coordinates.  Candidates are thinned by a sketch of the signatures and
confirmed on the full sets.

One tree keeps a pair of similarity s together over one level with probability
``(1 - BRANCH) s p + BRANCH (1 - (1 - s p)**2)``, p being that of the levels below; with the values
here a tree finds a pair of similarity 0.8 with probability 0.57 at least, and TREES trees with
0.9988 (:func:`recall`).  Where all nodes in which the two meet have many documents, RESTARTS keep it
at 0.9984 (:func:`found_below`).  Groups, of which most documents have several links, are found nearly always.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rovelog.llm.common import block_tasks, join_counted, small_batches, stored, stored_alone, table, unused
from rovelog.llm.linking import linked_groups

COORDINATES, TREES, DEPTH, DEEPER, BRANCH = 128, 8, 4, 6, 0.25
#: Times that a large node is branched anew, so that a pair which parts in one of them meets in another.
RESTARTS = 4
#: Sketch: the lowest 4 bits of every minwise value; two sets of similarity s agree in a share s + (1 - s) / 16.
NIBBLES = 16
#: Standard deviations below the expected agreement at which a candidate is given up: one in 30,000 links.
SLACK = 4.0
#: Shingles whose minwise values are computed at once.
CHUNK = 4096
#: Members that a task holds of either side when a large bucket is compared in blocks.
BLOCK = 512

_U = np.uint64
_MULTIPLIERS = (np.random.default_rng(20240130).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) << _U(1)) | _U(1)
_PLACES = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) << _U(1) | _U(1)


def recall(similarity: float, depth: int = DEPTH, trees: int = TREES, below: float = 1.0) -> float:
    """The probability that a pair of that similarity meets at the bottom of at least one tree.

    ``below`` is that of being found once they meet there.
    """
    p = below
    for _ in range(depth):
        p = (1 - BRANCH) * similarity * p + BRANCH * (1 - (1 - similarity * p) ** 2)
    return 1 - (1 - p) ** trees


def found_below(similarity: float) -> float:
    """The probability that a pair which meets in a large node meets again below it, in one restart at least."""
    return recall(similarity, DEEPER, RESTARTS)


def words_of(text: str | None) -> list[bytes]:
    """Words between the characters space and \\x09 to \\x0D, A-Z lower-cased, as UTF-8."""
    return (text or "").encode().lower().split()


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Distinct 64-bit hashes of runs of ``size`` words; with fewer words, of the whole sequence."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    run = min(size, len(words))
    total = np.full(len(words) - run + 1, _U(run))
    for k in range(run):
        total += hashes[k:len(words) - run + 1 + k] * _PLACES[k]
    return np.unique(_mixed(total))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
    return x ^ (x >> _U(29))


def signature(grams: np.ndarray) -> np.ndarray:
    """The minwise values of a set, which is not empty."""
    least = np.full(COORDINATES, np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(grams), CHUNK):
        values = (grams[at:at + CHUNK, None] * _MULTIPLIERS) >> _U(32)
        np.minimum(least, values.min(axis=0).astype(np.uint32), out=least)
    return least


def paths(nodes: np.ndarray, rows: np.ndarray, signatures: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes ``depth`` levels below ``nodes`` that the documents ``rows`` of them reach, and the documents."""
    for _ in range(depth):
        choice = _mixed(nodes + _U(0x51ED270B))
        both = (choice >> _U(20)) % _U(1000) < _U(int(1000 * BRANCH))
        parent = np.concatenate([nodes, nodes[both]])
        rows = np.concatenate([rows, rows[both]])
        coordinate = (np.concatenate([choice, (choice[both] >> _U(7)) + _U(1)]) % _U(COORDINATES)).astype(np.int64)
        value = signatures[rows, coordinate].astype(np.uint64)
        nodes = _mixed(parent * _U(0xD6E8FEB86659FD93) + _mixed(value + (coordinate.astype(np.uint64) << _U(33)) + _U(1)))
    return nodes, rows


def restarted(nodes: np.ndarray, rows: np.ndarray, signatures: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`paths`, DEEPER levels below ``nodes``, by RESTARTS independent ways."""
    anew = np.arange(RESTARTS, dtype=np.uint64)[:, None] * _U(0x9FB21C651E98DF25)
    return paths(_mixed(nodes + anew).ravel(), np.tile(rows, RESTARTS), signatures, DEEPER)


def described(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, key (of the word sequence), n, sketch, nodes and signature of every document."""
    small_batches(docs.sparkSession)
    key_type = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [words_of(t) for t in batch["text"]]
            sets = [shingles(w, size) for w in words]
            full = np.array([len(s) > 0 for s in sets], dtype=bool)
            found = np.stack([signature(s) if len(s) else np.zeros(COORDINATES, np.uint32) for s in sets])
            rows = np.tile(np.flatnonzero(full), TREES)
            roots = np.repeat(_mixed(np.arange(1, TREES + 1, dtype=np.uint64)), full.sum())
            nodes, rows = paths(roots, rows, found, DEPTH)
            order = np.argsort(rows, kind="stable")
            parts = np.split(nodes[order].view(np.int64), np.cumsum(np.bincount(rows, minlength=len(batch)))[:-1])
            nibbles = (found & np.uint32(15)).astype(np.uint64).reshape(len(batch), -1, 16)
            sketch = (nibbles << (np.arange(16, dtype=np.uint64) * _U(4))).sum(axis=2, dtype=np.uint64).view(np.int64)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "key": [key_of(w) for w in words],
                    "n": [len(s) for s in sets],
                    "sketch": list(sketch),
                    "nodes": [np.unique(p) for p in parts],
                    "signature": [s.tobytes() for s in found],
                }
            )

    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {key_type}, key binary, n long, sketch array<long>, nodes array<long>, signature binary"
    )


def key_of(words: list[bytes]) -> bytes:
    return hashlib.md5(b" ".join(words), usedforsecurity=False).digest()


def word_key(text: Column) -> Column:
    """The key of a text's word sequence, as in :func:`described`."""

    @F.pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([key_of(words_of(t)) for t in texts], dtype=object)

    return of(text)


def full_sets(docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """key and ``grams`` of the classes (key, rep), from the text of the document ``rep``."""
    wanted = stored(classes.select(F.col("rep").alias("_rep")).distinct())
    rows = join_counted(docs.select("doc_id", "text"), wanted, F.col("doc_id").eqNullSafe(F.col("_rep")), "left_semi", 24)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [words_of(t) for t in batch["text"]]
            yield pd.DataFrame(
                {"key": [key_of(w) for w in words], "grams": [shingles(w, size).view(np.int64) for w in words]}
            )

    return rows.select("text").mapInPandas(run, "key binary, grams array<long>")


def agreement(a: Column, b: Column) -> Column:
    """Coordinates whose sketches agree."""
    differing = F.lit(0)
    for at in range(COORDINATES // 16):
        x = a[at].bitwiseXOR(b[at])
        for shift in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        differing = differing + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return F.lit(COORDINATES) - differing


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of keys whose full sets have at least that similarity."""
    least = least_agreement(percent)
    side = lambda name, *columns: sets.select(
        F.col("key").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns]
    )
    likely = (
        pairs.join(side("a", "n", "sketch"), "a")
        .join(side("b", "n", "sketch"), "b")
        .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        .where(agreement(F.col("sketch_a"), F.col("sketch_b")) >= least)
        .select("a", "b", "n_a", "n_b")
    )
    shared = F.size(F.array_intersect("grams_a", "grams_b"))
    return (
        likely.join(side("a", "grams"), "a")
        .join(side("b", "grams"), "b")
        .where(100 * shared >= percent * (F.col("n_a") + F.col("n_b") - shared))
        .select("a", "b")
        .distinct()
    )


def least_agreement(percent: int) -> int:
    """Coordinates whose sketches must agree for a pair to be looked at."""
    expected = percent / 100 + (1 - percent / 100) / NIBBLES
    return int(COORDINATES * expected - SLACK * (COORDINATES * expected * (1 - expected)) ** 0.5)


def compared(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between minor members of a bucket and members of other groups, in blocks.

    A task holds two blocks of members with their full sets.  It writes no more links than it has
    members: a member is compared only with those it is not yet connected to.
    """
    tasks = block_tasks(rows, ["bucket"], "minor", BLOCK).join(sets.withColumnRenamed("key", "id"), "id")
    least = least_agreement(percent)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        asked, others = part[part["target"]], part[~part["target"]]
        ids = others["id"].to_numpy()
        sketches = np.stack(others["sketch"].to_numpy()).view(np.uint64) if len(others) else None
        sizes, grams = others["n"].to_numpy(), others["grams"].to_numpy()
        head = {name: group for name, group in zip(part["id"], part["group"])}
        parent = {group: group for group in head.values()}

        def root(group):
            while parent[group] != group:
                parent[group] = group = parent[parent[group]]
            return group

        links = []
        for name, size, sketch, own in zip(asked["id"], asked["n"], asked["sketch"], asked["grams"]):
            if sketches is None:
                break
            agree = _agreeing(np.asarray(sketch).view(np.uint64), sketches)
            near = (agree >= least) & (100 * np.minimum(sizes, size) >= percent * np.maximum(sizes, size))
            at = np.flatnonzero(near)
            for k in at[np.argsort(-agree[at], kind="stable")]:
                mine, theirs = root(head[name]), root(head[ids[k]])
                if mine == theirs:
                    continue
                shared = len(np.intersect1d(own, grams[k], assume_unique=True))
                if 100 * shared >= percent * (size + sizes[k] - shared):
                    parent[max(mine, theirs)] = min(mine, theirs)
                    links.append((name, ids[k]))
        return pd.DataFrame(links, columns=["a", "b"], dtype=object)

    return tasks.groupBy("bucket", "i", "j").applyInPandas(run, "a binary, b binary")


def _agreeing(sketch: np.ndarray, sketches: np.ndarray) -> np.ndarray:
    """:func:`agreement` of one sketch with each of many."""
    x = sketches ^ sketch
    x |= x >> _U(1)
    x |= x >> _U(2)
    return COORDINATES - np.bitwise_count(x & _U(0x1111111111111111)).sum(axis=1, dtype=np.int64)


def near_duplicates(docs: DataFrame, size: int, percent: int = 80) -> DataFrame:
    """doc_id, key, group, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text).

    ``key`` names the word sequence and ``group`` the connected group (null without words).  Documents with the same words in the same order are one class; each class enters the join
    once.  A document without words, or with a null text, is linked with nothing.  Documents with
    a null id take part; component_id is then the least id there is, or null.  kept is true where
    doc_id = component_id, for repeated rows in each.
    """
    found = stored(described(docs, size))
    classes = stored(
        found.where("n > 0").groupBy("key").agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("nodes").alias("nodes")
        )
    )
    members = classes.select(F.explode("nodes").alias("bucket"), F.col("key").alias("id"))
    meeting = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("bucket")
    members = stored(members.join(meeting, "bucket"))
    candidates = stored(classes.join(members.select(F.col("id").alias("key")).distinct(), "key").select("key", "rep", "n", "sketch"))
    sets = stored(candidates.join(full_sets(docs, candidates, size).dropDuplicates(["key"]), "key").drop("rep"))

    def deepen(nodes: DataFrame) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                values = np.stack([np.frombuffer(s, dtype=np.uint32) for s in batch["signature"]])
                start = batch["bucket"].to_numpy(dtype=np.int64).view(np.uint64)
                below, rows = restarted(start, np.arange(len(batch)), values)
                ids, groups = (batch[name].to_numpy()[rows] for name in ("id", "group"))
                yield pd.DataFrame({"bucket": below.view(np.int64), "id": ids, "group": groups}).drop_duplicates()

        wanted = nodes.select(F.col("id").alias("key")).distinct()
        signatures = found.select("key", "signature").join(wanted, "key").dropDuplicates(["key"]).withColumnRenamed("key", "id")
        return nodes.join(signatures, "id").mapInPandas(run, "bucket long, id binary, group binary")

    groups = linked_groups(
        members, lambda pairs: confirmed(pairs, sets, percent), deepen, lambda rows: compared(rows, sets, percent)
    )
    label = groups.select(F.col("node").alias("key"), "component").join(classes.select("key", "rep"), "key")
    least = label.groupBy("component").agg(F.min("rep").alias("least"))
    of_class = (
        classes.select("key", "rep")
        .join(label.join(least, "component").select("key", "least", "component"), "key", "left")
        .select("key", F.coalesce("component", "key").alias("group"), F.coalesce("least", "rep").alias("least"))
    )
    return found.select("doc_id", "key", "n").join(of_class, "key", "left").select(
        "doc_id",
        "key",
        "group",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one_of_each(docs: DataFrame, size: int, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all their columns, less all but one of each near-duplicate group.

    The document of the least id stays.  Of rows with the same id and words one stays.  Documents
    without words link with nothing and all stay.  In a group where no document has an id, one of them stays.
    """
    found = stored_alone(lambda: near_duplicates(docs, size, percent).where("n_shingles > 0").select("doc_id", "key", "group"))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    first = found.groupBy("group").agg(F.min(order).alias("first"))
    judged = found.groupBy("group", "doc_id", "key").agg(F.count(F.lit(1)).alias("rows")).join(first, "group")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))
    id_, key, own, nth = unused(docs, "_id", "_key", "_word_key", "_nth")
    named = [F.col("doc_id").alias(id_), F.col("key").alias(key)]
    lost = stored(judged.where(~stays).select(*named))
    repeated = stored(judged.where(stays & (F.col("rows") > 1)).select(*named))
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(own) == F.col(key))
    kept = join_counted(docs.withColumn(own, word_key(F.col("text"))), lost, same, "left_anti", 48)
    if not repeated.isEmpty():
        once = join_counted(kept, repeated, same, "left_anti", 48)
        again = join_counted(kept, repeated, same, "left_semi", 48)
        place = F.row_number().over(Window.partitionBy("doc_id", own).orderBy(F.lit(1)))
        kept = once.unionByName(again.withColumn(nth, place).where(F.col(nth) == 1).drop(nth))
    return kept.drop(own)


def op6_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_duplicates(docs, size=4).select("doc_id", "n_shingles", "component_id", "kept")


OP6_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(g) AS n FROM words LEFT JOIN grams USING (doc_id) GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared s JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * s.n >= 80 * (p.n + q.n - s.n)
), reached AS (
  SELECT doc_id, doc_id AS other FROM words
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
"""
