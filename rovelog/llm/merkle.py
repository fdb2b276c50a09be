"""Merkle manifest of a dataset as an append log in postorder.

Every document is a leaf.  The leaves of a language form a tree with FAN children a node, and the
roots of these trees, in the order of their languages, form one more.  A tree is kept as the log
that a single writer would append, in which every node follows the last of its descendants.  Where
a node stands in it follows from the sizes of complete subtrees alone (:func:`position`), so

* builders work on aligned blocks of FAN ** DEEP nodes each and write their nodes in completion
  order without waiting for each other; a block's root is a leaf of the next round;
* a proof asks for its siblings by place: those inside a block are in what its builder wrote, and
  those above are looked up once a block, not once a document.

A task holds one block, whatever the number of documents of a language.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rovelog.llm.common import fold, lower_ascii, stored, table

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Children of a node, and the binary logarithm of their number.
FAN, SHIFT = 8, 3
#: Levels that a builder adds to a block.
DEEP = 4
#: Levels of the tallest tree whose leaves a long can number.
TALLEST = 21

LOG = "tree string, leaves long, level int, idx long, pos long, digest string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(leaves: int) -> int:
    """Levels above the leaves of a tree; 0 if the only leaf is its root."""
    return sum(1 for level in range(TALLEST) if FAN**level < leaves)


def position(level: int, idx: int, leaves: int) -> int:
    """Place, from 0, of node ``idx`` of ``level`` in the log of a tree.

    The node's last leaf follows all leaves before it and the nodes that these complete; then come
    the nodes above that leaf, level by level.
    """
    last = min((idx + 1) << SHIFT * level, leaves) - 1
    return sum(last >> SHIFT * up for up in range(TALLEST)) + level


def height_of(leaves: str) -> Column:
    """:func:`height` of a column."""
    return F.expr(" + ".join(f"int({FAN**level} < {leaves})" for level in range(TALLEST)))


def position_of(level: str, idx: str, leaves: str) -> Column:
    """:func:`position` of columns."""
    last = f"(least(shiftleft({idx} + 1, {SHIFT} * {level}), {leaves}) - 1)"
    return F.expr(" + ".join(f"shiftright({last}, {SHIFT * up})" for up in range(TALLEST)) + f" + {level}")


def leaves_of(docs: DataFrame) -> DataFrame:
    """tree, doc_id, leaf, tampered (the leaf of the tampered row) and copies of every distinct leaf.

    ``tree`` sorts as the language does, null first.  Rows that agree in all of FIELDS are one row here.
    """

    def said(field: str, text: Column | None = None) -> Column:
        value = F.col(field).cast("string") if text is None else text
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    plain = F.sha2(F.concat(*[said(f) for f in FIELDS]), 256)
    lowered = F.sha2(F.concat(*[said(f) for f in FIELDS[:-1]], said("text", lower_ascii(F.col("text")))), 256)
    tree = F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), F.col("lang")))
    rows = docs.select(tree.alias("tree"), "doc_id", plain.alias("leaf"), F.when(fold("doc_id", 3) == 0, lowered).alias("tampered"))
    return rows.groupBy("tree", "doc_id", "leaf", "tampered").agg(F.count(F.lit(1)).alias("copies"))


def placed(rows: DataFrame, order: list[str], copies: str | None = None) -> DataFrame:
    """``rows`` (tree, ...) with ``idx``, the place of each in its tree by ``order``, and ``leaves``, the tree's size.

    Rows are dealt to tasks by ranges of (tree, order); what comes before a range in its tree is
    added up from one row a range, so no task holds a tree.
    """
    ranges = stored(rows.repartitionByRange("tree", *order).withColumn("part", F.spark_partition_id()))
    number = F.col(copies) if copies else F.lit(1)
    counts = ranges.groupBy("tree", "part").agg(F.sum(number).alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = counts.select(
        "tree", "part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
        F.sum("n").over(Window.partitionBy("tree")).alias("leaves"),
    )
    within = Window.partitionBy("tree", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    nth = F.coalesce(F.sum(number).over(within), F.lit(0))
    found = ranges.join(sizes, ["tree", "part"]).withColumn("idx", F.col("start") + nth).drop("part", "start")
    if copies:
        found = found.withColumn("idx", F.explode(F.sequence("idx", F.col("idx") + F.col(copies) - 1))).drop(copies)
    return found


def _built(base: int):
    """The builder of blocks of nodes of level ``base``: what it appends to the log."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        tree, leaves, first = rows["tree"].iloc[0], int(rows["leaves"].iloc[0]), int(rows["idx"].iloc[0])
        nodes, out = list(rows["digest"]), []
        if base == 0:
            out += [(0, first + at, d) for at, d in enumerate(nodes)]
        for level in range(base + 1, min(base + DEEP, height(leaves)) + 1):
            nodes = [digest("".join(nodes[at : at + FAN])) for at in range(0, len(nodes), FAN)]
            first >>= SHIFT
            out += [(level, first + at, d) for at, d in enumerate(nodes)]
        log = [(tree, leaves, level, idx, position(level, idx, leaves), d) for level, idx, d in out]
        return pd.DataFrame(sorted(log, key=lambda row: row[4]), columns=["tree", "leaves", "level", "idx", "pos", "digest"])

    return build


def append_log(leaves: DataFrame) -> DataFrame:
    """The logs of all trees, one row a node: tree, leaves (of the tree), level, idx (in the level), pos, digest.

    ``leaves`` has tree, leaves, idx and digest.  The rows of a block lie together in completion order.
    """
    tallest = leaves.agg(F.max("leaves")).first()[0] or 0
    log, base, nodes = None, 0, leaves.select("tree", "leaves", "idx", "digest")
    while log is None or base < height(tallest):
        blocks = nodes.groupBy("tree", F.expr(f"shiftright(idx, {SHIFT * DEEP})").alias("block"))
        written = stored(blocks.applyInPandas(_built(base), LOG))
        log = written if log is None else log.unionByName(written)
        base += DEEP
        above = (F.col("level") == base) & (height_of("leaves") > base)
        nodes = written.where(above).select("tree", "leaves", "idx", "digest")
    return log


def roots(log: DataFrame) -> DataFrame:
    """tree and digest of the root of each tree."""
    return log.where(F.col("level") == height_of("leaves")).select("tree", "digest")


def siblings(nodes: DataFrame, log: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, level, slot and digest of the siblings of ``nodes`` (tree, leaves, level, idx) and of all above them.

    Their places are computed and looked up.  ``slot`` is the place among the children of one node.
    """
    levels = F.when(F.col("level") < height_of("leaves"), F.sequence(F.col("level"), height_of("leaves") - 1))
    asked = (
        nodes.withColumn("at", F.explode(levels))
        .withColumn("own", F.expr(f"shiftright(idx, {SHIFT} * (at - level))"))
        .withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(FAN - 1))))
        .withColumn("other", F.expr(f"own - own % {FAN} + slot"))
        .where(f"other <> own and shiftleft(other, {SHIFT} * at) < leaves")
        .select(*keep, F.col("tree").alias("of"), position_of("at", "other", "leaves").alias("place"), F.col("at").alias("level"), "slot")
    )
    there = log.select(F.col("tree").alias("of"), F.col("pos").alias("place"), "digest")
    return asked.join(there, ["of", "place"]).select(*keep, "level", "slot", "digest")


def _proved(tall: int):
    """The extraction of the proofs of a block; ``tall`` is the height of the tree over the languages."""

    def prove(leaves: pd.DataFrame, inner: pd.DataFrame) -> pd.DataFrame:
        leaves = leaves.sort_values("idx")
        count, first = int(leaves["leaves"].iloc[0]), int(leaves["idx"].iloc[0])
        levels, above = [list(leaves["leaf"])], {}
        for level, rows in inner.sort_values(["over", "level", "slot"]).groupby(["over", "level"]):
            if level[0] == 0:
                levels.append(list(rows["digest"]))
            else:
                above[level] = list(zip(rows["slot"], rows["digest"]))

        def run(level: int, idx: int) -> tuple[list[str], list[str]]:
            """The siblings before and after the node above leaf ``idx``."""
            own = idx >> SHIFT * level
            if level < DEEP:
                at = own - (first >> SHIFT * level)
                start = at - own % FAN
                return levels[level][start:at], levels[level][at + 1 : start + FAN]
            met = above.get((1, level), [])
            return [d for s, d in met if s < own % FAN], [d for s, d in met if s > own % FAN]

        def top(level: int) -> tuple[list[str], list[str]]:
            met = above.get((2, level), [])
            own = next((at for at, (s, _) in enumerate(met) if s != at), len(met))
            return [d for _, d in met[:own]], [d for _, d in met[own:]]

        tops, found = [top(level) for level in range(tall)], []
        for idx, leaf, tampered in zip(leaves["idx"], leaves["leaf"], leaves["tampered"]):
            path = [run(level, idx) for level in range(height(count))] + tops
            node = tampered or leaf
            for before, after in path:
                node = digest("".join((*before, node, *after)))
            found.append((digest("".join(d for before, after in path for d in (*before, *after))), node))
        out = leaves[["tree", "id", "leaf"]].copy()
        out["proof_sha256"], out["folded_root"] = zip(*found)
        return out

    return prove


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of ``docs``.

    A leaf is the SHA-256 of FIELDS, each ``-`` if null, else its length in bytes, ``:`` and its
    value.  Every FAN consecutive leaves of a language, by doc_id (null first, ties by leaf), are
    hashed into one node, these again, until one is left, the ``subroot``; the subroots likewise, by
    language, null first.  ``folded_root`` is recomputed from the siblings and the leaf, which is
    that of the tampered row (text in lower case) where 3 divides the crc32 of doc_id; a null doc_id
    is never tampered with.  Rows that agree in all FIELDS have neighbouring leaves of their own.
    Other columns are not read.  An empty table gives no rows.
    """
    leaves = stored(placed(leaves_of(docs), ["doc_id", "leaf", "tampered"], "copies"))
    log = append_log(leaves.withColumnRenamed("leaf", "digest"))
    over = stored(placed(roots(log).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"]))
    top = append_log(over.select("tree", "leaves", "idx", "digest"))
    root = roots(top).first()
    tall = height(over.count())

    block = lambda level: F.expr(f"shiftright(idx, {SHIFT} * ({DEEP} - {level}))").alias("block")
    own = log.where(F.col("level").between(1, DEEP - 1)).select("tree", block("level"), F.lit(0).alias("over"), "level", "idx", "digest")
    heads = log.where(F.col("level") == DEEP).withColumn("block", F.col("idx"))
    high = siblings(heads.select("tree", "leaves", "level", "idx", "block"), log.where(F.col("level") >= DEEP), ["tree", "block"])
    names = over.withColumn("level", F.lit(0))
    tops = siblings(names.select("tree", "leaves", "level", "idx", "name"), top, ["name"]).withColumnRenamed("name", "tree")
    blocks = leaves.select("tree", block("0")).distinct()
    inner = own.withColumnRenamed("idx", "slot").unionByName(
        high.withColumn("over", F.lit(1)).withColumn("slot", F.col("slot").cast("long"))
    ).unionByName(tops.join(blocks, "tree").withColumn("over", F.lit(2)).withColumn("slot", F.col("slot").cast("long")))
    asked = leaves.select("tree", block("0"), "leaves", "idx", F.col("doc_id").cast("string").alias("id"), "leaf", "tampered")
    proofs = (
        asked.groupBy("tree", "block")
        .cogroup(inner.groupBy("tree", "block"))
        .applyInPandas(_proved(tall), "tree string, id string, leaf string, proof_sha256 string, folded_root string")
    )
    subroots = over.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"))
    found = proofs.join(subroots, "tree").withColumn("root", F.lit(root and root["digest"]).cast("string"))
    return found.select(
        F.col("id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_merkle_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def _levels(name: str, cell: str, first: str, levels: int) -> str:
    """CTEs ``name``0 to ``name``N: the tree over ``first`` (cell, i, d, leaf), level by level, and the path of each leaf."""
    said = [first]
    for at in range(levels):
        a, b = f"{name}{at}", f"{name}{at + 1}"
        said.append(
            f"{a}n AS (SELECT *, count(*) OVER (PARTITION BY {cell}) n FROM {a}), "
            f"{b} AS (SELECT {cell}, i // 8 i, CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END d "
            f"FROM {a}n GROUP BY {cell}, i // 8), "
            f"{a}s AS (SELECT x.{cell}, x.i, any_value(x.n) n, coalesce(string_agg(y.d, '' ORDER BY y.i) FILTER (WHERE y.i < x.i), '') lo, "
            f"coalesce(string_agg(y.d, '' ORDER BY y.i) FILTER (WHERE y.i > x.i), '') hi "
            f"FROM {a}n x JOIN {a}n y ON x.{cell} IS NOT DISTINCT FROM y.{cell} AND x.i // 8 = y.i // 8 GROUP BY x.{cell}, x.i)"
        )
    return ", ".join(said)


def _fold(name: str, cell: str, start: str, levels: int, prefix: str) -> str:
    """CTEs that carry proof and folded digest of each document up ``levels`` levels of the tree ``name``."""
    said = []
    for at in range(levels):
        said.append(
            f"{prefix}{at + 1} AS (SELECT f.* REPLACE (f.p // 8 AS p, f.proof || s.lo || s.hi AS proof, "
            f"CASE WHEN s.n = 1 THEN f.node ELSE sha256(s.lo || f.node || s.hi) END AS node) "
            f"FROM {start if at == 0 else f'{prefix}{at}'} f JOIN {name}{at}s s ON f.{cell} IS NOT DISTINCT FROM s.{cell} AND f.p = s.i)"
        )
    return ", ".join(said)


_SAID = lambda field: f"coalesce(strlen({field}::varchar) || ':' || {field}::varchar, '-')"
_CRC32 = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)), "
    "lambda c, b: xor(c >> 8, crc.t[xor(c, b) % 256 + 1])))"
)

#: Six levels hold 262,144 documents of a language, two levels 64 languages.
OP12_SQL = f"""
WITH crc AS (SELECT list_transform(range(256), lambda k: list_reduce(list_prepend(k, range(8)),
               lambda c, _: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) t),
leafs AS (
  SELECT doc_id, lang, sha256({" || ".join(map(_SAID, FIELDS))}) AS leaf,
    sha256({" || ".join(map(_SAID, FIELDS[:-1]))} || {_SAID("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) AS lowered,
    {_CRC32} % 3 = 0 AS tampered
  FROM documents, crc),
numbered AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leafs),
{_levels("a", "lang", "a0 AS (SELECT lang, i, leaf AS d FROM numbered)", 6)},
sub AS (SELECT lang, d AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM a6),
{_levels("b", "one", "b0 AS (SELECT 1 AS one, i, subroot AS d FROM sub)", 2)},
f0 AS (SELECT doc_id, lang, leaf, i AS p, '' AS proof, CASE WHEN tampered THEN lowered ELSE leaf END AS node FROM numbered),
{_fold("a", "lang", "f0", 6, "f")},
g0 AS (SELECT f.* REPLACE (sub.i AS p), sub.subroot, 1 AS one FROM f6 f JOIN sub ON f.lang IS NOT DISTINCT FROM sub.lang),
{_fold("b", "one", "g0", 2, "g")}
SELECT doc_id, leaf, subroot, (SELECT d FROM b2) AS root, sha256(proof) AS proof_sha256, node AS folded_root,
  node = (SELECT d FROM b2) AS verified
FROM g2
"""
