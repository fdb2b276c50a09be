"""Near-duplicate vectors by a robust-pruned flat graph.

Vectors of one label are dealt to shards several times over: in each of several rounds by the
nearest of other pivots, so the shards of different rounds overlap.  In each shard a flat graph is
built: a vector's neighbours are chosen from all others, nearest first, and a candidate is pruned if
a chosen neighbour is nearer to it by the factor ALPHA (where it is at distance 0 from that
neighbour, as multiples of one vector are, the two are linked both ways); of the neighbours beyond twice the radius
only the first FAR are kept, to find the way by.  The adjacency lists that a vector gets in its
shards are united.  A query walks greedily from the medoid towards itself and then expands over all
vectors within ``radius * (1 + 1 / ALPHA)``; what lies within the radius is verified by the cosine.

Why the search is whole within a shard: for every vector y and every other vector p, either p has an
edge to y or an edge to some p' with ALPHA d(p', y) <= d(p, y), where p' has an edge to y if that is 0
but for rounding (SAME).  So the distance to y shrinks at each step until an edge ends in y, and from the query q a path leads to
any y within the radius over p with d(p, y) <= radius / ALPHA, that is d(q, p) <= radius (1 + 1 / ALPHA),
which the expansion covers; its edges are no longer than twice the radius.  What can be missed is a
vector that shares no shard with the query.  A sample of vectors is therefore compared with all
vectors of their label, and rounds are added until the audit finds at least the wanted recall.

A link is counted in the first round in which both vectors share a shard, which their places in the
rounds before tell, so no pair is counted twice and no pair is written: a shard gives numbers of
links and a spanning forest.  A shard with more vectors than fit a task is cut into blocks; every
two of them meet in a task of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rovelog.llm.common import components, shipped, stored, table

ALPHA = 1.1
#: Distance up to which unit vectors are the same but for rounding.
SAME = 1e-6
#: Neighbours beyond twice the radius that a vector keeps.
FAR = 8
#: Vectors of a shard that are wanted, and the most of a block; a task takes two blocks.
SHARD, BLOCK = 400, 1200
#: Pivots of all labels together that are sent to the tasks; with more data the shards grow and are cut into blocks.
MOST_PIVOTS = 100_000
#: Rounds of shards: tried in turn until the audit is content.
ROUNDS = (8, 16, 32)
#: Audited: this many vectors of each label at most, by hash, each against all vectors of its label.
AUDITED = 40


@dataclass(frozen=True)
class Pivots:
    """Unit pivots of each (label, size): rounds x pivots x size."""

    vectors: dict[tuple, np.ndarray]

    def shards(self, group: tuple, unit: np.ndarray) -> np.ndarray:
        """The shard of each row of ``unit`` in each round; one round where there is one shard."""
        pivots = self.vectors.get(group)
        if pivots is None:
            return np.zeros((len(unit), 1), dtype=np.int32)
        return np.stack([(unit @ p.T).argmax(axis=1) for p in pivots], axis=1).astype(np.int32)


def valid_vectors(rows: DataFrame) -> DataFrame:
    """The rows that can link, with their ``vector`` as float or double."""
    kind = dict(rows.dtypes)["_vector"]
    vector = F.col("_vector") if kind == "array<float>" else F.col("_vector").cast("array<double>")
    finite = F.forall(
        "vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    ) & F.exists("vector", lambda v: v != 0)
    return rows.withColumn("vector", vector).where(F.col("_label").isNotNull() & F.col("vector").isNotNull()).where(finite)


def chosen_pivots(classes: DataFrame, rounds: int) -> Pivots:
    """Vectors with the least hashes of each label: for each round one for SHARD classes, MOST_PIVOTS at most in all."""
    sizes = classes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("_of"))
    total = sizes.agg(F.sum(F.ceil(F.col("_of") / SHARD))).first()[0] or 0
    shrink = max(1.0, rounds * total / MOST_PIVOTS)
    wanted = sizes.select(
        F.col("label").alias("_l"), F.col("size").alias("_s"), F.ceil(F.col("_of") / (SHARD * shrink)).alias("k"), "_of"
    ).where("k > 1")
    # more than the wanted share by hash, so that enough are there; the driver keeps what is wanted of each label
    share = F.least(F.lit(1.0), (2 * rounds * F.col("k") + 20) / F.col("_of"))
    hash_ = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30))
    same = (F.col("label") == F.col("_l")) & (F.col("size") == F.col("_s"))
    sample = classes.join(wanted, same).where(hash_ < share * (1 << 30)).select("label", "size", "k", "vector", hash_.alias("h"))
    vectors: dict[tuple, np.ndarray] = {}
    for (label, size), part in sample.toPandas().groupby(["label", "size"]):  # about 2 * MOST_PIVOTS rows at most
        part = part.sort_values("h")
        k = min(int(part["k"].iloc[0]), len(part))
        unit = _unit(np.stack(part["vector"].to_numpy()))
        at = (np.arange(rounds)[:, None] * k + np.arange(k)) % len(unit)
        vectors[(label, size)] = unit[at]
    return Pivots(vectors)


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def robust_pruned(distance: np.ndarray, radius: float, alpha: float = ALPHA, far: int = FAR) -> np.ndarray:
    """Adjacency (a boolean matrix) of the flat graph over all vectors, by their distances.

    All rows are pruned side by side: each takes its nearest candidate left, and drops those
    candidates that the new neighbour is nearer to by ``alpha``; those that it is the SAME as get edges
    from and to it instead, because no vector is nearer to them than another of the same.  A row is done when no candidate is
    left, or when it has ``far`` neighbours beyond twice the ``radius``.
    """
    n = len(distance)
    edge = np.zeros((n, n), dtype=bool)
    left = np.where(np.eye(n, dtype=bool), np.inf, distance)
    rows, beyond = np.arange(n), np.zeros(n, dtype=np.int64)
    while len(rows):
        part = left[rows]
        nearest = part.argmin(axis=1)
        apart = part[np.arange(len(rows)), nearest]
        beyond[rows] += apart > 2 * radius
        some = np.isfinite(apart) & (beyond[rows] <= far)
        rows, nearest, part = rows[some], nearest[some], part[some]
        edge[rows, nearest] = True
        pruned = (alpha * distance[nearest] <= distance[rows]) & np.isfinite(part)
        row, other = np.nonzero(pruned & (distance[nearest] <= SAME))
        two = nearest[row] != other
        edge[nearest[row[two]], other[two]] = edge[other[two], nearest[row[two]]] = True
        part[pruned] = np.inf
        part[np.arange(len(rows)), nearest] = np.inf
        left[rows] = part
    return edge


def search(distance: np.ndarray, edge: np.ndarray, queries: np.ndarray, radius: float, alpha: float = ALPHA) -> np.ndarray:
    """Which vectors within the radius each query reaches.

    It walks greedily from the medoid towards itself, and expands from where the walk ends and from
    its own place over all within the wider radius.
    """
    at = np.full(len(queries), int(distance.sum(axis=1).argmin()))  # the medoid
    going = np.arange(len(queries))
    while len(going):
        there = np.where(edge[at[going]], distance[queries[going]], np.inf)
        step = there.argmin(axis=1)
        better = there[np.arange(len(going)), step] < distance[queries[going], at[going]]
        going = going[better]
        at[going] = step[better]
    inside = distance[queries] <= radius * (1 + 1 / alpha)
    reached = np.zeros((len(queries), len(distance)), dtype=bool)
    reached[np.arange(len(queries)), at] = True
    reached &= inside  # a walk may have ended far away
    reached[np.arange(len(queries)), queries] = True
    front = reached.copy()
    links = edge.astype(np.float32)
    while front.any():
        front = (front.astype(np.float32) @ links > 0) & inside & ~reached
        reached |= front
    return reached & (distance[queries] <= radius)


def _distances(unit: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * unit @ unit.T, 0.0))


def _forest(link: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges that connect what the symmetric ``link`` connects, one fewer than members in each group."""
    seen = np.zeros(len(link), dtype=bool)
    for root in range(len(link)):
        if seen[root]:
            continue
        seen[root] = True
        front = [root]
        while front:
            node = front.pop()
            new = np.flatnonzero(link[node] & ~seen)
            seen[new] = True
            front += new.tolist()
            yield from ((node, int(other)) for other in new)


PLACED = "id long, n long, vector {vector}, label {label}, size int, round int, shard int, shards array<int>"


def placed(classes: DataFrame, pivots: Pivots) -> DataFrame:
    """Each class once for every round, with its shard in that round and in all."""
    shared = shipped(classes.sparkSession, pivots)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for group, part in batch.groupby(["label", "size"]):
                shards = shared().shards(group, _unit(np.stack(part["vector"].to_numpy())))
                for at in range(shards.shape[1]):
                    yield part.assign(round=at, shard=shards[:, at], shards=list(shards))[
                        ["id", "n", "vector", "label", "size", "round", "shard", "shards"]
                    ]

    kinds = dict(classes.dtypes)
    return classes.mapInPandas(run, PLACED.format(label=kinds["label"], vector=kinds["vector"]))


PLACE = ["label", "size", "round", "shard"]


def blocks(members: DataFrame) -> DataFrame:
    """``members`` dealt to tasks (i, j): a shard that fits a task is one, else every two of its blocks meet."""
    sizes = members.groupBy(*PLACE).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(sizes, PLACE).withColumn("block", F.pmod(F.xxhash64("id", F.lit(2)), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("blocks", "other")


def adjacency(tasks: DataFrame, radius: float) -> DataFrame:
    """node and neighbours of the flat graphs of all shards, the lists of one node united.

    A list holds what survives pruning; its length does not follow the size of the data.
    """

    def build(part: pd.DataFrame) -> pd.DataFrame:
        edge = robust_pruned(_distances(_unit(np.stack(part["vector"].to_numpy()))), radius)
        names = part["id"].to_numpy()
        return pd.DataFrame({"node": names, "near": [names[row] for row in edge]})

    lists = tasks.groupBy(*PLACE, "i", "j").applyInPandas(build, "node long, near array<long>")
    return lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def searched(tasks: DataFrame, near: DataFrame, cosine: float) -> DataFrame:
    """Rows (kind, a, b, n): ``links`` of a with n vectors, and ``edge`` between a and b of the spanning forests."""
    radius = float(np.sqrt(2 - 2 * cosine))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        names, at_round = part["id"].to_numpy(), int(part["round"].iloc[0])
        order = np.argsort(names)
        unit = _unit(np.stack(part["vector"].to_numpy()))
        distance = _distances(unit)
        edge = np.zeros((len(names), len(names)), dtype=bool)
        for row, others in enumerate(part["near"]):
            spot = np.searchsorted(names[order], others)
            spot[spot == len(names)] = 0
            there = order[spot]
            edge[row, there[names[there] == others]] = True
        link = search(distance, edge, np.arange(len(names)), radius + 1e-6)
        link &= unit @ unit.T >= cosine  # verified
        link |= link.T
        np.fill_diagonal(link, False)
        shards = np.stack(part["shards"].to_numpy())
        for before in range(at_round):  # counted there
            link &= shards[:, before][:, None] != shards[:, before]
        block = part["block"].to_numpy()
        if part["i"].iloc[0] != part["j"].iloc[0]:  # pairs of one block are counted where it meets itself
            link &= block[:, None] != block
        counts = link @ part["n"].to_numpy(dtype=np.int64)
        out = [("links", int(names[a]), None, int(counts[a])) for a in np.flatnonzero(counts)]
        out += [("edge", int(names[a]), int(names[b]), 0) for a, b in _forest(link)]
        return pd.DataFrame(out, columns=["kind", "a", "b", "n"]).astype({"a": "int64", "b": "Int64", "n": "int64"})

    known = tasks.join(near, tasks["id"] == near["node"]).drop("node")
    return known.groupBy(*PLACE, "i", "j").applyInPandas(run, "kind string, a long, b long, n long")


def audit(classes: DataFrame, counts: DataFrame, cosine: float) -> float:
    """The share found of the links that AUDITED classes of each label have with other classes, by comparing all."""
    sizes = classes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("m"))
    drawn = F.pmod(F.xxhash64("id", F.lit(3)), F.col("m")) < AUDITED
    sample = classes.join(sizes, ["label", "size"]).where(drawn).select("id", "label", "size", "vector").toPandas()
    by_group = {k: (p["id"].to_numpy(), _unit(np.stack(p["vector"].to_numpy()))) for k, p in sample.groupby(["label", "size"])}
    asked = shipped(classes.sparkSession, by_group)  # about AUDITED vectors a label

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for group, part in batch.groupby(["label", "size"]):
                names, unit = asked().get(group, ((), None))
                if len(names):
                    near = unit @ _unit(np.stack(part["vector"].to_numpy())).T >= cosine
                    near &= names[:, None] != part["id"].to_numpy()
                    yield pd.DataFrame({"id": names, "there": near @ part["n"].to_numpy(dtype=np.int64)})

    there = classes.mapInPandas(run, "id long, there long").groupBy("id").agg(F.sum("there").alias("there"))
    row = there.join(counts, "id", "left").agg(F.sum("there"), F.sum(F.coalesce("linked", F.lit(0)))).first()
    return 1.0 if not row[0] else row[1] / row[0]


def link_vectors(
    rows: DataFrame, vector: str, label: str, key: str, cosine: float = 0.93, least_recall: float = 0.999
) -> DataFrame:
    """``key``, n_links, component_id and kept for every row of ``rows``.

    Two rows link if their labels are equal and not null and the cosine of their vectors, in double
    precision, is at least ``cosine``.  A vector that is null, of length zero, or has null or
    non-finite parts links with nothing; neither do vectors of different sizes.  Equal vectors of a
    label are one class, each of whose rows links with all others.  component_id is the least
    ``key`` that links lead to, the row's own if there is none; a null key is never the least.
    """
    radius = float(np.sqrt(2 - 2 * cosine))
    slim = rows.select(F.col(key).alias("_key"), F.col(vector).alias("_vector"), F.col(label).alias("_label"))
    code = F.unhex(F.md5(F.concat_ws(",", F.col("_label").cast("string"), F.to_json("_vector"))))
    usable = valid_vectors(slim).select(
        "_key", F.col("_label").alias("label"), F.size("vector").alias("size"), "vector", code.alias("code")
    )
    classes = stored(
        usable.groupBy("code", "label", "size", "vector")
        .agg(F.count(F.lit(1)).alias("n"), F.min("_key").alias("least"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    for rounds in ROUNDS:
        pivots = chosen_pivots(classes, rounds)
        tasks = stored(blocks(placed(classes.select("id", "n", "vector", "label", "size"), pivots)))
        found = stored(searched(tasks, stored(adjacency(tasks, radius)), cosine))
        counts = found.where("kind = 'links'").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("linked"))
        if audit(classes, counts, cosine) >= least_recall:
            break
    else:
        raise RuntimeError(f"the audit found a recall below {least_recall} with {ROUNDS[-1]} rounds")
    groups = components(found.where("kind = 'edge'").select("a", "b")).select(F.col("node").alias("id"), "component")
    grouped = classes.join(groups, "id", "left").select("id", "code", "n", F.coalesce("component", "id").alias("component"), "least")
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = grouped.join(least, "component").join(counts, "id", "left").select(
        "code", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links")
    )
    return (
        slim.select("_key", code.alias("code"))
        .join(of_class, "code", "left")
        .select(
            F.col("_key").alias(key),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "_key").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))
    )


def op1_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"), "embedding", "label", "vec_id")


OP1_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
    ON x.label = y.label AND len(x.v) = len(y.v) AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.v, y.v) >= 0.93
), reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e
JOIN (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id) USING (vec_id)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
"""
