"""Exact k-means over whole-number vectors, through dictionaries of subvectors.

Vectors are cut into blocks of WIDTH components.  Each chunk of CHUNK vectors is encoded once, without loss:
for every block the distinct subvectors, and of every vector a code for each block.  A round computes the
distance of every distinct subvector to every centroid's block once; the distance of a vector is the
sum of what its codes look up.  New centroids come from how often each code fell to each cluster.
All sums are in whole numbers, so the result does not depend on how vectors are dealt out.

Vectors are read and encoded once and never shuffled.  What crosses the network in a round are
sums of a fixed size for each task; the driver holds centroids only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rovelog.llm.common import stored, table

CLUSTERS, ROUNDS, COMPONENTS, SCALE = 40, 5, 64, 256
#: Components of a subvector, and vectors of a chunk.
WIDTH, CHUNK = 2, 1 << 14
#: Size up to which squared distances of COMPONENTS whole numbers fit a long.
LARGEST = 1 << 27


def kept(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id and ``vector``, whole numbers floor(SCALE * x), of the vectors that have all components finite."""
    number = F.col("embedding").cast("array<double>")
    finite = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(number, lambda x: F.floor(x * float(SCALE)))
    fits = F.forall(number, lambda x: F.abs(x * float(SCALE)) < float(LARGEST))
    checked = F.when(fits, whole).otherwise(F.raise_error(F.lit(f"a component times {SCALE} is {LARGEST} or more")).cast("array<bigint>"))
    good = vectors.where((F.size("embedding") == components) & finite)
    return good.select("vec_id", checked.alias("vector"))


def first_centroids(vectors: DataFrame, clusters: int, salt: str) -> np.ndarray:
    """The vectors whose ``salt`` and vec_id have the smallest SHA-256, ties by their components."""
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "vector").orderBy("key", "vector").limit(clusters).collect()
    return np.array([row["vector"] for row in rows], dtype=np.int64)


def encoded(vectors: DataFrame) -> DataFrame:
    """One row a chunk: ids of its vectors, and for every block the distinct subvectors and the code of each vector."""

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, rows = [], []

        def chunk() -> pd.DataFrame:
            whole = np.stack(rows).astype(np.int64)
            entries, codes = [], []
            for at in range(0, whole.shape[1], WIDTH):
                distinct, code = np.unique(whole[:, at : at + WIDTH], axis=0, return_inverse=True)
                entries.append(distinct.astype("<i4").tobytes())
                codes.append(code.reshape(-1).astype("<u2").tobytes())
            return pd.DataFrame({"ids": [list(ids)], "entries": [entries], "codes": [codes]})

        for frame in frames:
            for id_, vector in zip(frame["id"], frame["vector"]):
                ids.append(id_)
                rows.append(vector)
                if len(ids) == CHUNK:
                    yield chunk()
                    ids.clear()
                    rows.clear()
        if ids:
            yield chunk()

    named = vectors.select(F.col("vec_id").cast("string").alias("id"), "vector")
    return named.mapInPandas(encode, "ids array<string>, entries array<binary>, codes array<binary>")


def _decoded(entries: list[bytes], codes: list[bytes], components: int) -> list[tuple[slice, np.ndarray, np.ndarray]]:
    """For every block its components, distinct subvectors and codes."""
    found = []
    for at, (entry, code) in enumerate(zip(entries, codes)):
        part = slice(at * WIDTH, min((at + 1) * WIDTH, components))
        found.append((part, np.frombuffer(entry, "<i4").astype(np.int64).reshape(-1, part.stop - part.start), np.frombuffer(code, "<u2")))
    return found


def nearest(blocks: list[tuple[slice, np.ndarray, np.ndarray]], centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster (the smaller number with ties) and squared distance of each vector of a chunk."""
    total = 0
    for part, entries, codes in blocks:
        away = ((entries[:, None, :] - centroids[None, :, part]) ** 2).sum(axis=2)
        total = total + away[codes]
    cluster = total.argmin(axis=1)
    return cluster, np.take_along_axis(total, cluster[:, None], axis=1)[:, 0]


def _sums(centroids: np.ndarray):
    """Rows (cluster, component, total) of a task's vectors; component -1 has their number."""
    clusters, components = centroids.shape

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, count = np.zeros((clusters, components), dtype=np.int64), np.zeros(clusters, dtype=np.int64)
        for frame in frames:
            for entries, codes in zip(frame["entries"], frame["codes"]):
                blocks = _decoded(entries, codes, components)
                cluster, _ = nearest(blocks, centroids)
                count += np.bincount(cluster, minlength=clusters)
                for part, subvectors, code in blocks:
                    size = len(subvectors)
                    often = np.bincount(cluster * size + code, minlength=clusters * size).reshape(clusters, size)
                    total[:, part] += often @ subvectors
        every = np.column_stack([count, total])
        yield pd.DataFrame({
            "cluster": np.repeat(np.arange(clusters), components + 1),
            "component": np.tile(np.arange(-1, components), clusters),
            "total": every.reshape(-1),
        })

    return add


def moved(chunks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of the exact means; empty clusters keep theirs."""
    sums = chunks.select("entries", "codes").mapInPandas(_sums(centroids), "cluster int, component int, total long")
    whole = sums.groupBy("cluster", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    total = {(row["cluster"], row["component"]): int(row["total"]) for row in whole.collect()}  # clusters x components
    new = centroids.copy()
    for cluster in range(len(centroids)):
        count = total.get((cluster, -1), 0)
        if count:
            new[cluster] = [total[cluster, at] // count for at in range(centroids.shape[1])]
    return new


def clustered(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, components: int = COMPONENTS, salt: str = "2:"
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that is kept.

    ``vectors`` has vec_id and embedding; other columns are not read.  Vectors that are null, have
    another number of components, or a component that is null or not finite are left out.  Repeated
    rows count each; a null vec_id is an empty text where starts are chosen.  Of fewer than
    ``clusters`` vectors each is a start.  An empty table gives no rows.  A component of LARGEST / SCALE
    or more raises, since distances would no longer fit a long.
    """
    good = kept(vectors, components)
    chunks = stored(encoded(good))
    centroids = first_centroids(good, clusters, salt)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(chunks, centroids)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for ids, entries, codes in zip(frame["ids"], frame["entries"], frame["codes"]):
                cluster, distance = nearest(_decoded(entries, codes, components), centroids)
                yield pd.DataFrame({"id": list(ids), "cluster": cluster, "distance": distance})

    assigned = stored(chunks.mapInPandas(assign, "id string, cluster int, distance long"))
    sums = {r["cluster"]: r["n"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}  # clusters
    said = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(at, sums[at], sum(sums.values()), said[at]) for at in sums]
    of_cluster = vectors.sparkSession.createDataFrame(rows, "number int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(of_cluster), F.col("cluster") == F.col("number")).select(
        F.col("id").cast(vectors.schema["vec_id"].dataType).alias("vec_id"),
        "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256",
    )


def op13_subvector_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"))


def _rounds() -> str:
    """CTEs c0 to cN: the centroids (cluster, d, y) after each round."""
    said = ["c0 AS (SELECT cluster, d, v[d] AS y FROM starts, range(1, 65) r(d))"]
    for at in range(ROUNDS + 1):
        said.append(
            f"t{at} AS (SELECT a.row, c.cluster, sum((a.x - c.y) * (a.x - c.y)) AS away FROM long_ a JOIN c{at} c ON a.d = c.d GROUP BY ALL), "
            f"n{at} AS (SELECT row, arg_min(cluster, (away, cluster)) AS cluster, min(away) AS distance FROM t{at} GROUP BY row)"
        )
        if at < ROUNDS:
            said.append(
                f"m{at} AS (SELECT n.cluster, a.d, sum(a.x) AS total, count(*) AS n FROM n{at} n JOIN long_ a ON n.row = a.row GROUP BY ALL), "
                f"c{at + 1} AS (SELECT c.cluster, c.d, CASE WHEN m.n IS NULL THEN c.y "
                f"ELSE (m.total - (((m.total % m.n) + m.n) % m.n)) // m.n END AS y "
                f"FROM c{at} c LEFT JOIN m{at} m ON m.cluster = c.cluster AND m.d = c.d)"
            )
    return ", ".join(said)


OP13_SQL = f"""
WITH kept AS (SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
starts AS (SELECT v, row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::varchar, '')), v) - 1 AS cluster FROM kept QUALIFY cluster < {CLUSTERS}),
long_ AS (SELECT row, unnest(range(1, 65)) AS d, unnest(v) AS x FROM kept),
{_rounds()},
said AS (SELECT cluster, sha256(string_agg(y::bigint::varchar, ',' ORDER BY d)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY cluster)
SELECT k.vec_id, n.cluster::int AS cluster, n.distance::bigint AS distance,
  (sum(n.distance) OVER (PARTITION BY n.cluster))::bigint AS cluster_inertia, (sum(n.distance) OVER ())::bigint AS inertia, s.centroid_sha256
FROM kept k JOIN n{ROUNDS} n ON k.row = n.row JOIN said s ON s.cluster = n.cluster
"""
