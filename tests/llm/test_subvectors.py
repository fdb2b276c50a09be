from __future__ import annotations

import hashlib
import math
import random

import pytest

from rovelog.llm import subvectors as S

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, row int"


def plain(rows, clusters, rounds, components):
    good = [
        (r[0], [math.floor(256 * x) for x in r[1]]) for r in rows
        if r[1] is not None and len(r[1]) == components and all(x is not None and math.isfinite(x) for x in r[1])
    ]
    key = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(good, key=key)[:clusters]]
    away = lambda v: min((sum((x - y) ** 2 for x, y in zip(v, c)), at) for at, c in enumerate(centroids))
    for _ in range(rounds):
        at = [away(v)[1] for _, v in good]
        for c in range(len(centroids)):
            own = [v for (_, v), cluster in zip(good, at) if cluster == c]
            if own:
                centroids[c] = [sum(xs) // len(own) for xs in zip(*own)]
    last = [away(v) for _, v in good]
    inertia = {c: sum(d for d, at in last if at == c) for c in range(clusters)}
    said = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(name, c, d, inertia[c], sum(inertia.values()), said[c]) for (name, _), (d, c) in zip(good, last)]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x or 0) for x in r))


def sample(seed, n, components):
    draw = random.Random(seed)
    point = lambda: [draw.choice([draw.gauss(0, 0.3), draw.randrange(-2, 3) / 256, 1e4, -0.0]) for _ in range(components)]
    rows = [(i, point(), 1, "x", i) for i in range(n)]
    rows += [(None, point(), 1, "x", 0), (None, point(), None, "x", 0), (3, point(), 1, "x", 0), *[rows[2]] * 3]
    bad = [None, [], [0.1], [None] * components, [float("nan")] + [0.0] * (components - 1), [0.0] * (components - 1) + [-math.inf], [0.5] * (components + 1)]
    return rows + [(1000 + i, v, 1, "x", 0) for i, v in enumerate(bad)]


@pytest.mark.parametrize("n, clusters, rounds, components, chunk", [(60, 7, 5, 6, 16384), (90, 5, 3, 5, 7), (3, 40, 5, 4, 2), (40, 1, 2, 1, 10)])
def test_equals_plain_k_means(spark, monkeypatch, n, clusters, rounds, components, chunk):
    monkeypatch.setattr(S, "CHUNK", chunk)
    rows = sample(n, n, components)
    found = S.clustered(spark.createDataFrame(rows, SCHEMA).repartition(3), clusters, rounds, components)
    assert ordered(found.collect()) == ordered(plain(rows, clusters, rounds, components))


def test_ties_and_empty_clusters(spark):
    rows = [(i, [0.0, 0.0], 1, "x", 0) for i in range(6)] + [(7, [1.0, 0.0], 1, "x", 0)]
    assert ordered(S.clustered(spark.createDataFrame(rows, SCHEMA), 4, 5, 2).collect()) == ordered(plain(rows, 4, 5, 2))


def test_no_vectors(spark):
    assert S.clustered(spark.createDataFrame([], SCHEMA)).count() == 0
    assert S.clustered(spark.createDataFrame([(1, None, 1, "x", 0)], SCHEMA)).count() == 0


def test_components_too_large_for_a_long_raise(spark):
    with pytest.raises(Exception, match="component times 256"):
        S.clustered(spark.createDataFrame([(1, [1e6, 0.0], 1, "x", 0)], SCHEMA), 2, 1, 2).collect()
