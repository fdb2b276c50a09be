from __future__ import annotations

import math

import numpy as np
import pytest

from rovelog.llm import vector_graph as V
from tests.llm.test_common import grouped

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def sample(seed, groups=12, each=9, size=16, labels=2):
    draw = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        base = draw.normal(size=size)
        for _ in range(each):
            out.append((base + draw.normal(size=size) * np.linalg.norm(base) / math.sqrt(size) * draw.choice([0.05, 0.25, 0.45]), g % labels))
    out += [(draw.normal(size=size), g % labels) for g in range(groups * each // 2)]
    return [(i * 2, v.astype(np.float32).tolist(), label, "x") for i, (v, label) in enumerate(out)]


def plain(rows, least=0.93):
    usable = [
        v is not None and label is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
        for _, v, label, _ in rows
    ]
    links = []
    for a, (_, v, label, _) in enumerate(rows):
        for b in range(a):
            if usable[a] and usable[b] and label == rows[b][2] and len(v) == len(rows[b][1]):
                x, y = np.array(v, dtype=float), np.array(rows[b][1], dtype=float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                    links += [(a, b), (b, a)]
    of, n = grouped(links), [0] * len(rows)
    for a, _ in links:
        n[a] += 1
    first = {}
    for at, r in enumerate(rows):
        if r[0] is not None:
            first[of.get(at, at)] = min(first.get(of.get(at, at), r[0]), r[0])
    return sorted((str(r[0]), n[at], str(first.get(of.get(at, at)))) for at, r in enumerate(rows))


def same(spark, rows):
    found = V.link_vectors(spark.createDataFrame(rows, SCHEMA), "embedding", "label", "vec_id").collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in found) == plain(rows)
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in found)


def test_equals_comparing_all_pairs(spark):
    rows = sample(1)
    good = rows[0][1]
    rows += [(1, None, 0, "x"), (3, good, None, "x"), (5, [0.0] * 16, 0, "x"), (7, [None, *good[1:]], 0, "x"), (9, [float("nan"), *good[1:]], 0, "x"),
             (11, [float("inf"), *good[1:]], 0, "x"), (13, [], 0, "x"), (15, good, 0, "x"), (15, good, 0, "x"), (17, good[:8], 0, "x"),
             (19, [-x for x in good], 0, "x"), (None, good, 0, "x"), (21, [x * 1e20 for x in good], 0, "x")]
    same(spark, rows)


@pytest.mark.parametrize("shard,block", [(20, 1200), (25, 12), (400, 15)])
def test_shards_and_blocks_lose_nothing(spark, monkeypatch, shard, block):
    monkeypatch.setattr(V, "SHARD", shard)
    monkeypatch.setattr(V, "BLOCK", block)
    same(spark, sample(2))


def test_no_vectors(spark):
    assert V.link_vectors(spark.createDataFrame([], SCHEMA), "embedding", "label", "vec_id").count() == 0


@pytest.mark.parametrize("size", [3, 16])
def test_the_flat_graph_reaches_every_neighbour(size):
    draw = np.random.default_rng(size)
    base = draw.normal(size=(40, size))
    unit = V._unit(np.concatenate([base + draw.normal(size=(40, size)) * s for s in (0, 0.1, 0.3)]))
    distance = V._distances(unit)
    for radius in (0.2, 0.4, 0.8):
        edge = V.robust_pruned(distance, radius)
        assert edge.sum() < edge.size / 2
        found = V.search(distance, edge, np.arange(len(unit)), radius)
        assert (found == (distance <= radius)).all()


@pytest.mark.parametrize("size", [16, 64])
def test_multiples_of_one_vector_reach_each_other(size):
    draw = np.random.default_rng(size)
    base = draw.normal(size=(60, size)).astype(np.float32)
    for factors in (2.0 ** np.arange(10), 3.0 ** np.arange(10)):
        unit = V._unit(np.concatenate([base * np.float32(f) for f in factors]))
        distance = V._distances(unit)
        radius = math.sqrt(2 - 2 * 0.93) + 1e-6
        found = V.search(distance, V.robust_pruned(distance, radius), np.arange(len(unit)), radius)
        assert (found == (distance <= radius)).all()


def test_groups_of_scaled_copies_equal_comparing_all_pairs(spark):
    rows = sample(5, groups=6, each=4)
    for vec_id, vector, label, _ in rows[:12]:
        rows += [(1000 * vec_id + 2 * k + 1, (np.float32(2.0 ** k) * np.array(vector, np.float32)).tolist(), label, "x") for k in range(1, 10)]
    rows += [(999_999, [0.0, 1.0] * 8, 0, "x"), (999_997, [-0.0, 1.0] * 8, 0, "x")]
    same(spark, rows)
