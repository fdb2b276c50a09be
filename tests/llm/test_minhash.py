from __future__ import annotations

import random
import re

import numpy as np
import pytest

from rovelog.llm import linking
from rovelog.llm import minhash as M
from tests.llm.test_common import grouped

SCHEMA = "doc_id long, text string, kept string"


def copies(seed, groups, each, words=60, edits=3):
    """Groups of near copies, some exact copies, and texts on their own."""
    draw, out = random.Random(seed), []
    fresh = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    for _ in range(groups):
        base = [fresh() for _ in range(words)]
        for _ in range(each):
            own = list(base)
            for _ in range(draw.randrange(edits)):
                own[draw.randrange(words)] = fresh()
            out.append(" ".join(own))
        out.append(" ".join(base).upper() + " \t")
    out += [" ".join(fresh() for _ in range(draw.randrange(1, words))) for _ in range(groups * 2)]
    return out


def plain(rows, size, percent=80):
    """n_shingles and component by comparing all pairs."""
    sets = []
    for _, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        run = min(size, len(words))
        sets.append({tuple(words[i:i + run]) for i in range(len(words) - run + 1)} if words else set())
    links = [
        (a, b) for a in range(len(rows)) for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    of = grouped(links)
    least = {}
    for at, (name, *_) in enumerate(rows):
        if name is not None:
            least[of.get(at, at)] = min(least.get(of.get(at, at), name), name)
    return [(r[0], len(s), least.get(of.get(at, at)) if s else r[0]) for at, (r, s) in enumerate(zip(rows, sets))]


def same(rows, found):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=key) == sorted(plain(rows, 4), key=key)
    assert all(r["kept"] == (r["doc_id"] is not None and r["doc_id"] == r["component_id"]) for r in found)


def test_equals_comparing_all_pairs(spark):
    rows = [(i * 3, t, "x") for i, t in enumerate(copies(1, 8, 5))]
    rows += [(1, None, "x"), (2, "", "x"), (4, "  \n", "x"), (5, "a b", "x"), (7, "A  b", "x"), (None, "a b", "x"), (0, rows[0][1], "y"),
             (8, "a b c d e", "x"), (10, " ".join(f"w{i % 977}" for i in range(30_000)), "x")]
    same(rows, M.near_duplicates(spark.createDataFrame(rows, SCHEMA), 4).collect())


@pytest.mark.parametrize("small,pivots", [(4, 2), (3, 1)])
def test_large_buckets_are_split_and_their_rest_compared(spark, monkeypatch, small, pivots):
    monkeypatch.setattr(linking, "SMALL", small)
    monkeypatch.setattr(linking.pairs_with_pivots, "__defaults__", (pivots,))
    rows = [(i, t, "x") for i, t in enumerate(copies(2, 2, 40, words=50, edits=7))]
    same(rows, M.near_duplicates(spark.createDataFrame(rows, SCHEMA), 4).collect())


def test_no_documents(spark):
    assert M.near_duplicates(spark.createDataFrame([], SCHEMA), 4).count() == 0
    assert M.keep_one_of_each(spark.createDataFrame([], SCHEMA), 5).count() == 0


def test_one_of_each_group_stays(spark):
    rows = [(i, t, "x") for i, t in enumerate(copies(3, 3, 4))]
    rows += [(0, rows[0][1], "x"), (None, "p q r", "x"), (None, "p q r", "y"), (None, "s t u", "z"), (90, "", "x"), (91, None, "x"), (92, "", "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = M.keep_one_of_each(docs, 4)
    assert found.columns == docs.columns
    of = plain(rows, 4)
    heads = sorted({c for (_, n, c) in of if n and c is not None})
    left = [r["doc_id"] for r in found.collect()]
    assert sorted(x for x in left if x is not None) == sorted(heads + [90, 91, 92])
    assert left.count(None) == 2


def test_recall_of_the_trees():
    assert M.recall(0.8) > 0.998 and M.recall(0.9) > 0.99999
    draw = np.random.default_rng(4)
    met, pairs = 0, 300
    for _ in range(pairs):
        shared = draw.integers(0, 1 << 62, 320, dtype=np.uint64)
        own = draw.integers(0, 1 << 62, 80, dtype=np.uint64)
        two = np.stack([M.signature(np.concatenate([shared, own[:40]])), M.signature(np.concatenate([shared, own[40:]]))])
        rows = np.tile([0, 1], M.TREES)
        nodes, rows = M.paths(np.repeat(M._mixed(np.arange(1, M.TREES + 1, dtype=np.uint64)), 2), rows, two, M.DEPTH)
        met += bool(set(nodes[rows == 0].tolist()) & set(nodes[rows == 1].tolist()))
    assert met / pairs > 0.98  # similarity 0.8


def test_agreement_counts_equal_nibbles(spark):
    draw = np.random.default_rng(1)
    a = draw.integers(-(1 << 63), 1 << 63, (20, 8))
    b = np.where(draw.random((20, 8)) < 0.5, a, a ^ draw.integers(0, 1 << 62, (20, 8)))
    rows = spark.createDataFrame([(x.tolist(), y.tolist()) for x, y in zip(a, b)], "a array<long>, b array<long>")
    nibbles = lambda x: [(int(v) >> s) & 15 for v in x for s in range(0, 64, 4)]
    from pyspark.sql import functions as F

    found = [r[0] for r in rows.select(M.agreement(F.col("a"), F.col("b"))).collect()]
    assert found == [sum(p == q for p, q in zip(nibbles(x), nibbles(y))) for x, y in zip(a, b)]


def test_recall_below_large_nodes():
    """Threshold pairs whose nodes are all large are found as often as others: on paper, and by the trees."""
    assert M.recall(0.8, below=M.found_below(0.8)) > 0.998
    draw = np.random.default_rng(5)
    met, pairs = 0, 400
    roots = np.repeat(M._mixed(np.arange(1, M.TREES + 1, dtype=np.uint64)), 2)
    for _ in range(pairs):
        shared = draw.integers(0, 1 << 62, 320, dtype=np.uint64)
        own = draw.integers(0, 1 << 62, 80, dtype=np.uint64)
        two = np.stack([M.signature(np.concatenate([shared, own[:40]])), M.signature(np.concatenate([shared, own[40:]]))])
        nodes, rows = M.paths(roots, np.tile([0, 1], M.TREES), two, M.DEPTH)
        nodes, rows = M.restarted(nodes, rows, two)
        met += bool(set(nodes[rows == 0].tolist()) & set(nodes[rows == 1].tolist()))
    assert met / pairs > 0.985


def test_threshold_pairs_among_many_texts_of_one_template_are_linked(spark, monkeypatch):
    """150 pairs of similarity 0.8 among texts that share a passage; every node counts as large."""
    monkeypatch.setattr(linking, "SMALL", 2)
    draw = random.Random(6)
    fresh = lambda k: ["".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(k)]
    passage, rows = fresh(30), []
    for i in range(150):
        own = fresh(60)
        for side in range(2):
            rows.append((2 * i + side, " ".join(passage + own + fresh(10)), "x"))
    same(rows, M.near_duplicates(spark.createDataFrame(rows, SCHEMA), 4).collect())
