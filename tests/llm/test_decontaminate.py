from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rovelog.llm import common
from rovelog.llm import decontaminate as D


def plain_align(a, b):
    table, best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)], (0, 0)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (D.MATCH if x == y else D.MISMATCH), table[i - 1][j] + D.GAP, table[i][j - 1] + D.GAP)
            if (table[i][j], -j) > (best[0], -best[1]):
                best = (table[i][j], j)
    return best


def test_alignment_equals_the_full_table():
    draw = random.Random(2)
    for _ in range(200):
        a = np.array([draw.randrange(5) for _ in range(draw.randrange(0, 12))], dtype=np.uint64)
        b = np.array([draw.randrange(5) for _ in range(draw.randrange(0, 25))], dtype=np.uint64)
        score, end = D.align(a, b)
        assert (score, end if score else 0) == plain_align(a.tolist(), b.tolist())


def corpus(seed=1):
    draw = random.Random(seed)
    fresh = lambda n: [draw.choice("of the and in".split()) if draw.random() < 0.3 else "".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    items = [(i, fresh(draw.randrange(15, 60))) for i in range(12)]
    docs, expected = [], {}
    for at in range(120):
        words = fresh(draw.randrange(0, 200))
        if at % 4 == 0:
            name, own = items[at % 12]
            own = list(own)
            for _ in range(len(own) // 8 if at % 8 else 0):
                spot = draw.randrange(len(own))
                own[spot:spot + 1] = draw.choice([[], fresh(1), [own[spot], *fresh(1)]])
            cut = draw.randrange(len(words) + 1)
            words = words[:cut] + own + words[cut:]
            expected[at] = name
        docs.append((at, " ".join(words).capitalize() + "."))
    return [(i, " ".join(w)) for i, w in items], docs, expected


@pytest.mark.parametrize("broadcast", [common.BROADCAST_BYTES, 0])
def test_copies_and_edited_copies_are_found_and_others_left_alone(spark, monkeypatch, broadcast):
    monkeypatch.setattr(common, "BROADCAST_BYTES", broadcast)
    items, docs, expected = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string")
    found = D.contaminated_pairs(frame, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == set(expected.items())
    assert all(D.LEAST <= r["score"] <= 1 and r["start"] < r["end"] for r in found)
    # scores are those of aligning whole documents with whole items
    known = D.WordHashes()
    texts, whole = dict(docs), dict(items)
    for r in found:
        a, b = D.word_hashes(whole[r["item_id"]], known), D.word_hashes(texts[r["doc_id"]], known)
        assert r["score"] == pytest.approx(plain_align(a.tolist(), b.tolist())[0] / (D.MATCH * len(a)))
    left = D.without_contaminated(frame, bench)
    assert left.columns == frame.columns
    left = left.collect()
    assert {r["doc_id"] for r in left} == {i for i, _ in docs} - set(expected)


def test_a_passage_in_most_documents_keeps_its_seeds(spark):
    items = [(0, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu")]
    docs = [(i, f"start{i} {items[0][1]} end{i}") for i in range(80)] + [(100 + i, f"alone {i} words here") for i in range(5)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = D.contaminated_pairs(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(r["doc_id"] for r in found.collect()) == list(range(80))


def test_odd_rows(spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "one two"), (None, "a b c d e f g h"), (4, "a b c d e f g h")], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, "one two"), (None, "x A b, c d e f g h!"), (4, "q " * 50_000 + "a b c d e f g h"), (4, "a b c d e f g h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = D.contaminated_pairs(docs, bench).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"] or 0) for r in found) == [(0, 0), (0, 4), (4, 0), (4, 0), (4, 4), (4, 4)]
    assert D.contaminated_pairs(docs.limit(0), bench).count() == 0
    assert D.contaminated_pairs(docs, bench.limit(0)).count() == 0
    clashing = docs.select("doc_id", "text", *(F.lit(1).alias(c) for c in ("bad_body", "body", "key", "_body", "_gram")))
    left = D.without_contaminated(clashing, bench)
    assert left.columns == clashing.columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == [(1, None), (2, ""), (3, "one two")]
    assert D.without_contaminated(docs.limit(0), bench).count() == 0
    assert D.without_contaminated(docs, bench.limit(0)).count() == len(rows)


@pytest.mark.parametrize("edit", ["insert 3", "exchange 5", "exchange 4"])
def test_every_copy_of_one_edited_passage_is_found(spark, edit):
    """However many there are: 1,000 documents hold the same passage, most of its 3-grams are not the item's."""
    words = [f"word{i}" for i in range(40)]
    how, step = edit.split()
    passage = []
    for i, w in enumerate(words, 1):
        passage += ([w, f"new{i}"] if how == "insert" else [f"new{i}"]) if i % int(step) == 0 else [w]
    docs = [(i, f"before{i} {' '.join(passage)} after{i}") for i in range(1000)] + [(5000 + i, f"word3 word4 word5 alone{i}") for i in range(20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    score = plain_align(words, passage)[0] / (D.MATCH * len(words))
    assert score >= D.LEAST
    found = D.contaminated_pairs(frame, bench).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(1000))
    assert all(r["score"] == pytest.approx(score) for r in found)
    assert D.without_contaminated(frame, bench).count() == 20


def test_a_long_excerpt_of_a_longer_item_is_found(spark):
    words = [f"word{i}" for i in range(600)]
    docs = [(1, " ".join(words[137:437])), (2, " ".join(words[137:337])), (3, "before " + " ".join(words) + " after"), (4, " ".join(words[::2])), (5, " ".join(words[3:33]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = D.contaminated_pairs(frame, spark.createDataFrame([(0, " ".join(words))], "item_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in found) == [1, 2, 3]
    assert all(r["score"] == 1 and r["end"] - r["start"] == D.PART for r in found)


def test_an_item_that_reaches_the_least_score_has_a_part_that_does():
    draw = random.Random(5)
    for _ in range(40):
        words = np.array([draw.randrange(1 << 40) for _ in range(draw.randrange(101, 420))], dtype=np.uint64)
        kept = [w for w in words.tolist() if draw.random() < 0.85]
        if plain_align(words.tolist(), kept)[0] >= D.LEAST * D.MATCH * len(words):
            assert any(D.aligned(part, np.array(kept, dtype=np.uint64)) for part in D.parts_of(words))


def test_seeds_are_rare_and_cover_every_place(spark, monkeypatch):
    """Many items share a passage: its n-grams get longer, the longest stay, and the copies are still found."""
    monkeypatch.setattr(D, "RARE", 5)
    shared = " ".join(f"say{i}" for i in range(12))
    items = [(i, f"{shared} own{i} one{i} two{i} say3 say4 say5 six{i} ten{i} two{i}") for i in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    parts = D.item_parts(bench).select("part", "words")
    seeds = D.rare_seeds(D.part_grams(parts)).toPandas()
    assert set(seeds.groupby("part")["at"].apply(set).map(frozenset)) == {frozenset(range(19))}
    places = seeds.groupby("at")["gram"].value_counts()
    assert all(places[at].max() == 40 for at in range(5))  # eight words of the shared passage are in all items
    assert all(places[at].max() <= 5 for at in range(5, 19))
    docs = spark.createDataFrame([(i, f"Before {text} after.") for i, text in items] + [(99, "some say3 say4 say5 here")], "doc_id long, text string")
    found = D.contaminated_pairs(docs, bench).where("score = 1").collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(i, i) for i in range(40)]


def test_a_benchmark_a_hundred_times_as_large_is_not_sent_whole(spark, monkeypatch):
    """What is sent is the bitmap; joins above the bound are shuffled."""
    monkeypatch.setattr(common, "BROADCAST_BYTES", 20_000)
    sent = []
    monkeypatch.setattr(D, "shipped", lambda spark, value: sent.append(value) or common.shipped(spark, value))
    items, docs, expected = corpus()
    draw = random.Random(9)
    more = [(1000 + i, " ".join("".join(draw.choice("klmnop") for _ in range(7)) for _ in range(30))) for i in range(1200)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = D.contaminated_pairs(frame, spark.createDataFrame(items + more, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == set(expected.items())
    assert len(sent) == 2 and all(len(b.packed) * 64 <= 1 << D.MOST_BITS for b in sent)
