from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from rovelog.llm import language_id as L


def test_chunks_give_the_same_grams(monkeypatch):
    draw = random.Random(1)
    for size in (0, 1, 2, 3, 50, 64, 65, 200):
        text = "".join(draw.choice("abcäéñ .A") for _ in range(size))
        whole = Counter(np.concatenate(list(L.hashed_grams(text))).tolist())
        monkeypatch.setattr(L, "CHUNK", 16)
        assert Counter(np.concatenate(list(L.hashed_grams(text))).tolist()) == whole
        monkeypatch.undo()
        assert sum(whole.values()) == 2 * (size + 2) - 3  # pairs and triples of the padded text


def test_scores_equal_plain_naive_bayes(spark):
    rows = [("en", "the cat and the dog"), ("en", "this is the house"), ("de", "der hund und die katze"), (None, "the"), ("de", None)]
    languages, counts, texts = L.count_grams(spark.createDataFrame(rows, "_lang string, _text string"))
    assert languages == ["de", "en"] and texts.tolist() == [1, 2]
    grams, prior = L.log_probabilities(counts, texts)
    for text in ("the dog", "die katze und", "x"):
        slots = Counter(np.concatenate(list(L.hashed_grams(text))).tolist())
        logs = []
        for k, lang in enumerate(languages):
            own = Counter(s for la, t in rows if la == lang and t for g in L.hashed_grams(t) for s in g.tolist())
            total = sum(own.values()) + L.SMOOTHING * L.BUCKETS
            logs.append(math.log(texts[k] / 3) + sum(n * math.log((own[s] + L.SMOOTHING) / total) for s, n in slots.items()))
        posterior = 1 / sum(math.exp(x - max(logs)) for x in logs)
        name, score = L.classify(text, languages, grams, prior)
        assert name == languages[int(np.argmax(logs))] and score == pytest.approx(posterior)


def test_rows(spark):
    rows = [(1, "the cat", "en", "a"), (2, "die katze", "de", "b"), (3, None, "en", "c"), (4, "", None, "d"), (5, "12 34 !", "en", "e"),
            (None, "the " * 200_000, "en", "f"), (1, "the cat", "en", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    found = L.identify(docs, docs).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert [by_id[i]["lang_pred"] for i in (1, 2, 3, 4, 5, None)] == ["en", "de", "und", "und", "und", "en"]
    assert all(0 <= r["score"] <= 1 for r in found)
    nothing = L.identify(docs, docs.limit(0)).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"} and len(nothing) == len(rows)
    assert L.identify(docs.limit(0), docs).count() == 0


def test_held_out_accuracy(spark):
    found = L.op9_language_id(spark, "/root/testdata/sf0.01")
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = found.where("held_out").join(lang, "doc_id").collect()
    assert len(held) > 100 and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.98
