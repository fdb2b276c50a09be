from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rovelog.llm import quality as Q


def corpus(n=240, seed=3):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdeilmnorst") for _ in range(draw.randrange(2, 9))) for _ in range(400)]
    rows = []
    for i in range(n):
        own = [draw.choice(words) for _ in range(draw.randrange(30, 200))]
        bad = i % 3 == 0
        text = " ".join(w.upper() + "!!" for w in own) if bad and i % 2 else " ".join(own[:3] * 40) if bad else " ".join(own) + "."
        rows.append((i, text, 0 if bad else 1))
    return rows


def test_scores_equal_two_normal_densities():
    draw = np.random.default_rng(0)
    width = 4
    rows = [draw.normal(k, 1 + k, (80, width)) @ draw.normal(size=(width, width)) for k in (0, 1)]
    model = Q.fit({k: (len(r), r.sum(0), r.T @ r) for k, r in enumerate(rows)}, width)
    n = np.array([len(r) for r in rows])
    cov = [np.cov(r.T, bias=True) for r in rows]
    pooled = sum(c * m for c, m in zip(cov, n)) / n.sum()
    pooled = (1 - Q.TO_SPHERE) * pooled + Q.TO_SPHERE * np.diag(np.diag(pooled) + 1e-4)
    asked = draw.normal(size=(20, width)) * 3
    logs = []
    for k in (0, 1):
        c = (1 - Q.TO_POOLED) * cov[k] + Q.TO_POOLED * pooled + 1e-6 * np.eye(width)
        away = asked - rows[k].mean(0)
        logs.append(math.log(n[k] / n.sum()) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,jk,ik->i", away, np.linalg.inv(c), away))
    expected = 1 / (1 + np.exp((logs[0] - logs[1]) / Q.TEMPERATURE))
    assert model.score(asked) == pytest.approx(expected, abs=1e-9)


def test_learns_from_other_folds_only_and_judges_the_held_out(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    found = Q.score_documents(docs, labels).collect()
    held = [r for r in found if r["held_out"]]
    assert len(found) == len(rows) and 50 < len(held) < 120
    assert sum(r["predicted"] == rows[r["doc_id"]][2] for r in held) / len(held) > 0.95
    # labels of the held-out fold change nothing
    wrong = labels.withColumn("quality", F.when(Q.fold("doc_id", 3) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {(r["doc_id"], round(r["score"], 9)) for r in Q.score_documents(docs, wrong).collect()} == {
        (r["doc_id"], round(r["score"], 9)) for r in found
    }
    kept = {r["doc_id"] for r in Q.keep_good(docs, labels).collect()}
    assert kept == {r["doc_id"] for r in found if r["predicted"] == 1}
    assert Q.keep_good(docs, labels).columns == docs.columns


def test_odd_rows(spark):
    rows = [(i, t) for i, t, _ in corpus(60)] + [(None, None), (1, ""), (2, "\n \n"), (2, "\n \n"), (999, "y " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, q) for i, _, q in corpus(60)] + [(None, 1), (5, None), (7, 0), (7, 0), (4, 9)], "doc_id long, quality int"
    )
    found = Q.score_documents(docs, labels).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    assert not any(r["held_out"] for r in found if r["doc_id"] is None)
    assert {r["score"] for r in Q.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert {r["score"] for r in Q.score_documents(docs, labels.where("quality = 1")).collect()} == {0.5}
    assert Q.score_documents(docs.limit(0), labels).count() == 0


def test_held_out_accuracy(spark):
    found = Q.op2_quality_qda(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = found.where("held_out").join(labels, "doc_id").collect()
    assert sum(r["quality"] == r["predicted"] for r in held) / len(held) > 0.97
