"""Quality classifier: regularised quadratic discriminant on transformed document statistics.

Each class has its own mean and covariance.  A covariance is shrunk towards the pooled one and
that towards its mean variance, so that it stays positive definite and close to what the rows can
support; its Cholesky factor is computed once and sent with the model.  A document's score is the
logistic of the difference of the two log densities, each from the Mahalanobis distance and the
log determinant of its class.

Only sums over rows (count, sum, sum of products) are gathered, over every labelled training row.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rovelog.llm.common import fold, shipped, small_batches, stored, table

FOLDS, HELD_OUT_FOLD = 3, 1
#: Weight of the pooled covariance in each class, and of the mean variance in the pooled one.
TO_POOLED, TO_SPHERE = 0.1, 0.02
#: The log-density difference is divided by this before the logistic: statistics of a text are not independent.
TEMPERATURE = 4.0

FEATURES = (
    "log_words", "log_word_length", "long_words", "symbols", "marked_words", "capitals", "digits", "distinct_words",
    "top_word", "repeated_pairs", "repeated_lines", "pipes", "bad_line", "sentence_ends", "short_words",
)

_SYMBOL = re.compile(r"[^\w\s.,;:'\"()?-]")
_MARKED = re.compile(r"[!#$%&*|@^~<>{}\[\]\\=+]")
_DIGIT = re.compile(r"\d")
_END = re.compile(r"[.!?](?=\s|$)")


def _share(part: float, whole: float, among: float = 0.0) -> float:
    """A share in arcsine form, which spreads values near 0 and 1; ``among`` damps it where ``whole`` is small."""
    return float(np.arcsin(np.sqrt(min(1.0, part / (whole + among))))) if whole else 0.0


def statistics(text: str | None) -> list[float]:
    """The FEATURES of a whole text; a null or empty text has zeros."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    n, letters = len(words), len(text)
    symbols = len(_SYMBOL.findall(text))
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    lines = [line for line in text.split("\n") if line.strip()]
    marked_lines = sum(len(line) for line in lines if len(_MARKED.findall(line)) * 8 >= len(line.split()))
    inner = sum(map(len, words))
    return [
        float(np.log1p(n)),
        float(np.log(inner / n)),
        _share(sum(c for w, c in counts.items() if len(w) > 14), n),
        _share(symbols, letters),
        _share(sum(c for w, c in counts.items() if _MARKED.search(w)), n),
        _share(sum(c * sum(map(str.isupper, w)) for w, c in counts.items()), inner, 100),
        _share(len(_DIGIT.findall(text)), letters, 200),
        float(np.log(len(counts) / n)),
        _share(max(counts.values()) - 1, n, 10),
        _share(sum(c - 1 for c in pairs.values()), n, 40),
        _share(len(lines) - len(set(lines)), len(lines), 8),
        _share(text.count("|"), n),
        _share(marked_lines, letters),
        _share(len(_END.findall(text)), n),
        _share(sum(c for w, c in counts.items() if len(w) <= 3), n),
    ]


def features(text: Column) -> Column:
    small_batches(SparkSession.active())

    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts], dtype=object)

    return of(text)


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log constants of class 0 and class 1."""

    mean: np.ndarray
    whiten: np.ndarray
    constant: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        densities = [
            self.constant[k] - 0.5 * np.square((rows - self.mean[k]) @ self.whiten[k].T).sum(axis=1) for k in (0, 1)
        ]
        return 1.0 / (1.0 + np.exp(np.clip((densities[0] - densities[1]) / TEMPERATURE, -500, 500)))


def fit(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], width: int) -> Discriminant | None:
    """From (count, sum, sum of outer products) of each class; None unless both classes have rows."""
    if not all(sums.get(k, (0,))[0] for k in (0, 1)):
        return None
    n = np.array([sums[k][0] for k in (0, 1)])
    mean = np.stack([sums[k][1] / sums[k][0] for k in (0, 1)])
    cov = np.stack([sums[k][2] / sums[k][0] - np.outer(mean[k], mean[k]) for k in (0, 1)])
    pooled = np.einsum("k,kij->ij", n / n.sum(), cov)
    sphere = np.diag(np.diag(pooled) + 1e-4)
    pooled = (1 - TO_SPHERE) * pooled + TO_SPHERE * sphere
    factor = [np.linalg.cholesky((1 - TO_POOLED) * c + TO_POOLED * pooled + 1e-6 * np.eye(width)) for c in cov]
    constant = np.array([np.log(n[k] / n.sum()) - np.log(np.diag(factor[k])).sum() for k in (0, 1)])
    return Discriminant(mean, np.stack([np.linalg.inv(f) for f in factor]), constant)


def train(labelled: DataFrame) -> Discriminant | None:
    """``labelled`` has _x (features) and _y (0 or 1); rows with another _y teach nothing."""
    width = len(FEATURES)
    upper = [(i, j) for i in range(width) for j in range(i, width)]
    at = lambda i: F.element_at("_x", i + 1)
    rows = (
        labelled.where("_y in (0, 1)")
        .groupBy("_y")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.sum(at(i)) for i in range(width)]).alias("s"),
            F.array(*[F.sum(at(i) * at(j)) for i, j in upper]).alias("p"),
        )
        .collect()  # two rows
    )
    sums = {}
    for row in rows:
        products = np.zeros((width, width))
        for (i, j), value in zip(upper, row["p"]):
            products[i, j] = products[j, i] = value
        sums[row["_y"]] = (row["n"], np.array(row["s"]), products)
    return fit(sums, width)


def score(x: Column, model: Discriminant | None, spark: SparkSession) -> Column:
    """The score of a features column; 0.5 where no model could be trained."""
    model_of = shipped(spark, model)

    @F.pandas_udf("double")
    def of(rows: pd.Series) -> pd.Series:
        if model_of() is None or not len(rows):
            return pd.Series(0.5, index=rows.index, dtype="float64")
        return pd.Series(model_of().score(np.stack(rows.to_numpy())), index=rows.index)

    return of(x)


def training_rows(described: DataFrame, labels: DataFrame) -> DataFrame:
    """Features (doc_id, _x) of documents outside the held-out fold with each of their quality labels."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_y")).where(
        (fold("_id", FOLDS) != HELD_OUT_FOLD) & F.col("_y").isNotNull()
    )
    return described.join(known, F.col("doc_id") == F.col("_id")).select("_x", "_y")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    Null and empty texts are scored like others, by features of zero.  A null doc_id is not held
    out and has no label.  Repeated rows are scored alike; repeated labels count as often as they
    occur.  Without labels of both kinds every score is 0.5.  Other columns are not read.
    """
    described = stored(docs.select("doc_id", features(F.col("text")).alias("_x")))
    model = train(training_rows(described, labels))
    return described.select(
        "doc_id",
        F.coalesce(fold("doc_id", FOLDS) == HELD_OUT_FOLD, F.lit(False)).alias("held_out"),
        score(F.col("_x"), model, docs.sparkSession).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, that are not rejected."""
    described = docs.select("doc_id", features(F.col("text")).alias("_x"))
    model = train(training_rows(described, labels))
    return docs.where(score(features(F.col("text")), model, docs.sparkSession) >= 0.5)


def op2_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
