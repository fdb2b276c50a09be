"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training adds up n-gram counts per language in a table of fixed width, over every training row.
The log-probability matrix (BUCKETS x languages) is broadcast; a batch of texts is scored in numpy
by gathering the matrix rows of its n-grams and summing them per text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rovelog.llm.common import fold, small_batches, table

BUCKETS = 1 << 15
#: Pseudo-count of every n-gram in every language.
SMOOTHING = 0.5
#: More languages than this are taken for an error: the broadcast matrix has BUCKETS * languages numbers.
MOST_LANGUAGES = 500
UNDETERMINED = "und"
#: Characters of a text that are hashed at once, so that memory does not follow the longest text.
CHUNK = 1 << 20
FOLDS, HELD_OUT_FOLD = 4, 2


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def hashed_grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of all 2- and 3-grams of the lower-cased text with a space at both ends, in chunks."""
    text = f" {text.lower()} "
    for at in range(0, len(text), CHUNK):
        chars = np.frombuffer(text[max(0, at - 2):at + CHUNK].encode("utf-32-le"), dtype=np.uint32)
        carried = min(at, 2)  # characters of the chunk before
        pair = chars[:-1] * np.uint32(0x9E3779B1) + chars[1:] * np.uint32(0x85EBCA77)
        triple = pair[:-1] * np.uint32(0xC2B2AE3D) + chars[2:] * np.uint32(0x27D4EB2F) + np.uint32(1)
        pair = pair[max(0, carried - 1):]
        pair ^= pair >> np.uint32(15)
        triple ^= triple >> np.uint32(15)
        yield np.concatenate([pair * np.uint32(0x2C1B3C6D) >> np.uint32(17), triple * np.uint32(0x2C1B3C6D) >> np.uint32(17)])


def count_grams(training: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages in order, their n-gram counts (languages x BUCKETS) and their numbers of texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch["_lang"], batch["_text"]):
                total = grams.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                texts[lang] = texts.get(lang, 0) + 1
                for slots in hashed_grams(text):
                    total += np.bincount(slots, minlength=BUCKETS)
        for lang, total in grams.items():
            at = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "slot": np.append(at, -1), "n": np.append(total[at], texts[lang])})

    usable = training.where("_lang is not null and _text is not null")
    rows = (
        usable.mapInPandas(count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    )
    languages = sorted(r["lang"] for r in rows.where("slot = -1").select("lang").limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    found = rows.toPandas()  # at most (BUCKETS + 1) * MOST_LANGUAGES rows
    place = found["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy(dtype=np.int64)
    counts = np.zeros((len(languages), BUCKETS + 1))
    counts[place, found["slot"].to_numpy()] = found["n"].to_numpy()
    return languages, counts[:, :-1], counts[:, -1]


def log_probabilities(counts: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(BUCKETS x languages) log-probabilities of n-grams, and log-priors."""
    smooth = counts + SMOOTHING
    return np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.copy(), np.log(texts / texts.sum())


def classify(text: str | None, languages: list[str], grams: np.ndarray, prior: np.ndarray) -> tuple[str, float]:
    """The likeliest language (the first of equals) and its posterior probability."""
    if not languages or not has_letter(text):
        return UNDETERMINED, 0.0
    total = prior.copy()
    for slots in hashed_grams(text):
        total += np.bincount(slots, minlength=BUCKETS) @ grams if len(slots) > BUCKETS else grams[slots].sum(axis=0)
    best = int(total.argmax())
    return languages[best], float(1.0 / np.exp(total - total[best]).sum())


def identify(
    docs: DataFrame, training: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang"
) -> DataFrame:
    """One row for each row of ``docs``: ``key``, lang_pred and score.

    ``training`` has a ``text`` and a ``lang`` column; rows with a null in either teach nothing.
    A null text, or one without a letter, or any text when nothing could be learned, is ``und``
    with score 0.  Repeated rows are scored alike.  Other columns are not read.
    """
    small_batches(docs.sparkSession)
    learned = training.select(F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    languages, counts, texts = count_grams(learned)
    model = docs.sparkSession.sparkContext.broadcast((languages, *log_probabilities(counts, texts)))

    @F.pandas_udf("lang_pred string, score double")
    def predicted(bodies: pd.Series) -> pd.DataFrame:
        names, grams, prior = model.value
        return pd.DataFrame([classify(t, names, grams, prior) for t in bodies], columns=["lang_pred", "score"])

    return docs.select(F.col(key), predicted(F.col(text)).alias("_p")).select(key, "_p.lang_pred", "_p.score")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT_FOLD, F.lit(False))
    found = identify(docs, docs.where(~held_out))
    return found.withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score")
