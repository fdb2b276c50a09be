"""Benchmark decontamination: rare n-gram seeds join documents to test items, Smith-Waterman scores the words around them.

Items are cut into equal parts of at most PART words; copied items and parts count once.  Every place
of a part has one seed: its shortest n-gram of LENGTHS that is rare, that is, found at no more than
RARE places of all parts, or its longest one where none is.  So each place is covered, however often
the corpus holds it, and a seed in a document meets a bounded number of parts.  Rarity is not judged
by the corpus: an edited passage that was copied into very many documents makes just those n-grams
common there that its copies kept.

Documents are read once.  A bitmap of fixed size tells which of their n-grams may be seeds; the words
around such places go on, once for all documents of the same text, and the seeds among them are joined
to the seeds of the parts.  A window of three times the part's length around each meeting is aligned
locally, if the words that both have allow it; the score, divided by that of the whole part aligned
with itself, tells a copy, an edited copy or a paraphrase from a chance hit.  An item that reaches LEAST
has a part that does, because scores of disjoint parts add up; so does any excerpt of 2 * PART words.

What a task holds does not depend on the size of the benchmark: the joins with its seeds and words are
broadcast up to a counted size and shuffled beyond.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rovelog.llm.common import join_counted, shipped, small_batches, stored, stored_alone, table, unused

#: Words of a seed, shortest first.
LENGTHS = (3, 4, 6, 8)
#: Places of all parts at which an n-gram may be and still count as rare.
RARE = 64
#: Words of an item that are aligned at once.
PART = 100
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of the part's own score from which a document is contaminated.
LEAST = 0.6
#: Bits of the bitmap, as powers of two: for each n-gram 64, within these bounds.
FEWEST_BITS, MOST_BITS = 24, 27

_WORD = re.compile(r"\w+")
_U = np.uint64


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace"))
        return found


def word_hashes(text: str | None, known: WordHashes) -> np.ndarray:
    words = _WORD.findall((text or "").lower())
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def grams(words: np.ndarray, length: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the n-grams of ``length`` words, of all places or of those ``at`` which they fit."""
    count = max(0, len(words) - length + 1) if at is None else len(at)
    total = np.full(count, length, dtype=np.uint64)
    for i in range(length):
        total += (words[i : i + count] if at is None else words[at + i]) * _U((2 * i + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    total = (total ^ (total >> _U(32))) * _U(0xC2B2AE3D27D4EB4F)
    return total ^ (total >> _U(29))


def parts_of(words: np.ndarray) -> list[np.ndarray]:
    """``words`` in equal parts of at most PART; none of fewer than a shortest seed."""
    if len(words) < LENGTHS[0]:
        return []
    return np.array_split(words, math.ceil(len(words) / PART))


class Bitmap:
    """May an n-gram be one of a set?  A bit for each value of its upper bits."""

    def __init__(self, bits: int, packed: np.ndarray):
        self.shift, self.packed = _U(64 - bits), packed

    def holds(self, values: np.ndarray) -> np.ndarray:
        bit = values >> self.shift
        return (self.packed[(bit >> _U(6)).astype(np.int64)] >> (bit & _U(63))) & _U(1) == 1


def bitmap(values: DataFrame, column: str) -> Bitmap:
    """The bitmap of a column of 64-bit hashes, put together by an aggregate."""
    bits = min(MOST_BITS, max(FEWEST_BITS, (values.count() * 64).bit_length()))
    bit = F.shiftrightunsigned(F.col(column), 64 - bits)
    set_ = F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - bits}) & 63 as int))")
    found = values.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(set_).alias("bits")).toArrow()
    packed = np.zeros(1 << (bits - 6), dtype=np.uint64)
    packed[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Bitmap(bits, packed)


def _merged(places: np.ndarray, reach: int) -> Iterator[tuple[int, int]]:
    """Spans of ``reach`` around sorted places, those that touch as one."""
    cuts = np.flatnonzero(np.diff(places) > 2 * reach) + 1
    for run in np.split(places, cuts):
        yield max(0, int(run[0]) - reach), int(run[-1]) + reach


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Smith-Waterman score of the best local alignment, and where it ends in ``b`` (the first of equals).

    Row by row over ``a``; within a row, the running maximum stands for the gaps along ``b``.
    """
    if not len(a) or not len(b):
        return 0, 0
    steps = np.arange(1, len(b) + 1) * -GAP
    row, best, end = np.zeros(len(b) + 1, dtype=np.int64), 0, 0
    for word in a:
        new = np.maximum(np.maximum(row[:-1] + np.where(b == word, MATCH, MISMATCH), row[1:] + GAP), 0)
        new = np.maximum.accumulate(new + steps) - steps
        row[1:] = new
        at = int(new.argmax())
        if new[at] > best or new[at] == best and at + 1 < end:
            best, end = int(new[at]), at + 1
    return best, end


def aligned(own: np.ndarray, window: np.ndarray) -> tuple[float, int, int] | None:
    """Share of the part's own score, first word and word after the last in ``window``; None below LEAST."""
    whole = MATCH * len(own)
    counts, there = Counter(own.tolist()), window.tolist()
    if MATCH * sum(map(counts.__contains__, there)) < LEAST * whole:
        return None  # no alignment can match more words than both have
    there = Counter(there)
    if MATCH * sum(min(n, there[w]) for w, n in counts.items()) < LEAST * whole:
        return None
    score, last = align(own, window)
    if score < LEAST * whole:
        return None
    _, back = align(own[::-1], window[:last][::-1])
    return score / whole, last - back, last


def item_parts(benchmark: DataFrame) -> DataFrame:
    """(item, part, words): the parts of each distinct text; equal parts share their name."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            rows = [
                (item, xxhash.xxh3_128_hexdigest(own.tobytes()), own.view(np.int64).tolist())
                for item, text in zip(batch["item"], batch["text"])
                for own in parts_of(word_hashes(text, known))
            ]
            yield pd.DataFrame(rows, columns=["item", "part", "words"])

    texts = benchmark.where("text is not null").groupBy(F.md5("text").alias("item")).agg(F.min("text").alias("text"))
    return texts.mapInPandas(run, "item string, part string, words array<long>")


def part_grams(parts: DataFrame) -> DataFrame:
    """(part, size, at, length, gram) of every n-gram of LENGTHS of every part."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for part, words in zip(batch["part"], batch["words"]):
                own = np.array(words, dtype=np.int64).view(np.uint64)
                for length in LENGTHS:
                    rows += [(part, len(own), at, length, gram) for at, gram in enumerate(grams(own, length).view(np.int64).tolist())]
            yield pd.DataFrame(rows, columns=["part", "size", "at", "length", "gram"])

    return parts.mapInPandas(run, "part string, size int, at int, length int, gram long")


def rare_seeds(all_grams: DataFrame) -> DataFrame:
    """(part, size, at, gram): for each place its shortest rare n-gram, or its longest if none is rare."""
    common = stored(
        all_grams.groupBy(F.col("gram").alias("_gram")).agg(F.count(F.lit(1)).alias("_places")).where(F.col("_places") > RARE)
    )
    told = join_counted(all_grams, common, F.col("gram") == F.col("_gram"), "left", 32)
    order = F.when(F.col("_places").isNull(), F.col("length")).otherwise(2 * LENGTHS[-1] + 1 - F.col("length"))
    return told.groupBy("part", "size", "at").agg(F.min_by("gram", order).alias("gram"))


def segments(docs: DataFrame, starts: Callable[[], Bitmap], seeds: Callable[[], Bitmap], longest: int) -> DataFrame:
    """(key, body, start, first, words, hits) of the words around what may be seeds.

    ``starts`` knows the shortest n-grams of all places, seed or not, since a longer seed starts with one.
    No window of a part of at most ``longest`` words reaches further than what is kept.
    """
    reach = 5 * longest // 2 + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            rows = []
            for key, body, text in zip(batch["key"], batch["body"], batch["text"]):
                words = word_hashes(text, known)
                at = np.flatnonzero(starts().holds(grams(words, LENGTHS[0])))
                if not len(at):
                    continue
                own = [at[at + n <= len(words)] for n in LENGTHS]
                found = [grams(words, n, places) for n, places in zip(LENGTHS, own)]
                hit = [seeds().holds(g) for g in found]
                places = np.concatenate([p[h] for p, h in zip(own, hit)])
                values = np.concatenate([g[h] for g, h in zip(found, hit)]).view(np.int64)
                if not len(places):
                    continue
                order = np.argsort(places, kind="stable")
                places, values = places[order], values[order]
                for nth, (start, end) in enumerate(_merged(places, reach)):
                    low, high = np.searchsorted(places, [start, end])
                    hits = [{"gram": g, "at": a} for g, a in zip(values[low:high].tolist(), places[low:high].tolist())]
                    rows.append((key, body, start, nth == 0, words[start:end].view(np.int64), hits))
            yield pd.DataFrame(rows, columns=["key", "body", "start", "first", "words", "hits"])

    schema = f"key {dict(docs.dtypes)['key']}, body string, start long, first boolean, words array<long>, hits array<struct<gram: long, at: long>>"
    return docs.mapInPandas(run, schema)


def windows(found: DataFrame, seeds: DataFrame) -> DataFrame:
    """(body, part, size, start, window): the words around each meeting of a document and a part.

    The text that several documents have is there once.  The places at which a part would start are
    taken together by the part's length, so that a window always is three times as long.
    """
    once = found.select("body", "start", "hits").dropDuplicates(["body", "start"])
    hits = once.select("body", "start", F.explode("hits").alias("hit")).select("body", "start", "hit.gram", "hit.at")
    of_parts = seeds.select(F.col("gram").alias("_gram"), "part", "size", F.col("at").alias("_at"))
    met = join_counted(hits, of_parts, F.col("gram") == F.col("_gram"), "inner", 80)
    cell = F.floor((F.col("at") - F.col("_at")) / F.col("size"))
    met = met.select(F.col("body").alias("_body"), F.col("start").alias("_start"), "part", "size", cell.alias("cell")).distinct()
    words = found.select("body", "start", "words").dropDuplicates(["body", "start"])
    near = words.join(met, (F.col("body") == F.col("_body")) & (F.col("start") == F.col("_start")))
    begin = F.floor(F.col("cell") * F.col("size") - F.col("size") / 2) - F.col("start")
    low, high = F.greatest(begin, F.lit(0)), F.least(begin + 3 * F.col("size"), F.size("words"))
    near = near.withColumn("_low", low.cast("int")).withColumn("_high", high.cast("int")).where("_high > _low")
    window = F.slice("words", F.col("_low") + 1, F.col("_high") - F.col("_low"))
    return near.select("body", "part", "size", (F.col("start") + F.col("_low")).alias("start"), window.alias("window"))


def scores(near: DataFrame, parts: DataFrame) -> DataFrame:
    """(body, part, score, start, end) of the windows that align well enough with their part."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for body, part, start, window, own in zip(*(batch[c] for c in ("body", "part", "start", "window", "own"))):
                best = aligned(np.asarray(own), np.asarray(window))
                if best:
                    rows.append((body, part, best[0], start + best[1], start + best[2]))
            yield pd.DataFrame(rows, columns=["body", "part", "score", "start", "end"])

    words = parts.select(F.col("part").alias("_part"), F.col("words").alias("own"))
    both = join_counted(near, words, F.col("part") == F.col("_part"), "inner", F.size("own") * 8 + 64)
    both = both.select("body", "part", "start", "window", "own")
    return both.mapInPandas(run, "body string, part string, score double, start long, end long")


def text_scores(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (key, body), and (body, item, score, start, end), the best of an item's parts in each distinct text.

    ``body`` and ``item`` are digests of the texts; only documents with a possible seed are listed.
    """
    spark = benchmark.sparkSession
    small_batches(spark)
    of_items = stored(item_parts(benchmark))
    parts = stored(of_items.select("part", "words").dropDuplicates(["part"]))
    all_grams = stored(part_grams(parts))
    seeds = stored(rare_seeds(all_grams))
    starts = shipped(spark, bitmap(all_grams.where(F.col("length") == LENGTHS[0]), "gram"))
    longest = parts.agg(F.max(F.size("words"))).first()[0] or 0
    found = stored(segments(docs, starts, shipped(spark, bitmap(seeds, "gram")), longest))
    best = scores(windows(found, seeds), parts)
    items = of_items.select("item", F.col("part").alias("_part"))
    whole = join_counted(best, items, F.col("part") == F.col("_part"), "inner", 96)
    first = F.min(F.struct((-F.col("score")).alias("worst"), "start", "end")).alias("first")
    whole = whole.groupBy("body", "item").agg(first)
    whole = whole.select("body", "item", (-F.col("first.worst")).alias("score"), "first.start", "first.end")
    return found.where("first").select("key", "body"), stored(whole)


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, item_id, score, start and end of every document and item that align well enough.

    ``score`` is that of the item's best part (of equals, the first in the document), which is the whole
    item up to PART words.  ``start`` and ``end`` count words of the document.  Words are runs of
    letters, digits and underscores, without regard to case.  Null and empty texts align with nothing,
    nor do items of fewer than three words; an empty table gives an empty result.  Repeated rows give
    repeated pairs.  Other columns are not read, so none can clash.
    """
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.md5(text).alias("body"), F.col(text).alias("text"))
    members, found = text_scores(rows, benchmark)
    ids = benchmark.where("text is not null").select("item_id", F.md5("text").alias("_item"))
    found = found.withColumnRenamed("body", "_body")
    pairs = join_counted(members, found, F.col("body") == F.col("_body"), "inner", 160)
    pairs = pairs.join(ids, F.col("item") == F.col("_item"))
    return pairs.select(F.col("key").alias(key), "item_id", "score", "start", "end")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text aligns well enough with any item; the same columns.

    Rows with a null or empty text stay, all rows of a repeated text stay or go together.  An empty
    benchmark leaves all.
    """
    rows = docs.where(F.col(text).isNotNull()).select(F.lit(0).alias("key"), F.md5(text).alias("body"), F.col(text).alias("text"))
    (name,) = unused(docs, "bad_body")
    bad = stored_alone(lambda: text_scores(rows, benchmark)[1].select(F.col("body").alias(name)).distinct())
    return join_counted(docs, bad, F.md5(F.col(text)) == F.col(name), "left_anti", 48)


def op8_rare_seed_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
