"""Document fingerprints by spot signatures, in DataFrame functions alone.

Anchors are the commonest words of the corpus: those that are at least one in SHARE of all its
words, so there are SHARE at most.  The other words are content words.  Each place of an anchor
gives a signature, the anchor and the chain of CHAIN content words that follow it, and so does the
beginning of a text.  Chains at the end of a text are as long as the text allows.  The fingerprint
of a document is the set of its signatures; two are compared by the Jaccard similarity of the sets.

:func:`near_groups` finds the documents whose fingerprints are similar.  Sets whose sizes are too
far apart cannot be, so sets are partitioned by size and meet in their own partition and the next.
Of each set only as many signatures are looked up as any similar set must share one of.  In any
order that all sets agree on this loses nothing: first it is the order of the hashes; sets that meet
too many others there are looked up again by their rarest signatures, and a set too many of whose
signatures occur nowhere else is done with.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rovelog.llm.common import join_counted, stored, table
from rovelog.llm.linking import SMALL, grouped_by, only_those

#: A word is an anchor if at least one in SHARE words is this one.
SHARE = 200
#: Hashes by which words are counted first.
SLOTS = 1 << 16
#: Content words of a chain.
CHAIN = 3
#: Percent of similarity from which fingerprints are near.
SIMILAR_PERCENT = 80
#: Bytes of text of a range of documents, ranges at most (larger ranges spill), and ranges of a task.
RANGE_BYTES, MOST_RANGES, TASK_RANGES = 8 << 20, 1 << 18, 4

NO_WORD = r"[^\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits; a null text has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NO_WORD), "")


def anchors_of(docs: DataFrame) -> list[str]:
    """The words that are at least one in SHARE of all words of ``docs``: SHARE words at most.

    Words are counted by SLOTS hashes first, since a word is no commoner than its hash, and by
    themselves only where the hash is common enough.  Neither count grows with the vocabulary.
    """
    words = docs.select(F.explode(words_of(F.col("text"))).alias("word"))
    slot = F.pmod(F.xxhash64("word"), F.lit(SLOTS))
    slots = {row["slot"]: row["n"] for row in words.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(slots.values())
    common = [at for at, n in slots.items() if n * SHARE >= total]  # SHARE at most
    counts = words.where(slot.isin(common)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return sorted(row["word"] for row in counts.where(F.col("n") * SHARE >= total).collect())


def signatures(text: Column, anchors: list[str]) -> Column:
    """The sorted distinct signatures of ``text``, as 64-bit hashes.

    An anchor that is word i and has j anchors before it has i - j content words before it, which
    says where among the content words its chain begins.
    """
    is_anchor = lambda word: word.isin(anchors)

    def chain(head: Column, content: Column, start: Column) -> Column:
        return F.xxhash64(head, *[F.get(content, start + at) for at in range(CHAIN)])

    def spots(words: Column) -> Column:
        numbered = F.transform(words, lambda word, at: F.struct(word.alias("word"), at.alias("at")))
        parts = F.struct(
            F.filter(words, lambda word: ~is_anchor(word)).alias("content"),
            F.filter(numbered, lambda spot: is_anchor(spot["word"])).alias("spots"),
        )
        return F.get(F.transform(F.array(parts), both), F.lit(0))

    def both(parts: Column) -> Column:
        begin = F.array(chain(F.lit("^"), parts["content"], F.lit(0)))
        return F.concat(
            begin, F.transform(parts["spots"], lambda spot, nth: chain(spot["word"], parts["content"], spot["at"] - nth))
        )

    found = F.transform(F.array(words_of(text)), lambda words: F.when(F.size(words) > 0, spots(words)))
    return F.coalesce(F.sort_array(F.array_distinct(F.get(found, F.lit(0)))), F.array().cast("array<bigint>"))


def fingerprint(signed: Column) -> Column:
    """A set of signatures as text: hexadecimal numbers in order, joined by commas."""
    return F.array_join(F.transform(signed, lambda one: F.lpad(F.lower(F.hex(one)), 16, "0")), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets: 1 for two empty ones."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(
        shared / (F.size(a) + F.size(b) - shared)
    )


def near(a: Column, b: Column, percent: int) -> Column:
    """Is the similarity ``percent`` or more?  Sets of too different sizes are not compared."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return F.when(small * 100 < large * percent, False).otherwise(shared * 100 >= (small + large - shared) * percent)


def with_next(docs: DataFrame, notes: DataFrame) -> DataFrame:
    """doc_id, text, copies, component, kind, key, range and visitor, dealt out so that each document's next one is in its range.

    Documents go by descending doc_id, null last, then by descending hash of the text; rows that
    agree in both are one, ``copies`` their number.  Each (kind 0) is followed by its row of
    ``notes`` (doc_id, h, component), of kind 1.  Ranges are cut at every so many documents; the first
    document of each is in the range before as well, as ``visitor`` behind all others, and the first of
    all in the last range.
    """
    rows, whole = docs.select("doc_id", "text"), F.coalesce("text", F.lit(""))
    hashed = rows.select("doc_id", F.xxhash64(whole).alias("h"), F.octet_length(whole).cast("long").alias("bytes"))
    keys = stored(hashed.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("copies"), F.max("bytes").alias("bytes")))
    repeated, size = keys.agg(F.max("copies"), F.sum("bytes")).first()
    ranges = min(MOST_RANGES, max(1, math.ceil((size or 0) / RANGE_BYTES)))
    dealt = keys.repartitionByRange(ranges, F.col("doc_id").desc_nulls_last(), F.col("h").desc())
    firsts = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.max(F.struct("doc_id", "h")).alias("key"))
    bounds = [tuple(row["key"]) for row in firsts.orderBy(F.col("key").desc()).collect()]  # one a range
    if repeated and repeated > 1:
        rows = rows.groupBy("doc_id", whole.alias("text")).agg(F.count(F.lit(1)).alias("copies"))
    else:
        rows = rows.withColumn("copies", F.lit(1).cast("long"))
    told = notes.select("doc_id", F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("copies"), "h", "component", F.lit(1).alias("kind"))
    empty = lambda name: F.lit(None).cast(notes.schema[name].dataType).alias(name)
    rows = rows.select("*", empty("h"), empty("component"), F.lit(0).alias("kind")).unionByName(told)
    rows = rows.withColumn("text", whole).withColumn("key", F.struct("doc_id", F.coalesce("h", F.xxhash64("text")).alias("h")))
    kind = f"struct<doc_id:{docs.schema['doc_id'].dataType.simpleString()},h:bigint>"
    step = max(1, math.isqrt(len(bounds)))
    blocks = [bounds[at : at + step] for at in range(0, len(bounds), step)]
    said = lambda value, as_: F.from_json(F.lit(json.dumps(value)), as_)
    named = lambda key: {"doc_id": key[0], "h": key[1]}
    heads = said([named(block[0]) for block in blocks], f"array<{kind}>")
    inside = said([[named(key) for key in block] for block in blocks], f"array<array<{kind}>>")
    before = lambda some, key: F.size(F.filter(some, lambda first: first >= key))
    found = rows.withColumn("block", before(heads, F.col("key")) - 1)
    found = found.withColumn("at", before(F.get(inside, F.col("block")), F.col("key")) - 1)
    leads = (F.col("kind") == 0) & F.get(F.get(inside, F.col("block")), F.col("at")).eqNullSafe(F.col("key"))
    own = F.col("block") * step + F.col("at")
    place = lambda range_, visitor: F.struct(range_.cast("int").alias("range"), F.lit(visitor).alias("visitor"))
    places = F.when(leads, F.array(place(own, False), place(F.pmod(own - 1, F.lit(len(bounds) or 1)), True))).otherwise(F.array(place(own, False)))
    spread = found.withColumn("place", F.explode(places))
    columns = ["doc_id", "text", "copies", "component", "kind", "key", "place.range", "place.visitor"]
    return spread.select(*columns).repartition(math.ceil(max(1, len(bounds)) / TASK_RANGES), "range")


def signed(docs: DataFrame, anchors: list[str]) -> DataFrame:
    """doc_id, h (hash of the text) and ``signed``, the signatures, of every row."""
    return docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), signatures(F.col("text"), anchors).alias("signed"))


def fingerprints(docs: DataFrame, anchors: list[str], percent: int = SIMILAR_PERCENT) -> DataFrame:
    """n_chars, fingerprints of each text and of its edited text, likenesses and group, one row a row of ``docs``.

    The edited text has in place of its last half (rounded down) as many of the first characters of
    the next document by descending doc_id, or all if it is shorter; after the last comes the first.
    Documents of the same id follow each other by text hash; rows with equal id and text are one
    document there, and have equal results.  A null id comes last, a null text is empty.  A text without
    words has an empty fingerprint, which is like no other but an empty one and in a group of its own.
    ``component_id`` is the least doc_id of the documents connected by fingerprints of ``percent`` or
    more similarity (null if they have none).  Other columns are not read.  An empty table gives no rows.
    """
    notes = near_groups(signed(docs, anchors), ["doc_id", "h"], percent).dropDuplicates(["doc_id", "h"])
    order = Window.partitionBy("range").orderBy("visitor", F.col("key").desc(), "kind")
    placed = with_next(docs, notes).withColumn("signed", signatures(F.col("text"), anchors))
    following = placed.select(
        "doc_id", "text", "copies", "visitor", "kind", "signed",
        F.lead("component").over(order).alias("component_id"),
        F.lead("text", 2).over(order).alias("next"), F.lead("signed", 2).over(order).alias("next_signed"),
    ).where(~F.col("visitor") & (F.col("kind") == 0))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next", F.lit(1), half))
    changed = following.select(
        "doc_id", "copies", "component_id", F.length("text").cast("long").alias("n_chars"), "signed", "next_signed", edited.alias("edited")
    )
    compared = changed.withColumn("edited_signed", signatures(F.col("edited"), anchors)).select(
        "doc_id", "copies", "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("signed")).alias("fingerprint"),
        fingerprint(F.col("edited_signed")).alias("edited_fingerprint"),
        likeness(F.col("signed"), F.col("edited_signed")).alias("near_edited"),
        likeness(F.col("signed"), F.col("next_signed")).alias("near_next"),
        F.size("signed").alias("n_signatures"),
        "component_id",
    )
    return compared.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")


def size_part(size: Column, percent: int) -> Column:
    """Partition of a set by its size.  Sets that can be similar are in the same or in neighbouring ones."""
    return F.floor(F.log(size.cast("double")) / -math.log(percent / 100) + 1e-9).cast("int")


def looked_up(sets: DataFrame, prefix: Column, before: Column, percent: int) -> DataFrame:
    """(bucket, id, size, place, own): each signature of ``prefix``, with the set's ``own`` partition and with the one before.

    ``place`` is that of the signature in the order of the set, where ``before`` others come before the prefix.
    """
    part = size_part(F.col("size"), percent)
    rows = sets.select("id", "size", before.alias("before"), part.alias("its"), F.explode(F.array(part, part - 1)).alias("part"), prefix.alias("prefix"))
    spots = rows.select("id", "size", "before", "its", "part", F.posexplode("prefix").alias("at", "one"))
    return spots.select(F.xxhash64("part", "one").alias("bucket"), "id", "size", (F.col("before") + F.col("at")).alias("place"), (F.col("its") == F.col("part")).alias("own"))


def possible(percent: int) -> Callable[[str, str], Column]:
    """Whether two sets can be similar if the signature of their bucket is the first, in the order, that both have.

    Two of the same partition are left to the bucket of that one.
    """
    return lambda x, y: F.expr(
        f"({x}.own or {y}.own) and least({x}.size, {y}.size) * 100 >= greatest({x}.size, {y}.size) * {percent} and "
        f"least({x}.size - {x}.place, {y}.size - {y}.place) * {100 + percent} >= ({x}.size + {y}.size) * {percent}"
    )


def near_groups(sets: DataFrame, by: list[str], percent: int = SIMILAR_PERCENT) -> DataFrame:
    """``by`` and ``component``, the least ``by[0]`` of the sets connected by similarity of ``percent`` or more.

    ``sets`` has ``by`` and ``signed``; those without signatures are similar to nothing.  Equal sets are one.
    """
    sets = sets.withColumn("class", F.when(F.size("signed") > 0, F.xxhash64("signed")))
    named = sets.where(F.col("class").isNotNull())
    classes = stored(named.groupBy(F.col("class").alias("id")).agg(F.first("signed").alias("signed")).withColumn("size", F.size("signed")))
    need = F.ceil(F.col("size") * percent / 100).cast("int")  # signatures that a similar set shares
    keys = stored(looked_up(classes, F.slice("signed", F.lit(1), F.col("size") - need + 1), F.lit(0), percent))
    crowded = stored(keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SMALL).select("bucket"))
    members = keys
    if not crowded.isEmpty():
        met = stored(keys.join(crowded, "bucket").select(F.col("id").alias("again")).distinct())
        again = join_counted(classes, met, F.col("id") == F.col("again"), "left_semi", 16)
        spots = again.select("id", "size", F.explode("signed").alias("one"))
        common = spots.groupBy("one").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        shared = spots.join(common, "one").groupBy("id", "size").agg(F.sort_array(F.collect_list(F.struct("n", "one"))).alias("some"))
        # The signatures of no other set would come first in this order.
        rest = F.greatest(F.size("some") - need + 1, F.lit(0))
        rarest = F.transform(F.slice("some", F.lit(1), rest), lambda spot: spot["one"])
        alone = F.col("size") - F.size("some")
        members = keys.join(crowded, "bucket", "left_anti").union(looked_up(shared, rarest, alone, percent))

    def confirm(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs)
        some = only_those(classes.select("id", "signed"), pairs)
        a = some.select(F.col("id").alias("a"), F.col("signed").alias("x"))
        b = some.select(F.col("id").alias("b"), F.col("signed").alias("y"))
        return pairs.join(a, "a").join(b, "b").where(near(F.col("x"), F.col("y"), percent)).select(pairs.columns)

    groups = grouped_by(stored(members), confirm, possible(percent))
    of_set = sets.select(*by, "class").join(groups.select(F.col("node").alias("class"), "component"), "class", "left")
    grouped = stored(of_set.select(*by, F.coalesce("component", "class").alias("group")))
    first = grouped.where("group is not null").groupBy("group").agg(F.min(by[0]).alias("component"))
    return grouped.join(first, "group", "left").select(*by, F.when(F.col("group").isNull(), F.col(by[0])).otherwise(F.col("component")).alias("component"))


def op11_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return fingerprints(docs, anchors_of(docs))
