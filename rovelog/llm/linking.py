"""Links between members of buckets, found without all pairs of a large bucket.

Candidates for a link share a bucket.  Only connected groups are wanted, so a pair whose two
members are already in one group needs no comparison:

1. members of a small bucket are compared with each other;
2. members of a large one are compared with a few pivots, the same in every bucket that holds them;
3. groups are formed; large buckets whose members are not all in one group are looked at again.
   Where no group has half of a bucket, the caller may split it further (``deepen``).
4. What is left is compared exactly: the members outside a bucket's largest group with the members
   of all other groups.  Buckets with the same largest group are one, so that a pair which shares
   many buckets is compared once.  A caller that can compare blocks of members in a task
   (``compare``) writes no pairs for this.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rovelog.llm.common import components, dropped, join_counted, stored, stored_alone

#: Members up to which a bucket is small.
SMALL = 24
#: Pivots of a large bucket.
PIVOTS = 8
#: Rounds of :func:`grouped_by` at most, and pairs of a round for each of which one must be a link if there is to be another.
MOST_ROUNDS, PAYING = 12, 24
#: Members of a bucket for each pivot from which its outsiders meet pivots.
WORTH = 8


def sized(members: DataFrame) -> DataFrame:
    """``members`` (bucket, id) of buckets with at least two, and the bucket's size ``n``."""
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return members.join(sizes, "bucket")


def pairs_within(members: DataFrame) -> DataFrame:
    """(a, b), a < b, of members that share a bucket; the caller bounds the buckets."""
    other = members.select("bucket", F.col("id").alias("b"))
    return members.select("bucket", F.col("id").alias("a")).join(other, "bucket").where("a < b").select("a", "b")


def pairs_between(grouped: DataFrame) -> DataFrame:
    """As :func:`pairs_within`, of members that are not in one ``group`` already."""
    other = grouped.select("bucket", F.col("id").alias("b"), F.col("group").alias("g"))
    pairs = grouped.select("bucket", F.col("id").alias("a"), "group").join(other, "bucket")
    return pairs.where("a < b and group <> g").select("a", "b")


def pairs_with_pivots(members: DataFrame, pivots: int = PIVOTS, *, only: DataFrame | None = None) -> DataFrame:
    """(a, b) of each member with up to ``pivots`` members of its bucket, and of other groups if ``members`` has ``group``.

    Members are dealt to ``pivots`` parts by hash and the least of each part, by ``rank`` first if there is one, is a pivot, so the
    buckets of one group agree on their pivots.  A member meets the pivots of a bucket in one row, and
    a pivot that several of its buckets share once.  The caller bounds the buckets of an id.  With ``only`` (bucket, id)
    the other members are pivots at most.
    """
    part = F.pmod(F.xxhash64("id"), F.lit(pivots))
    group = ["group"] if "group" in members.columns else []
    rank = ["rank"] if "rank" in members.columns else []
    least = members.groupBy("bucket", part.alias("part")).agg(F.min(F.struct(*rank, "id", *group)).alias("least"))
    chosen = least.groupBy("bucket").agg(F.sort_array(F.collect_list("least")).alias("drawn"))  # ``pivots`` at most
    asked = members if only is None else members.join(only, ["bucket", "id"], "left_semi")
    drawn = asked.join(chosen, "bucket").groupBy("id", *group).agg(F.array_distinct(F.flatten(F.collect_set("drawn"))).alias("drawn"))
    met = drawn.select("id", *group, F.explode("drawn").alias("pivot"))
    return met.where(" and ".join(["id <> pivot.id", *["group <> pivot.group" for _ in group]])).select(
        F.least("id", "pivot.id").alias("a"), F.greatest("id", "pivot.id").alias("b")
    )


def with_group(members: DataFrame, groups: DataFrame) -> DataFrame:
    """``members`` with ``group``: the component of the id, or the id itself."""
    known = members.join(groups.select(F.col("node").alias("id"), "component"), "id", "left")
    return known.withColumn("group", F.coalesce("component", "id")).drop("component")


def with_group_once(members: DataFrame, groups: DataFrame) -> DataFrame:
    """As :func:`with_group`, for ids in many buckets: the join takes one row an id, which carries its buckets.

    The caller bounds the number of buckets an id is in.
    """
    each = members.groupBy("id").agg(F.collect_list("bucket").alias("buckets"))
    return with_group(each, groups).select(F.explode("buckets").alias("bucket"), "id", "group")


def divided(grouped: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one group, with ``held``, the bucket's size."""
    seen = grouped.groupBy("bucket").agg(F.min("group").alias("lo"), F.max("group").alias("hi"), F.count(F.lit(1)).alias("held"))
    return grouped.join(seen.where("lo <> hi").select("bucket", "held"), "bucket")


def with_main(grouped: DataFrame) -> DataFrame:
    """``grouped`` with ``main``, the largest group of the bucket, and ``ruled``: it has half of the bucket."""
    of_group = grouped.groupBy("bucket", "group").agg(F.count(F.lit(1)).alias("_n"))
    largest = of_group.groupBy("bucket").agg(
        F.max(F.struct("_n", "group")).alias("_top"), F.sum("_n").alias("_all")
    )
    named = largest.select("bucket", F.col("_top.group").alias("main"), (F.col("_top._n") * 2 >= F.col("_all")).alias("ruled"))
    return grouped.join(named, "bucket")


def merged(mixed: DataFrame) -> DataFrame:
    """(bucket, id, group, minor): buckets that have the same main group made one, named by it."""
    return mixed.select(F.col("main").alias("bucket"), "id", "group", (F.col("group") != F.col("main")).alias("minor")).distinct()


def pairs_across(rows: DataFrame) -> DataFrame:
    """(a, b) that share a bucket but no group, of which one at least is minor."""
    minor = rows.where("minor").select("bucket", F.col("id").alias("x"), F.col("group").alias("g"))
    return (
        minor.join(rows, "bucket")
        .where("group <> g")
        .select(F.least("id", "x").alias("a"), F.greatest("id", "x").alias("b"))
    )


def linked_groups(
    members: DataFrame,
    confirm: Callable[[DataFrame], DataFrame],
    deepen: Callable[[DataFrame], DataFrame] | None = None,
    compare: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(node, component) of all ids that are linked to another.

    ``members`` (bucket, id) is stored; the caller bounds the buckets of an id.  ``confirm`` takes candidate pairs (a, b) and returns those
    that are links.  ``deepen`` takes (bucket, id, group) of large buckets and returns smaller buckets in the same
    columns: many rows for each it takes, of which only those in buckets of several groups are joined to anything.
    ``compare`` takes (bucket, id, group, minor) and returns links (a, b) that connect what the links
    between minor members and members of other groups connect.
    """
    compare = compare or (lambda rows: confirm(pairs_across(rows).distinct()))
    members = stored(sized(members))
    large = members.where(F.col("n") > SMALL).select("bucket", "id")
    first = pairs_within(members.where(F.col("n") <= SMALL)).union(pairs_with_pivots(large))
    groups = stored(components(stored(confirm(first.distinct()))))
    mixed = stored(with_main(divided(with_group_once(large, groups))))
    if mixed.isEmpty():
        return groups
    if deepen:
        split = stored(divided(deepen(mixed.where("not ruled").select("bucket", "id", "group"))))
        few, many = split.where(F.col("held") <= SMALL), split.where(F.col("held") > SMALL).select("bucket", "id", "group")
        met = pairs_between(few).union(pairs_with_pivots(many))
        groups = joined_groups(groups, confirm(met.distinct()))
        left = mixed.where("ruled").select("bucket", "id").union(many.select("bucket", "id"))
        mixed = stored(with_main(divided(with_group_once(left, groups))))
    return joined_groups(groups, compare(merged(mixed)))


def joined_groups(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` after some of them are joined by further links (a, b)."""
    links = stored(links)
    if links.isEmpty():
        return groups
    known = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return stored_alone(lambda: components(known.union(links.select("a", "b"))))


def only_those(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The ``rows`` (id, ...) whose id is in ``pairs`` (a, b), both stored: few ids spare a shuffle of all rows."""
    asked = stored(pairs.select(F.col("a").alias("_asked")).distinct().union(pairs.select("b").distinct()).distinct())
    return join_counted(rows, asked, F.col("id") == F.col("_asked"), "left_semi", 40)


def grouped_by(
    members: DataFrame,
    confirm: Callable[[DataFrame], DataFrame],
    possible: Callable[[str, str], Column],
    told: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(node, component) of the ids that are linked to another.

    ``members`` (bucket, id, and what ``possible`` needs) are candidates for each other in their
    buckets; ``confirm`` returns the links among pairs (a, b), with the pairs' other columns.  A bucket whose members are all in one group
    is done with.  In a round every bucket draws one member, the same wherever it can
    be, and each other member is compared to the one drawn by the smallest of its buckets.  That joins most of what belongs
    together with one pair a member.  There are more rounds while one pair in PAYING is a link, then the turns of
    :func:`with_outsiders`.  At last the members outside the largest group of a bucket are compared with all members of
    other groups, where ``possible``, given the names of two rows of a bucket, does not rule it out.  Of the links found between two groups one is kept.
    ``told`` adds to the rows of what is left what else ``possible`` needs.
    """
    groups, open_ = members.select(F.col("id").alias("node"), F.col("id").alias("component")).limit(0), members
    for turn in range(MOST_ROUNDS):
        open_ = stored(divided(with_group(open_.select("bucket", "id"), groups)))
        if open_.isEmpty():
            return groups
        drawn = open_.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), "id", "group")).alias("drawn"))
        met = open_.join(drawn, "bucket").where(F.col("group") != F.col("drawn.group")).groupBy("id").agg(F.min(F.struct("held", "drawn"))["drawn"].alias("drawn"))
        pairs = stored(met.select(F.col("drawn.id").alias("a"), F.col("id").alias("b")))
        links = stored(confirm(pairs))
        groups = joined_groups(groups, links)
        if links.count() * PAYING < pairs.count():
            break
    groups = with_outsiders(open_.select("bucket", "id"), groups, confirm)
    open_ = with_main(divided(with_group(members, groups))).drop("held", "ruled")
    open_ = stored(told(stored(open_)) if told else open_)
    x, y = open_.where("group <> main").alias("x"), open_.alias("y")
    once = "x.bucket = y.bucket and x.group <> y.group and (y.group = y.main or x.id < y.id)"
    pairs = x.join(y, F.expr(once) & possible("x", "y")).select(
        F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"),
        F.least("x.group", "y.group").alias("g"), F.greatest("x.group", "y.group").alias("h"),
    )
    links = confirm(pairs.distinct())
    return joined_groups(groups, links.select(F.col("g").alias("a"), F.col("h").alias("b")).distinct())


def with_outsiders(members: DataFrame, groups: DataFrame, confirm: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``groups`` after the members of large buckets have met those of their bucket that have most links.

    A member outside the largest group of its bucket, an outsider, is to meet all others of the bucket at last, so one link spares as many
    pairs as the bucket has members.  First each member meets PIVOTS of its largest bucket, which tells who
    has many links.  Then outsiders meet as many of those that have most.  Buckets with fewer than WORTH times as many members as pivots
    are left alone, and all are if outsiders have no more pairs left than ``members`` (bucket, id) has rows.
    """
    few, known = members.count(), None
    for _ in range(2):
        rows = stored(with_main(divided(with_group(members, groups)).where(F.col("held") >= WORTH * PIVOTS)))
        outside = rows.where("group <> main")
        if (outside.agg(F.sum("held")).first()[0] or 0) <= few:
            return groups
        if known is None:
            pairs = pairs_with_pivots(rows.select("bucket", "id"), only=largest_bucket(rows))
        else:
            ends = known.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg((-F.count(F.lit(1))).alias("rank"))
            ranked = rows.select("bucket", "id", "group").join(ends, "id", "left").withColumn("rank", F.coalesce("rank", F.lit(0)))
            pairs = pairs_with_pivots(ranked, only=largest_bucket(outside))
        known = stored(confirm(pairs.distinct()))
        groups = joined_groups(groups, known)
        dropped(rows)
    return groups


def largest_bucket(rows: DataFrame) -> DataFrame:
    """(id, bucket): of the buckets of an id the one that has ``held`` most."""
    return rows.groupBy("id").agg(F.max(F.struct("held", "bucket"))["bucket"].alias("bucket"))
