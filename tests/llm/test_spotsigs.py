from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from rovelog.llm import linking
from rovelog.llm import spotsigs as S
from tests.llm.test_common import grouped

SCHEMA = "doc_id long, text string, range string, key int, signed string"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def chains(text, anchors):
    """The signatures as tuples."""
    own = words(text)
    content = lambda at: tuple([w for w in own[at:] if w not in anchors][: S.CHAIN])
    return {("^", *content(0))} | {(w, *content(at)) for at, w in enumerate(own) if w in anchors} if own else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def hashes(spark, sets):
    """The set of hashes for each set of tuples."""
    every = sorted({c for s in sets for c in s})
    if not every:
        return [set() for _ in sets]
    frame = spark.createDataFrame([(i, *c, *[None] * (S.CHAIN + 1 - len(c))) for i, c in enumerate(every)], "i int, " + ", ".join(f"w{k} string" for k in range(S.CHAIN + 1)))
    of = {every[r["i"]]: r["h"] for r in frame.select("i", F.xxhash64(*[f"w{k}" for k in range(S.CHAIN + 1)]).alias("h")).collect()}
    return [{of[c] for c in s} for s in sets]


def said(some):
    return ",".join(f"{h % (1 << 64):016x}" for h in sorted(some))


def sample(seed, n):
    draw = random.Random(seed)
    common, rare = ["the", "of", "und", "la"], [f"w{i}" for i in range(60)]
    text = lambda k: " ".join(draw.choice(common) if draw.random() < 0.3 else draw.choice(rare) for _ in range(k))
    return [(i * 3 - 40, draw.choice([text(draw.randrange(0, 60)), text(9).upper() + "!\n" + text(3), "", None, "…?", "ünï 漢字 the"]), "r", 1, "s") for i in range(n)]


def plain(spark, rows, anchors):
    version = {r["t"]: r["v"] for r in spark.createDataFrame([(r[1] or "",) for r in rows], "t string").select("t", F.xxhash64("t").alias("v")).collect()}
    key = lambda r: (r[0] is not None, r[0] or 0, version[r[1] or ""])
    order = sorted({(key(r), r[0], r[1] or "") for r in rows}, key=lambda x: x[0], reverse=True)
    following = {(name, text): order[(at + 1) % len(order)][2] for at, (_, name, text) in enumerate(order)}
    sets = {(name, text): chains(text, anchors) for _, name, text in order}
    near = lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= S.SIMILAR_PERCENT * len(sets[a] | sets[b])
    names = list(sets)
    of = grouped([(a, b) for a in range(len(names)) for b in range(a) if near(names[a], names[b])])
    least = {}
    for at, (name, _) in enumerate(names):
        if name is not None:
            least[of.get(at, at)] = min(name, least.get(of.get(at, at), name))
    out = []
    for name, text, *_ in rows:
        text = text or ""
        half, nxt = len(text) // 2, following[name, text]
        edited = text[: len(text) - half] + nxt[:half]
        own, new, other = (chains(t, anchors) for t in (text, edited, nxt))
        a, b = hashes(spark, [own, new])
        out.append((name, len(text), hashlib.sha256(edited.encode()).hexdigest(), said(a), said(b), jaccard(own, new), jaccard(own, other), len(own), least.get(of.get(names.index((name, text)), names.index((name, text))))))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.mark.parametrize("bytes_, repeats", [(1 << 25, False), (500, False), (500, True), (1, True)])
def test_equals_plain_python(spark, monkeypatch, bytes_, repeats):
    monkeypatch.setattr(S, "RANGE_BYTES", bytes_)
    rows = sample(bytes_, 40)
    if repeats:
        rows += [rows[5]] * 3 + [(None, "the null id of", "r", 1, "s"), (None, "the other of la", "r", 1, "s"), (8, "the same id", "r", 1, "s"), (8, "of it", "r", 1, "s")]
    anchors = ["the", "of", "und", "la"]
    found = S.fingerprints(spark.createDataFrame(rows, SCHEMA), anchors)
    assert ordered(found.collect()) == ordered(plain(spark, rows, anchors))


def test_one_document_follows_itself(spark):
    docs = spark.createDataFrame([(1, "abcdefg", "r", 1, "s")], SCHEMA)
    row = S.fingerprints(docs, []).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdabc").hexdigest() and row["near_next"] == 1.0


def test_anchors_are_the_words_of_that_share(spark):
    rows = [(1, "the the of " + " ".join(f"w{i}" for i in range(397)), "", 1, ""), (2, None, "", 1, ""), (3, "?", "", 1, "")]
    assert S.anchors_of(spark.createDataFrame(rows, SCHEMA)) == ["the"]
    assert S.anchors_of(spark.createDataFrame([], SCHEMA)) == []


@pytest.mark.parametrize("small", [24, 3])
def test_groups_equal_comparing_all_pairs(spark, monkeypatch, small):
    monkeypatch.setattr(linking, "SMALL", small)
    monkeypatch.setattr(S, "SMALL", small)
    draw = random.Random(small)
    shared = [draw.randrange(1 << 40) for _ in range(12)]
    sets = [sorted({*shared[: draw.randrange(13)], *[draw.randrange(1 << 40) for _ in range(draw.randrange(0, 8))]}) for _ in range(60)]
    for base in range(20):
        for _ in range(4):
            some = list(sets[base])
            if some:
                some[draw.randrange(len(some))] = draw.randrange(1 << 40)
            sets.append(sorted(set(some)))
    sets += [sets[0], sets[0], [], []]
    near = lambda a, b: a and b and 100 * len({*a} & {*b}) >= S.SIMILAR_PERCENT * len({*a} | {*b})
    of = grouped([(a, b) for a in range(len(sets)) for b in range(a) if near(sets[a], sets[b])])
    found = S.near_groups(spark.createDataFrame(list(enumerate(sets)), "id long, signed array<long>"), ["id"])
    assert sorted(map(tuple, found.collect())) == [(i, of.get(i, i)) for i in range(len(sets))]


def test_no_documents_and_no_python(spark):
    assert S.fingerprints(spark.createDataFrame([], SCHEMA), ["the"]).count() == 0
    plan = S.op11_spot_signatures(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
