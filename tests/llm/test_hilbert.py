from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from rovelog.llm import hilbert as H


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (3, 4), (2, 1)])
def test_the_curve_visits_each_cell_and_steps_to_a_neighbour(spark, dims, bits):
    side = 1 << bits
    grid = spark.range(side**dims).select(*[(F.floor(F.col("id") / side**i) % side).alias(f"d{i}") for i in range(dims)])
    levels = [F.col(f"d{i}") for i in range(dims)]
    rows = sorted(grid.withColumn("h", H.hilbert_index(levels, bits)).collect(), key=lambda r: r["h"])
    assert [r["h"] for r in rows] == list(range(side**dims))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[f"d{i}"] - b[f"d{i}"]) for i in range(dims)) == 1


def test_every_row_has_a_slot_and_counts_differ_by_one_at_most(spark):
    rows = [(i, "t" * (i * i % 700), f"l{i % 3}", "hot" if i % 3 else f"s{i}", "x") for i in range(203)]
    rows += [(7, "t" * 49, "l1", "s7", "x"), (None, None, None, None, None), (900, "é", None, "", ""), (901, "z" * 200_000, "l1", "s", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard string")
    found = H.shard_documents(docs).collect()
    assert len(found) == len(rows) and {r["law"] for r in found} == {"rows"} and {r["grown_shard"] for r in found} == {None}
    slots = {s: sorted(r["slot"] for r in found if r["shard"] == s) for s in range(H.SHARDS)}
    assert all(v == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    sizes = {(r["doc_id"], r["size"], r["text_crc32"]) for r in found}
    assert sizes == {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows}


@pytest.mark.parametrize("n", [0, 1, 5, 8, 9])
def test_few_rows(spark, n):
    docs = spark.createDataFrame([(i, "a", "l", "s") for i in range(n)], "doc_id long, text string, lang string, source string")
    found = H.shard_documents(docs).collect()
    assert len(found) == n and len({(r["shard"], r["slot"]) for r in found}) == n
    assert all(0 <= r["shard"] < 8 for r in found)


def test_a_filter_on_a_dimension_leaves_out_shards(spark):
    rows = [(i, "t" * (1 + i % 900), f"lang{i % 5}", f"src{i % 11}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = H.shard_documents(docs).join(docs.select("doc_id", "lang"), "doc_id")
    touched = [r["n"] for r in found.groupBy("lang").agg(F.countDistinct("shard").alias("n")).collect()]
    assert sum(touched) / len(touched) <= 5


def test_no_python_and_no_cross_join_in_the_plan(spark):
    plan = H.op3_hilbert_shards(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
