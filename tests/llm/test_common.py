from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rovelog.llm import common


def grouped(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_union_find(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(220)]
    links += [(1000, 1000 + i) for i in range(1, 60)] + [(2000 + i, 2001 + i) for i in range(40)]  # a star and a chain
    found = common.components(spark.createDataFrame(links, "a long, b long"))
    expected = grouped([x for x in links if x[0] != x[1]])
    assert {r["node"]: r["component"] for r in found.collect()} == expected


def test_components_of_nothing(spark):
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ranked_is_gapless_and_in_cell_order(spark):
    rows = [(i % 5 if i % 7 else 0, i) for i in range(500)] + [(None, 9)]
    found = common.ranked(spark.createDataFrame(rows, "c int, v long"), "c", [F.col("v")], "r", spread=8).collect()
    assert sorted(r["r"] for r in found) == list(range(len(rows)))
    assert {r["r_of"] for r in found} == {len(rows)}
    cells = [r["c"] if r["c"] is not None else -1 for r in sorted(found, key=lambda r: r["r"])]
    assert cells == sorted(cells)


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())


def test_join_counted_gives_the_same_beyond_the_bound(spark, monkeypatch):
    large = spark.range(100)
    small = common.stored(spark.range(0, 200, 3).withColumnRenamed("id", "x"))
    near = common.join_counted(large, small, F.col("id") == F.col("x"), "left_semi", 8)
    assert "BroadcastHashJoin" in near._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    far = common.join_counted(large, small, F.col("id") == F.col("x"), "left_semi", 8)
    assert sorted(near.collect()) == sorted(far.collect())
