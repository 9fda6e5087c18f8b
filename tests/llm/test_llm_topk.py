from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerloom.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, shard string, rank int"


def usable(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def brute(rows, k):
    vectors = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v, *_ in rows if i is not None and usable(v)]
    out = set()
    for i, q in {(i, tuple(v)) for i, v in vectors if i % 10 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in vectors if j != i and len(v) == len(q))
        out |= {(i, n, j, -s) for n, (s, j) in enumerate(scores[:k], 1)}
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    made = [(i, [float(np.float32(x)) for x in rng.normal(size=5)], "s", i) for i in range(300)]
    made += [(i, made[3][1], "s", i) for i in range(300, 340)]  # ties
    made += [(400, None, "s", 1), (410, [1.0, None, 1.0, 1.0, 1.0], "s", 1), (420, [math.nan] * 5, "s", 1)]
    made += [(430, [math.inf] * 5, "s", 1), (None, [1.0] * 5, "s", 1), (440, [3.0, 4.0], "s", 1), (441, [1.0, -1.0], "s", 1)]
    made += [(450, [], "s", 1), (10, made[10][1], "s", 1), (460, [float(np.float32(1e12))] * 5, "s", 1)]
    return made


@pytest.mark.parametrize("options", [{}, {"shard_rows": 40, "block_queries": 5, "leaf_rows": 3}])
def test_equals_brute_force(spark, rows, options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = topk.nearest(df, F.col("vec_id") % 10 == 0, k=7, **options).collect()
    clip = lambda s: max(min(s, 2**63 - 1), -(2**63))
    assert {tuple(r) for r in found} == {(q, n, j, clip(s)) for q, n, j, s in brute(rows, 7)}


def test_empty_table_and_fewer_than_k(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert topk.nearest(df, F.col("vec_id") % 10 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0], "a", 1), (1, [2.0], "a", 1)], SCHEMA)
    assert [tuple(r) for r in topk.nearest(two, F.col("vec_id") % 10 == 0).collect()] == [(0, 1, 1, 1024 * 2048)]


def test_a_floor_prunes_and_loses_nothing():
    rng = np.random.default_rng(1)
    data, query = rng.integers(-99, 99, (500, 4)), rng.integers(-99, 99, 4)
    tree = topk.Tree(data, np.arange(500), 8)
    free = tree.search(query, -1, 10, None)
    assert free == sorted(((int(r @ query), i) for i, r in enumerate(data)), key=lambda e: (-e[0], e[1]))[:10]
    assert tree.search(query, -1, 10, free[-1][0]) == free


def test_trees_are_built_once_and_vectors_not_repeated(spark, rows, monkeypatch):
    """What the searches read is the stored trees: they build none, and no vector is shuffled."""
    df = spark.createDataFrame(rows, SCHEMA)
    stored = {}
    settle = topk.settled
    monkeypatch.setattr(topk, "settled", lambda rows, name: stored.setdefault(name, settle(rows, name)))
    found = topk.nearest(df, F.col("vec_id") % 10 == 0, shard_rows=40, block_queries=5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroups" not in plan and plan.count("MapInArrow") == 1
    shards = stored["dealt_vectors"].select("shard").distinct().count()
    assert stored["trees"].count() == shards > 5
    assert found.count() > 0
