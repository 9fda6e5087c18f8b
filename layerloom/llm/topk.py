"""Exact top-k search by inner product: a KD-tree per shard.

Vectors are dealt over shards of bounded size. Each shard builds a KD-tree by median
splits, with the tight bounding box of each node. For a query ``q`` no vector of a box can
score above ``sum(max(q * low, q * high))``, so the nodes are visited best bound first, and
a visit ends as soon as no bound reaches the k-th best score found. That k-th score is
propagated: every query is first searched in one home shard, and all other shards start
from the score it found there.

Each tree is built once and stored. A task loads one and lets a block of queries stream past
it, a few at a time, so it holds a tree of bounded size and no more. A block is large, as it
is there for more tasks than shards and not for memory: a stored tree is read once per block,
and a query goes once to every shard. No pair of vectors is ever a row.

Defined cases: components are taken as integers, ``floor(scale * x)``. Vectors that are
null, or hold a null or a non-finite component, take no part; neither do rows with a null
id. Only vectors of equal length are compared. A repeated candidate row is a candidate
each time; a repeated query row is one query. Scores beyond 64 bits are cut to 64 bits. An empty
table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerloom.llm.common import settled

SHARD_ROWS = 1 << 14
BLOCK_QUERIES = 1 << 16
LEAF_ROWS = 256

_LONG = np.iinfo(np.int64)
#: Below this, sums of products are exact in 64 bits, also when NumPy adds them as floats.
_EXACT = float(1 << 53)
_NEAR = "query_id bigint, query_key bigint, vec_id bigint, score bigint"


class Tree:
    """Median splits along the widest side; a node keeps its rows' range and tight box."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.order = np.arange(len(rows))
        self.leaf_rows = leaf_rows
        self.rows = rows
        self.nodes: list[tuple[int, int, int, int]] = []
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self._split(0, len(rows))
        self.rows, self.ids = rows[self.order], ids[self.order]
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.largest = max(_largest(self.low), _largest(self.high))

    def _split(self, start: int, end: int) -> int:
        own = self.rows[self.order[start:end]]
        low, high = own.min(axis=0), own.max(axis=0)
        number = len(self.nodes)
        self.nodes.append((start, end, -1, -1))
        self.low.append(low)
        self.high.append(high)
        if end - start > self.leaf_rows and own.shape[1] and (low != high).any():
            middle = (end - start) // 2
            # As float: the side only guides the split, and integer ends could overflow.
            axis = int(np.argmax(high.astype(float) - low.astype(float)))
            ranks = np.argpartition(own[:, axis], middle)
            self.order[start:end] = self.order[start:end][ranks]
            left = self._split(start, start + middle)
            right = self._split(start + middle, end)
            self.nodes[number] = (start, end, left, right)
        return number

    def search(self, query: np.ndarray, query_id: int, k: int, floor: int | None) -> list[tuple[int, int]]:
        """The best (score, id) of the other rows, none below ``floor``, best first."""
        rows, low, high = self.rows, self.low, self.high
        if self.largest * _largest(query) * max(1, query.size) >= _EXACT:
            rows, low, high, query = (x.astype(object) for x in (rows, low, high, query))
        bounds = np.maximum(low * query, high * query).sum(axis=1)
        found: list[tuple[int, int]] = []  # a heap: the worst of the best is at 0
        waiting = [(-int(bounds[0]), 0)]
        while waiting:
            bound, number = heapq.heappop(waiting)
            least = found[0][0] if len(found) == k else floor
            if least is not None and -bound < least:
                break
            start, end, left, right = self.nodes[number]
            if left >= 0:
                heapq.heappush(waiting, (-int(bounds[left]), left))
                heapq.heappush(waiting, (-int(bounds[right]), right))
                continue
            scores = rows[start:end] @ query
            ids = self.ids[start:end]
            use = np.flatnonzero((ids != query_id) & ((scores >= least) if least is not None else True))
            if len(use) > k:  # the k best of this leaf; ties at the end are all looked at
                edge = np.partition(scores[use], len(use) - k)[len(use) - k]
                use = use[scores[use] >= edge]
            for i in use:
                entry = (int(scores[i]), -int(ids[i]))
                if len(found) < k:
                    heapq.heappush(found, entry)
                elif entry > found[0]:
                    heapq.heapreplace(found, entry)
        return [(score, -negative) for score, negative in sorted(found, reverse=True)]


def _largest(values: np.ndarray) -> float:
    return float(np.abs(values.astype(float)).max()) if values.size else 0.0


def usable(vector: Column) -> Column:
    """Whether a vector takes part: no null or non-finite component."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def whole(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("bigint"))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best others, ties to smaller ids."""
    rows = vectors.filter(usable(F.col(vector)) & F.col(vec_id).isNotNull())
    rows = rows.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        whole(F.col(vector), scale).alias("vector"),
        is_query.alias("is_query"),
    )
    sizes = rows.agg(F.count("*").alias("rows"), F.count_if("is_query").alias("queries")).first()
    shards = max(1, math.ceil(sizes["rows"] / shard_rows))
    blocks = max(1, math.ceil(sizes["queries"] / block_queries))
    # rand() with a seed follows the place of a row in its file, so equal ids spread too.
    dealt = settled(
        rows.withColumn("shard", F.floor(F.rand(11) * shards).cast("int")), "dealt_vectors"
    )
    queries = (
        dealt.filter("is_query")
        .select(
            F.col("vec_id").alias("query_id"), F.xxhash64("vector").alias("query_key"), "vector"
        )
        .dropDuplicates(["query_id", "query_key"])
    )
    queries = queries.withColumns(
        {
            "block": F.pmod(F.col("query_key"), F.lit(blocks)).cast("int"),
            "home": F.pmod(F.xxhash64("query_id", "query_key"), F.lit(shards)).cast("int"),
        }
    )
    queries = settled(queries, "queries")
    trees = settled(_trees(dealt.select("vec_id", "vector", "shard"), leaf_rows), "trees")

    no_floor = F.lit(None).cast("bigint").alias("least")
    at_home = queries.select("*", F.col("home").alias("shard"), no_floor)
    first = settled(_searched(trees, at_home, blocks, k), "home_scores")
    own = ["query_id", "query_key"]
    kth = first.groupBy(*own).agg(F.min("score").alias("least"), F.count("*").alias("found"))
    kth = kth.select(*own, F.when(F.col("found") >= k, F.col("least")).alias("least"))
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("home"))
    away = queries.join(settled(kth, "kth_scores"), own, "left").select(
        "*", F.explode(others).alias("shard")
    )
    rest = _searched(trees, away, blocks, k)
    best_first = Window.partitionBy(*own).orderBy(F.desc("score"), "vec_id")
    return (
        first.unionByName(rest)
        .withColumn("rank", F.row_number().over(best_first))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _trees(dealt: DataFrame, leaf_rows: int) -> DataFrame:
    """``shard, trees``: each shard's trees, one per length of its vectors."""

    def built(shard: pa.Table) -> pa.Table:
        lengths = pc.list_value_length(shard["vector"])
        trees = {}
        for length in pc.unique(lengths).to_pylist():
            rows = shard.filter(pc.equal(lengths, length))
            values = rows["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            matrix = values.astype(np.int64).reshape(rows.num_rows, length)
            trees[length] = Tree(matrix, rows["vec_id"].to_numpy().copy(), leaf_rows)
        return pa.table({"shard": shard["shard"][:1], "trees": pa.array([pickle.dumps(trees)], pa.binary())})

    return dealt.groupBy("shard").applyInArrow(built, "shard int, trees binary")


def _searched(trees: DataFrame, queries: DataFrame, blocks: int, k: int) -> DataFrame:
    """The hits of each query in the shard beside it: every tree goes before its queries."""
    none = F.lit(None)
    blocked = trees.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "trees",
        none.cast("bigint").alias("query_id"), none.cast("bigint").alias("query_key"),
        none.cast("array<bigint>").alias("vector"), none.cast("bigint").alias("least"),
    )
    asked = queries.select(
        "shard", "block", none.cast("binary").alias("trees"), "query_id", "query_key", "vector", "least"
    )
    tile = ["shard", "block"]
    dealt = blocked.unionByName(asked).repartition(*tile)
    return dealt.sortWithinPartitions(*tile, F.col("trees").isNull()).mapInArrow(_stream(k), _NEAR)


def _stream(k: int):
    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[int, Tree] = {}
        for batch in batches:
            found: list[tuple] = []
            for row in batch.to_pylist():
                if row["trees"] is not None:
                    trees = pickle.loads(row["trees"])
                    continue
                tree = trees.get(len(row["vector"]))
                if tree is not None:
                    values = np.asarray(row["vector"], dtype=np.int64)
                    for score, vec_id in tree.search(values, row["query_id"], k, row["least"]):
                        score = min(max(score, _LONG.min), _LONG.max)
                        found.append((row["query_id"], row["query_key"], vec_id, score))
            columns = list(zip(*found, strict=True)) or [[]] * 4
            names = ["query_id", "query_key", "vec_id", "score"]
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names)

    return hits
