"""SimHash near-dedup with covering locality-sensitive hashing.

A document's fingerprint has 64 bits: bit ``i`` is set if it is set in over half of the
hashes of its word shingles. Documents link if their fingerprints differ in at most
``radius`` bits, and the links' connected components are the groups.

Candidates come from ``2**(radius+1) - 1`` tables. Every bit position gets a fixed nonzero
vector of ``radius+1`` bits, and table ``v`` masks the positions whose vector has an odd
inner product with ``v``. The vectors of any ``radius`` positions leave some ``v`` that is
orthogonal to all of them, so every pair within the radius collides in that table: nothing
is missed, whatever the data.

Exact copies share a fingerprint and collapse before the tables. Inside a bucket only
the edges of a spanning forest are written, never all pairs. A bucket of more than
``bucket_rows`` fingerprints is dealt into blocks, and each pair of blocks is a task's work
of bounded size, so no bucket is capped and none is gathered.

Defined cases: a null text has no words, like an empty one; such texts have the fingerprint
zero and link like any other. Rows with a null id take part in the links; a group of such
rows alone has a null component, and one row of each of its texts stays. Rows that repeat
id and text are one document when rows are kept. Very long texts are read whole. An empty table
gives an empty result. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import rows_named, settled, text_digest, whole_text
from layerloom.llm.components import components

BITS = 64
SEED = 42
BUCKET_ROWS = 1 << 14
_SLICE = 1 << 13


def fingerprint(content: bytes, shingle_words: int = 3) -> int:
    """The fingerprint as an unsigned number; words end at ASCII white space."""
    words = content.lower().split()  # bytes: A-Z alone are lowered, only ASCII space splits
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = iter([words])
        total = 1
    else:
        shingles = zip(*(words[i:] for i in range(shingle_words)), strict=False)
        total = len(words) - shingle_words + 1
    ones = np.zeros(BITS, np.int64)
    join, digest = b" ".join, xxhash.xxh64_intdigest
    for start in range(0, total, _SLICE):
        count = min(_SLICE, total - start)
        hashes = np.fromiter((digest(join(next(shingles)), SEED) for _ in range(count)), np.uint64, count)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > total).tolist())


def fingerprint_column(text: Column, shingle_words: int = 3) -> Column:
    """The fingerprint's bits as a signed 64-bit number."""

    @F.pandas_udf("bigint")
    def of(contents: pd.Series) -> pd.Series:
        values = [fingerprint(content, shingle_words) for content in contents]
        return pd.Series(np.array(values, np.uint64).view(np.int64))

    return of(whole_text(text).cast("binary"))


def masks(radius: int, bits: int = BITS) -> list[int]:
    """One mask per nonzero vector; the positions' vectors take turns, so all are as wide."""
    size = (1 << (radius + 1)) - 1
    own = [i % size + 1 for i in range(bits)]
    return [
        sum(1 << i for i in range(bits) if (own[i] & v).bit_count() % 2)
        for v in range(1, size + 1)
    ]


def linked(prints: DataFrame, radius: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``one, other``: edges that connect what fingerprints within the radius connect.

    ``prints`` has distinct values in ``fingerprint``.
    """
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks(radius)]
    tables = F.array(*(F.struct(F.lit(i).alias("number"), F.lit(m).alias("mask")) for i, m in enumerate(signed)))
    keyed = prints.select("fingerprint", F.explode(tables).alias("t")).select(
        F.col("t.number").alias("number"),
        F.col("fingerprint").bitwiseAND(F.col("t.mask")).alias("key"),
        "fingerprint",
    )
    shared = keyed.groupBy("number", "key").agg(F.count("*").alias("size")).filter("size > 1")
    shared = settled(shared, "buckets")
    blocks = F.ceil(F.col("size") / bucket_rows).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    met = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("met")
    bucketed = (
        keyed.join(shared, ["number", "key"])
        .select("number", "key", "fingerprint", blocks.alias("blocks"))
        .select("number", "key", "fingerprint", own.alias("own"), met)
        .select(
            "number", "key", F.least("own", "met").alias("low"), F.greatest("own", "met").alias("high"), "fingerprint"
        )
    )
    group = ["number", "key", "low", "high"]
    dealt = bucketed.repartition(*group).sortWithinPartitions(*group)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _edges(batches, radius):
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["one", "other"])

    return dealt.mapInArrow(edges, "one bigint, other bigint").distinct()


def _edges(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[np.ndarray]:
    """The forests of all groups of a sorted partition; at most one group is kept back."""
    kept = np.empty((5, 0), np.int64)
    for batch in batches:
        columns = [np.asarray(column).astype(np.int64) for column in batch.columns]
        rows = np.concatenate([kept, np.array(columns).reshape(5, -1)], axis=1)
        if not rows.shape[1]:
            continue
        starts = np.flatnonzero(np.r_[True, (rows[:4, 1:] != rows[:4, :-1]).any(axis=0)])
        yield _forests(rows[4], starts[:-1], starts[1:], radius)
        kept = rows[:, starts[-1] :]
    if kept.shape[1]:
        yield _forests(kept[4], np.array([0]), np.array([kept.shape[1]]), radius)


def _forests(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, radius: int) -> np.ndarray:
    two = ends - starts == 2
    one, other = values[starts[two]], values[starts[two] + 1]
    near = np.bitwise_count((one ^ other).view(np.uint64)) <= radius
    found = [np.stack([one[near], other[near]], axis=1)]
    for start, end in zip(starts[ends - starts > 2], ends[ends - starts > 2], strict=True):
        found.append(_forest(values[start:end], radius))
    return np.concatenate(found)


def _forest(values: np.ndarray, radius: int) -> np.ndarray:
    """Edges of a spanning forest, by a search that always compares one value with the rest."""
    rest = np.unique(values)
    edges = []
    while len(rest):
        root, waiting, rest = rest[0], [rest[0]], rest[1:]
        while waiting and len(rest):
            near = np.bitwise_count((rest ^ waiting.pop()).view(np.uint64)) <= radius
            reached, rest = rest[near], rest[~near]
            waiting.extend(reached)
            edges.append(np.stack([np.full(len(reached), root), reached], axis=1))
    return np.concatenate(edges) if edges else np.empty((0, 2), np.int64)


def near_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = 3,
    radius: int = 3,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``doc_id, digest, print, root, component_id``: a row per row of ``docs``.

    ``print`` is the fingerprint as a signed number, ``root`` the fingerprint that names the
    component; the component's id is the smallest ``doc_id`` that links reach, the row's own
    included. Components that share a repeated id share that id, but never a root.
    """
    marked = docs.select(
        F.col(doc_id).alias("doc_id"),
        text_digest(F.col(text)).alias("digest"),
        fingerprint_column(F.col(text), shingle_words).alias("print"),
    )
    marked = settled(marked, "fingerprints")
    prints = marked.groupBy(F.col("print").alias("fingerprint")).agg(F.min("doc_id").alias("first_id"))
    prints = settled(prints, "distinct_fingerprints")
    roots = components(linked(prints.select("fingerprint"), radius, bucket_rows))
    rooted = prints.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")
    )
    rooted = settled(rooted, "rooted")
    firsts = settled(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "groups")
    named = settled(rooted.join(firsts, "root").select("fingerprint", "root", "component_id"), "named")
    return marked.join(named, F.col("print") == F.col("fingerprint")).drop("fingerprint")


def hex_print(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def one_of_each_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows that stay, with all columns: of each group the one with the smallest id."""
    groups = near_groups(docs, doc_id, text, **options)
    first = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # An id can be the smallest of several components, so their roots tell them apart.
    each = F.when(F.col("doc_id").isNull(), F.col("digest")).alias("each")
    keepers = first.groupBy("root", each).agg(F.min(F.struct("doc_id", "print", "digest")).alias("kept"))
    keepers = keepers.select("kept.doc_id", "kept.digest")
    return rows_named(docs, settled(keepers, "keepers"), doc_id, text)
