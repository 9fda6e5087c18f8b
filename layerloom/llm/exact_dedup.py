"""Exact dedup by composable polynomial fingerprints.

A text's bytes are the coefficients of a polynomial, and its fingerprint is that
polynomial's value at a fixed base, modulo two primes. Fingerprints compose: with ``m``
bytes behind it, a chunk adds ``hash(chunk) * base**m``, so a text's fingerprint is the
plain sum of what its chunks add. A huge document is therefore cut into chunk rows that any
task may hash, and Spark's partial aggregation adds them up.

Texts with equal fingerprints are candidates only. Each is compared with the one that
would stay, chunk by chunk, in a join that streams both sides; no task holds a whole text
of the huge kind, nor a group. Texts that differ in spite of equal fingerprints are grouped
again among themselves, until each is in the group of texts that equal it.

Defined cases: a null text is an empty text, and empty texts are equal. A null ``doc_id``
sorts below all others. Rows that repeat both ``doc_id`` and text are one document, whose
copies count in ``group_size``. Rows that repeat only the ``doc_id`` are two documents.
Other columns play no part, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import rows_named, settled, text_digest, whole_text

CHUNK_BYTES = 1 << 16
#: Primes below 2**31, so that products and sums of a chunk stay within 64 bits.
MODULI = (2_147_483_647, 2_147_483_629)
BASE = 1_000_003

_FINGERPRINT = ["n_bytes", "high", "low"]


def chunk_hash(chunk: bytes, modulus: int) -> int:
    """The value of the chunk's polynomial: its last byte is the constant term."""
    values = np.frombuffer(chunk, np.uint8).astype(np.uint64)
    return int(np.dot(values, _powers(len(chunk), modulus)) % modulus)


def combined(left: int, right: int, right_bytes: int, modulus: int) -> int:
    """The hash of two chunks in a row, from their hashes and the second one's length."""
    return (left * pow(BASE, right_bytes, modulus) + right) % modulus


def _powers(length: int, modulus: int, kept: dict = {}) -> np.ndarray:  # noqa: B006
    """``base**(length-1) .. base**0``; a process keeps the longest ones of each modulus."""
    known = kept.get(modulus)
    if known is None or len(known) < length:
        powers = np.empty(max(length, CHUNK_BYTES), np.uint64)
        value = 1
        for i in range(len(powers)):
            powers[i] = value
            value = value * BASE % modulus
        kept[modulus] = known = powers[::-1].copy()
    return known[len(known) - length :]


def _contribution(moduli: tuple[int, int]):
    @F.pandas_udf("struct<high:bigint,low:bigint>")
    def contribution(chunks: pd.Series, behind: pd.Series) -> pd.DataFrame:
        rows = [
            [combined(chunk_hash(chunk, p), 0, after, p) for p in moduli]
            for chunk, after in zip(chunks, behind, strict=True)
        ]
        return pd.DataFrame(rows, columns=["high", "low"], dtype="int64")

    return contribution


def _chunks(content: Column, chunk_bytes: int) -> Column:
    """The content cut into pieces of at most so many bytes; an empty one has one piece."""
    last = F.floor((F.greatest(F.octet_length(content), F.lit(1)) - 1) / chunk_bytes)
    return F.transform(
        F.sequence(F.lit(0), last.cast("int")),
        lambda i: F.substring(content, i * chunk_bytes + 1, chunk_bytes),
    )


def _contents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id`` and the digest of the text, which name a document, and its bytes."""
    content = whole_text(F.col(text)).cast("binary")
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        text_digest(F.col(text)).alias("digest"),
        content.alias("content"),
    )


def fingerprints(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    moduli: tuple[int, int] = MODULI,
) -> DataFrame:
    """``doc_id, digest, n_bytes, high, low, copies``: a row per document.

    Texts of one chunk are hashed where they are read. The chunk rows of longer ones are
    dealt over the tasks, so that one huge text is hashed in parallel.
    """
    contents = _contents(docs, doc_id, text).withColumn("n_bytes", F.octet_length("content"))
    name = ["doc_id", "digest", "n_bytes"]
    whole = contents.filter(F.col("n_bytes") <= chunk_bytes).select(
        *name, F.lit(0).alias("chunk_no"), F.col("content").alias("chunk")
    )
    cut = contents.filter(F.col("n_bytes") > chunk_bytes).select(
        *name, F.posexplode(_chunks(F.col("content"), chunk_bytes)).alias("chunk_no", "chunk")
    )
    cut = cut.repartition("digest", "chunk_no")
    end = F.least(F.col("n_bytes"), (F.col("chunk_no") + 1).cast("long") * chunk_bytes)
    added = _contribution(moduli)("chunk", (F.col("n_bytes") - end).cast("long"))
    sums = (
        whole.unionByName(cut)
        .select(*name, "chunk_no", added.alias("added"))
        .groupBy(*name)
        .agg(
            F.sum("added.high").alias("high"),
            F.sum("added.low").alias("low"),
            F.count_if(F.col("chunk_no") == 0).alias("copies"),
        )
    )
    # Repeated rows of one document add the same sum once each.
    once = [
        F.pmod(F.expr(f"{part} div copies"), F.lit(p)).alias(part)
        for part, p in zip(("high", "low"), moduli, strict=True)
    ]
    return sums.select(*name, *once, "copies")


def duplicate_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    moduli: tuple[int, int] = MODULI,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: a row per document.

    Of equal texts the one with the largest ``doc_id`` stays.
    """
    prints = settled(fingerprints(docs, doc_id, text, chunk_bytes, moduli), "fingerprints")
    contents = _contents(docs, doc_id, text)
    name = ["doc_id", "digest"]
    matched: list[DataFrame] = []
    open_prints = prints
    while True:
        candidates = settled(_candidates(open_prints), "candidates")
        compared = settled(_compared(candidates, contents, chunk_bytes), "compared")
        matched.append(compared.filter("equal").select(*name, "keep_id", "keep_digest"))
        different = compared.filter("not equal").select(*name)
        if different.isEmpty():
            break
        open_prints = settled(_only(prints, different), "collided")
    members = reduce(DataFrame.unionByName, matched)
    keep = F.struct(
        F.coalesce(F.col("keep_digest"), F.col("digest")).alias("digest"),
        F.when(F.col("keep_digest").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("id"),
    )
    judged = _left(prints, members).select(*name, "copies", keep.alias("keep"))
    judged = settled(judged, "judged")
    sizes = settled(judged.groupBy("keep").agg(F.sum("copies").alias("group_size")), "group_sizes")
    return (
        judged.join(sizes, "keep")
        .select(
            "doc_id",
            F.col("keep.id").alias("keep_id"),
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep.id")).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )
    )


def without_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """The rows that stay, with all their columns; of repeated rows, one."""
    groups = duplicate_groups(docs, doc_id, text, **options)
    keepers = groups.filter("kept").select("doc_id", F.col("text_sha256").alias("digest"))
    return rows_named(docs, settled(keepers, "keepers"), doc_id, text)


def _candidates(prints: DataFrame) -> DataFrame:
    """Documents that share a fingerprint, each with the one that would stay.

    The group sizes come from a map-side combined count and are stored first, so that the
    join has plain inputs on both sides and a hot fingerprint's rows can be split.
    """
    groups = prints.groupBy(*_FINGERPRINT).agg(
        F.count("*").alias("members"), F.max(F.struct("doc_id", "digest")).alias("keep")
    )
    groups = settled(groups.filter("members > 1").drop("members"), "shared_fingerprints")
    return prints.join(groups, _FINGERPRINT).select(
        "doc_id",
        "digest",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("keep.digest").alias("keep_digest"),
    )


def _compared(candidates: DataFrame, contents: DataFrame, chunk_bytes: int) -> DataFrame:
    """``equal``: whether all chunks of a candidate are those of the text that would stay."""
    name, keep = ["doc_id", "digest"], ["keep_id", "keep_digest"]
    wanted = candidates.withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})
    same = (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    chunk = F.posexplode(_chunks(F.col("content"), chunk_bytes)).alias("chunk_no", "chunk")
    own = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("digest") == F.col("keep_digest"))
    pieces = contents.join(wanted, same).select(*name, *keep, own.alias("own"), chunk)
    pieces = settled(pieces, "pieces")
    stays = (
        pieces.filter("own")
        .select(
            F.col("keep_id").alias("_keep"),
            F.col("keep_digest").alias("_keep_digest"),
            F.col("chunk_no").alias("_no"),
            F.col("chunk").alias("_chunk"),
        )
    )
    # Repeated rows of the document that stays would only repeat the same chunks.
    stays = settled(stays.dropDuplicates(["_keep", "_keep_digest", "_no"]), "kept_pieces")
    met = (
        F.col("keep_id").eqNullSafe(F.col("_keep"))
        & (F.col("keep_digest") == F.col("_keep_digest"))
        & (F.col("chunk_no") == F.col("_no"))
    )
    return (
        pieces.filter("not own")
        .join(stays, met)
        .select(*name, *keep, (F.col("chunk") == F.col("_chunk")).alias("same"))
        .groupBy(*name, *keep)
        .agg(F.min("same").alias("equal"))
    )


def _only(prints: DataFrame, wanted: DataFrame) -> DataFrame:
    other = wanted.withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})
    same = (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return prints.join(other, same, "left_semi")


def _left(prints: DataFrame, members: DataFrame) -> DataFrame:
    other = members.withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})
    same = (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return prints.join(other, same, "left")
