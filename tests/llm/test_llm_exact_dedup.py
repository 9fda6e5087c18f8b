from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

from layerloom.llm import exact_dedup

SCHEMA = "doc_id bigint, text string, digest string, keep_id int"
ROWS = [
    (1, "abc", "x", 1), (2, "abc", None, 2), (9, "abc", "x", 3), (9, "abc", "x", 3), (9, "other", "x", 3),
    (3, None, "x", 4), (4, "", "x", 4), (None, "abc", "x", 5), (None, "lonely", "x", 5), (None, "lonely", "x", 6),
    (5, "é" * 50, "x", 7), (6, "é" * 49 + "e", "x", 7), (7, "a" * 100, "x", 7), (8, "a" * 100, "x", 7),
    (10, "a" * 101, "x", 7), (11, "\x00", "x", 8), (12, "\x00\x00", "x", 8), (13, "ABC", "x", 8),
]


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1] or ""].append(row[0])
    out = set()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out |= {(i, keep, len(ids), i == keep, digest) for i in ids}
    return out


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 3}, {"chunk_bytes": 3, "moduli": (2, 3)}, {"moduli": (1, 1)}])
def test_groups_equal_brute_force_also_when_fingerprints_collide(spark, options):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    result = [tuple(r) for r in exact_dedup.duplicate_groups(docs, **options).collect()]
    assert len(result) == len(set(result))
    assert set(result) == brute(ROWS)


def test_kept_rows_have_all_columns(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    kept = exact_dedup.without_duplicates(docs)
    assert kept.schema == docs.schema
    texts = sorted(r.text or "" for r in kept.collect())
    assert texts == sorted({r[1] or "" for r in ROWS})
    assert {r.doc_id for r in kept.collect() if r.text == "abc"} == {9}


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.duplicate_groups(docs).count() == exact_dedup.without_duplicates(docs).count() == 0


def test_chunks_compose():
    content, p = bytes(range(256)) * 3, exact_dedup.MODULI[0]
    whole = exact_dedup.chunk_hash(content, p)
    for cut in (0, 1, 100, len(content)):
        left, right = content[:cut], content[cut:]
        hashes = exact_dedup.chunk_hash(left, p), exact_dedup.chunk_hash(right, p)
        assert exact_dedup.combined(*hashes, len(right), p) == whole


def test_texts_above_the_chunk_size(spark):
    """Of the default size: equal texts of several chunks, one that differs at the very end, and at a border."""
    size = exact_dedup.CHUNK_BYTES
    long = "0123456789abcdef" * (size // 4) + "tail"
    rows = [(1, long), (2, long), (3, long[:-1] + "L"), (4, long[: size - 1] + "X" + long[size:]), (5, "é" * size), (6, "é" * size)]
    rows += [(7, long[:size]), (8, long[:size]), (9, long[: size + 1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert {tuple(r) for r in exact_dedup.duplicate_groups(docs).collect()} == brute(rows)
    for text in (long, "é" * size):
        content, p = text.encode(), exact_dedup.MODULI[1]
        value = 0
        for byte in content:
            value = (value * exact_dedup.BASE + byte) % p
        found = exact_dedup.fingerprints(docs.filter(docs["text"] == text)).first()
        assert found.low == value and found.n_bytes == len(content)
