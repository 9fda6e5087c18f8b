from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
import xxhash

from layerloom.llm import simhash
from layerloom.llm.components import components
from layerloom.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, print int, digest string"


def brute_print(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(space, " ")
    words = [w for w in lowered.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """By doc_id: the smallest doc_id reachable."""
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for one, other in itertools.combinations(sorted(prints), 2):
        if (prints[one] ^ prints[other]).bit_count() <= 3:
            low, high = sorted((root(one), root(other)))
            parent[high] = low
    return {i: root(i) for i in prints}


def test_masks_cover_every_pair_in_the_radius():
    masks = simhash.masks(3)
    assert len(masks) == 15
    for places in itertools.combinations(range(64), 3):
        difference = sum(1 << p for p in places)
        assert any(not difference & m for m in masks)


@pytest.mark.parametrize("text", ["", None, " \n", "One", "one two", "A b\tC d\n\x0b e", "É é \xa0x y z", "w " * 20_000])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == brute_print(text)


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = {r.doc_id: brute_print(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    groups = brute_components(docs)
    found = QUERIES["op7_simhash"](spark, sf_dir).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {
        (i, f"{p:016x}", groups[i]) for i, p in docs.items()
    }


@pytest.mark.parametrize("bucket_rows", [2, 5, 1 << 14])
def test_edges_connect_what_the_radius_connects(spark, bucket_rows):
    rnd = random.Random(7)
    values = {0, (1 << 64) - 1}
    for _ in range(12):  # chains that drift apart, so that only their ends are far
        value = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 25)):
            values.add(value)
            for bit in rnd.sample(range(64), rnd.randint(1, 4)):
                value ^= 1 << bit
    signed = [int(v) for v in np.array(sorted(values), np.uint64).view(np.int64)]
    prints = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint").repartition(3)
    edges = simhash.linked(prints, 3, bucket_rows)
    roots = {r.node: r.root for r in components(edges).collect()}
    want = brute_components({v: v & (1 << 64) - 1 for v in signed})
    assert all(r.one != r.other and want[r.one] == want[r.other] for r in edges.collect())
    assert {v: roots.get(v, v) for v in signed} == want


def test_one_of_each_group_stays(spark):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(5, long, 1, "a"), (3, long + " end", 2, "b"), (8, None, 3, "c"), (9, "", 4, "d"), (3, "q r s", 5, "e")]
    rows += [(None, long, 6, "f"), (None, "z y x", 7, "g"), (None, "z y x", 8, "h")]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = simhash.one_of_each_group(docs)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect() if r.text) [0] == (0, "z y x")
    assert {r.doc_id for r in kept.collect()} == {None, 3, 8}
    assert simhash.near_groups(docs.limit(0)).count() == simhash.one_of_each_group(docs.limit(0)).count() == 0


def test_groups_that_share_their_smallest_id_each_keep_a_text(spark):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(5, long, 1, "a"), (3, long + " end", 2, "b"), (3, "q r s", 3, "c"), (4, "q r s", 4, "d"), (None, "z y x", 5, "e")]
    kept = simhash.one_of_each_group(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, "z y x"), (3, "q r s"), (3, long + " end")]
