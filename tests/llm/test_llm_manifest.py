from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from layerloom.llm import manifest
from layerloom.llm.queries import QUERIES


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_over(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + 3])) for i in range(0, len(below), 3)])
    return levels


def walked(levels, i, own):
    """All siblings on the way up, and what the leaf's digest folds to."""
    proof = ""
    for below in levels[:-1]:
        run = below[i // 3 * 3 : i // 3 * 3 + 3]
        left, right = "".join(run[: i % 3]), "".join(run[i % 3 + 1 :])
        proof, own, i = proof + left + right, digest(left + own + right), i // 3
    return proof, own


def brute(rows):
    """From ``(doc_id, source, fields, presented fields)``: the multiset of result rows."""
    by = defaultdict(list)
    for row in rows:
        by[row[1]].append((row[0], leaf(row[2]), leaf(row[3])))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for own in by.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = {s: levels_over([r[1] for r in by[s]]) for s in order}
    top = levels_over([trees[s][-1][0] for s in order])
    found = []
    for k, s in enumerate(order):
        for i, (doc_id, own, presented) in enumerate(by[s]):
            proof, folded = walked(trees[s], i, presented)
            above, folded = walked(top, k, folded)
            root = top[-1][0]
            found.append((doc_id, own, trees[s][-1][0], root, digest(proof + above), folded, folded == root))
    return sorted(found, key=repr)


@pytest.mark.parametrize("sf", ["0.001", "0.1"])  # the larger one has several blocks and partitions
def test_query_equals_brute_force(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    rows = []
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        changed = r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
        fields = (r.doc_id, r.source, r.lang, r.n_chars)
        rows.append((r.doc_id, r.source, (*fields, r.text), (*fields, r.text.replace("\n", "") if changed else r.text)))
    found = QUERIES["op12_merkle_manifest"](spark, sf_dir).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, None, "a", "x"), (1, None, None, "x"), (1, None, None, "x"), (1, None, "", "x"), (2, "", "t", "x"),
        (3, "é", "é" * 100_000, None), (4, "z\x00", "\n", "x"), (-5, "Z", "5:", "x"), (6, "-", "-", "x"), (6, ":", "-", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, position string")
    columns = ["doc_id", "source", "text"]
    built = manifest.built(docs, columns, changed=manifest.digest_of([F.lit("forged")]))
    want = brute([(r[0], r[1], r[:3], r[:3]) for r in rows])
    assert sorted(map(tuple, manifest.proven(built).collect()), key=repr) == want
    assert all(row[-1] for row in want)
    assert not any(row.verified for row in manifest.proven(built, "changed").collect())


@pytest.mark.parametrize("number", [0, 1])
def test_empty_and_lone(spark, number):
    docs = spark.createDataFrame([(7, "s", "t")], "doc_id long, source string, text string").limit(number)
    built = manifest.built(docs, ["text"])
    assert (built.root is None) == (number == 0)
    assert [(r.leaf, r.proof_sha256, r.verified) for r in manifest.proven(built).collect()] == [
        (leaf(["t"]), digest(""), True)
    ] * number


@pytest.mark.parametrize("seed", range(40))
def test_multiproofs_are_minimal_and_whole(seed):
    rng = random.Random(seed)
    size = rng.randrange(1, 200)
    first = rng.randrange(size)
    last = rng.randrange(first, size)
    digests = [digest(str(i)) for i in range(size)]
    levels = levels_over(digests)
    known = set(range(first, last + 1))
    want = set()
    for level, below in enumerate(levels[:-1]):  # every sibling that is not known on its level
        runs = {i // 3 for i in known}
        want |= {(level, i) for r in runs for i in range(3 * r, min(3 * r + 3, len(below))) if i not in known}
        known = runs
    coordinates = list(manifest.missing(first, last, size))
    assert len(coordinates) == len(want) and set(coordinates) == want
    proofs = manifest.Proofs(first, digests[first : last + 1], size, {at: levels[at[0]][at[1]] for at in want})
    for i in range(first, last + 1):
        assert (proofs.proof(i), proofs.folded(i, digests[i])) == walked(levels, i, digests[i])
    assert proofs.folded(last, digest("other")) != proofs.root == levels[-1][0]
