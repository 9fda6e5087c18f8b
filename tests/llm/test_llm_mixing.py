from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from layerloom.llm import mixing
from layerloom.llm.queries import QUERIES


@given(st.dictionaries(st.text("abc", min_size=1, max_size=3), st.integers(1, 30), min_size=1, max_size=12))
@settings(max_examples=150, deadline=None)
def test_every_prefix_is_within_one_block(slots):
    plan = mixing.schedule(slots)
    period, had = sum(slots.values()), Counter()
    assert Counter(source for source, _, _ in plan) == slots
    for source, block, slot in plan:
        assert block == had[source]
        had[source] += 1
        for name, share in slots.items():
            assert abs(had[name] - Fraction(share * (slot + 1), period)) < 1


def earliest_deadlines(weights, blocks):
    """The slots of so many blocks of each source, by the definition alone: exact and slot by slot."""
    total = sum(map(Fraction, weights.values()))
    shares = {source: Fraction(weight) / total for source, weight in weights.items()}
    order = sorted(weights, key=lambda source: (source is None, source))
    had, place, slot = Counter(), {}, 0
    while any(had[source] < blocks[source] for source in order):
        released = [s for s in order if math.floor(had[s] / shares[s]) <= slot]
        first = min(released, key=lambda s: math.ceil((had[s] + 1) / shares[s]))
        assert slot < math.ceil((had[first] + 1) / shares[first])
        place[first, had[first]] = slot
        had[first] += 1
        slot += 1
    return place


def brute(rows, block_rows, temperature=0.5):
    groups = defaultdict(list)
    for doc_id, source in rows:
        groups[source].append(doc_id)
    blocks = {s: -(-len(ids) // block_rows) for s, ids in groups.items()}
    place = earliest_deadlines({s: len(ids) ** temperature for s, ids in groups.items()}, blocks)
    out = set()
    for source, ids in groups.items():
        ordered = sorted(ids, key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))
        for rank, doc_id in enumerate(ordered):
            block = rank // block_rows
            out.add((doc_id, source, block, place[source, block], rank % block_rows))
    return out


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    found = QUERIES["op4_pfair_mix"](spark, sf_dir).collect()
    want = brute([tuple(r) for r in docs.collect()], mixing.BLOCK_ROWS)
    assert {tuple(r) for r in found} == want and len(found) == len(want)


def test_hot_source_null_source_repeats_and_clashing_columns(spark):
    rows = [(i, "hot", "s", i) for i in range(400)] + [(i, None, "s", i) for i in range(400, 440)]
    rows += [(i, f"s{i % 3}", "s", i) for i in range(500, 560)] + [(500, "s2", "again", 1), (None, "s1", "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, slot string, key int").repartition(5)
    placed = mixing.mixed(docs, block_rows=4, period=20)
    assert placed.columns == ["doc_id", "source", "key", "block", "slot", "place"]
    found = placed.collect()
    assert len(found) == len(rows)
    for source in ("hot", None, "s0", "s1", "s2"):
        own = sorted((r.block, r.place) for r in found if r.source == source)
        assert own == [(n // 4, n % 4) for n in range(len(own))]
    kept = mixing.in_mixed_order(docs, block_rows=4, period=20)
    assert kept.schema == docs.schema
    assert Counter(map(tuple, kept.collect())) == Counter(rows)


def test_targets(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(64)], "doc_id int, source string")
    found = mixing.mixed(docs, {"a": 3, "b": 1, "unused": 9}, block_rows=1, period=4).collect()
    first = [r.source for r in sorted(found, key=lambda r: r.slot) if r.slot < 40]
    assert Counter(first) == {"a": 30, "b": 10}
    with pytest.raises(ValueError):
        mixing.mixed(docs, {"a": 1})
    with pytest.raises(ValueError):
        mixing.mixed(docs, {"a": 1, "b": 0})
    assert mixing.mixed(docs.limit(0)).count() == 0


@pytest.mark.parametrize(
    "targets",
    [
        {"a": 9, "b": 1},
        {"hot": 500.0, **{f"s{i:03}": 1.0 for i in range(500)}},
        {"hot": 1000**0.5, **{f"s{i:02}": (100 + i) ** 0.5 for i in range(19)}},
        {f"s{i:04}": 1 + i % 3 for i in range(1200)},
    ],
    ids=["nine to one", "500 small sources", "hot third", "1200 sources"],
)
def test_prefixes_are_within_one_block_of_the_targets(targets):
    plan = mixing.schedule(mixing.slots_of(targets, 2500))
    assert [slot for _, _, slot in plan] == list(range(2500))
    had, total = Counter(), sum(map(Fraction, targets.values()))
    for source, block, slot in plan:
        weight = Fraction(targets[source]) / total
        assert block == had[source] and block / weight < slot + 1 and slot < (block + 1) / weight
        had[source] += 1
    assert all(abs(had[s] - Fraction(w) * 2500 / total) < 1 for s, w in targets.items())


def test_rows_follow_the_targets_of_many_sources(spark):
    names = ["hot"] * 1100 + [f"s{i}" for i in range(1100)]
    docs = spark.createDataFrame(list(enumerate(names)), "doc_id int, source string").repartition(4)
    found = mixing.mixed(docs, {"hot": 1100.0, **{f"s{i}": 1.0 for i in range(1100)}}, block_rows=1).collect()
    assert sorted(r.doc_id for r in found) == list(range(2200))
    order = sorted((r.slot, r.source) for r in found)
    assert [slot for slot, _ in order] == list(range(2200))
    had = 0
    for slot, source in order:
        had += source == "hot"
        assert abs(had - (slot + 1) / 2) < 1
    assert mixing.mixed(docs).count() == 2200  # by row counts, beyond a thousand sources


def test_blocks_grow_with_the_rows_beyond_a_bound(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 5}") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string").repartition(4)
    found = mixing.mixed(docs, block_rows=4, most_blocks=50).collect()
    assert {tuple(r) for r in found} == brute(rows, 20)
    assert len({(r.source, r.block) for r in found}) <= 50 + 6
