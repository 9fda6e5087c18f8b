"""Random inputs against plain Python."""

from __future__ import annotations

import json
import random
from collections import Counter
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerloom import functions, operators, sinks, sources

texts = st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=12), min_size=1, max_size=60)
few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def column(spark, values, name="value"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")


@few
@given(texts)
def test_stripped_and_blank(spark, values):
    df = column(spark, values)
    rows = df.select("i", functions.stripped("value"), functions.is_blank("value")).collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == {
        i: (v.strip(), not v.strip()) for i, v in enumerate(values)
    }


@few
@given(texts)
def test_json_array_roundtrip(spark, tmp_path_factory, values):
    df = column(spark, values).repartition(3)
    path = sinks.write_json_array(df, str(tmp_path_factory.mktemp("a") / "x"), rows_per_file=7)
    files = [p for p in Path(path).glob("part-*")]
    arrays = [json.loads(f.read_bytes().decode("utf-8") or "[]") for f in files]
    written = Counter((row["i"], row["value"]) for array in arrays for row in array)
    assert written == Counter(enumerate(values))
    back = sources.read_json_array(spark, path, df.schema)
    assert Counter(map(tuple, back.collect())) == Counter(enumerate(values))


@few
@given(texts)
def test_json_records_roundtrip(spark, values):
    df = column(spark, values)
    bodies = df.select(functions.json_text(F.struct("i", F.struct("value").alias("s"))).alias("body"))
    rows = sources.records_from_json(bodies, "body", "i int, s struct<value: string>")
    assert Counter((r.i, r.s.value) for r in rows.collect()) == Counter(enumerate(values))


@few
@given(st.lists(st.tuples(st.sampled_from(["a", "", None, "b"]), st.integers(-5, 5) | st.none()), max_size=80))
def test_key_metrics(spark, pairs):
    df = spark.createDataFrame(pairs, "k string, v int")
    rows = operators.key_metrics(df, "k", "v", "n", "latest").collect()
    expected = {}
    for k in {k for k, _ in pairs}:
        values = [v for key, v in pairs if key == k]
        expected[k] = (len(values), max((v for v in values if v is not None), default=None))
    assert {r.k: (r.n, r.latest) for r in rows} == expected


def random_body(rng):
    """A landed body, and what it must give: its elements, or None for a reject."""
    elements = [
        rng.choice([{"league": {"id": rng.randrange(9)}}, {"n": rng.random()}, {"s": "é\n\"x"}, {}])
        for _ in range(rng.randrange(4))
    ]
    results = rng.choice([None, 0, len(elements), 1, -1])
    body = {"get": "x", "results": results, "response": elements, "paging": {"total": 1}}
    for name in ("results", "response"):
        if rng.random() < 0.1:
            del body[name]
    text = json.dumps(body, indent=rng.choice([None, 2]), ensure_ascii=rng.choice([True, False]))
    spoiled = rng.random()
    if spoiled < 0.1:
        return text[: rng.randrange(len(text))].rstrip("}\n "), None
    if spoiled < 0.15:
        return rng.choice([None, "", " ", "oops", "[]", "3", '"x"', "<p>{}</p>"]), None
    return text, (body.get("response", []) if body.get("results") else [])


@pytest.mark.parametrize("seed", range(3))
def test_envelopes_against_python(spark, seed):
    rng = random.Random(seed)
    landed = [(i, *random_body(rng)) for i in range(1500)]
    df = spark.createDataFrame([(i, body) for i, body, _ in landed], "i int, body string")
    df = df.repartition(4)
    want = Counter(
        (i, json.dumps(e, sort_keys=True)) for i, _, given_ in landed for e in given_ or []
    )
    got = Counter(
        (r.i, json.dumps(json.loads(r.element), sort_keys=True))
        for r in sources.accepted(df).collect()
    )
    assert got == want
    rejects = Counter((r.i, r.rejected_body) for r in sources.rejected(df).collect())
    assert rejects == Counter((i, body) for i, body, given_ in landed if given_ is None)
    empty = sum(1 for _, _, given_ in landed if given_ == [])
    outcomes = Counter(r.outcome for r in sources.opened(df).select("outcome").collect())
    assert outcomes == {"accepted": want.total(), "rejected": rejects.total(), "empty": empty}
