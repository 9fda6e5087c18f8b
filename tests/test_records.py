from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerloom import sinks, sources


def bodies(spark, *texts):
    return spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "n int, body string").repartition(3)


def found(spark, *texts):
    return dict(sources.schema_paths(sources.found_schema(bodies(spark, *texts), "body")))


def test_fields_unite_at_every_depth(spark):
    assert found(
        spark, '{"a": {"x": 1}, "l": [{"p": "s"}]}', '{"a": {"y": true}, "l": [{"q": 2}], "z": "t"}', '{"l": []}'
    ) == {"a.x": "bigint", "a.y": "boolean", "l[].p": "string", "l[].q": "bigint", "z": "string"}


@pytest.mark.parametrize(
    ("one", "other", "kind"),
    [
        ("1", "2.25", "decimal(22,2)"), ("1", "1e3", "double"), ("1", "null", "bigint"), ("null", "null", "string"),
        ('"s"', "1", "variant"), ('"s"', '{"k": 1}', "variant"), ("[1]", "1", "variant"), ("true", '"true"', "variant"),
        ("{}", "{}", "variant"), ("12345678901234567890", "1", "decimal(20,0)"),
    ],
)
def test_conflicting_types_widen_without_loss(spark, one, other, kind):
    texts = [f'{{"v": {value}}}' for value in (one, other)]
    assert found(spark, *texts) == {"v": kind}
    records = sources.records_from_json(bodies(spark, *texts), "body")
    # Written as JSON again, each value is what it was.
    back = {r.n: json.loads(r.v) if r.v is not None else None for r in records.select("n", F.to_json(F.struct("v")).alias("v")).collect()}
    for n, value in enumerate((one, other)):
        assert back[n].get("v") == json.loads(value)


@pytest.mark.parametrize("texts", [[], [None], ["", "oops", "3", "[1]", "null", '"s"', '{"a": 1, "a": 2}']])
def test_without_an_object_there_is_no_field(spark, texts):
    df = bodies(spark, *texts) if texts else bodies(spark, None).limit(0)
    assert sources.found_schema(df, "body") == StructType()


def test_bodies_that_are_no_objects_spoil_nothing(spark):
    assert found(spark, '{"a": 1}', None, "oops", "[]", '{"a": 1', "7") == {"a": "bigint"}


def test_odd_names(spark):
    text = '{"OBJECT<": {"a b": 1, "q`": {"OBJECT<x>": [null]}}, "é.f": "s"}'
    schema = sources.found_schema(bodies(spark, text), "body")
    row = sources.records_from_json(bodies(spark, text), "body", schema).first()
    assert row["OBJECT<"]["q`"]["OBJECT<x>"] == [None]
    assert row["OBJECT<"]["a b"] == 1 and row["é.f"] == "s"


def test_found_records_can_be_stored(spark, config):
    df = bodies(spark, '{"a": {}, "b": null, "c": [], "d": 1}', '{"d": "x"}')
    records = sources.records_from_json(df, "body")
    sinks.write_layer(records, config, "silver", "found")
    stored = sources.read_layer(spark, config, "silver", "found", records.schema)
    assert sorted(r.d.toJson() for r in stored.collect()) == ['"x"', "1"]


def test_one_type_a_task_is_shuffled(spark):
    df = spark.range(0, 10_000, 1, 4).select(F.to_json(F.struct("id")).alias("body"))
    parsed = df.select(F.try_parse_json("body").alias("body")).agg(F.schema_of_variant_agg("body"))
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_schema_of_variant_agg" in plan
