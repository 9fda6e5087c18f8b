from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from layerloom import functions, operators, sources
from layerloom.fixed_values import WHITESPACE


def column(df):
    return [row[0] for row in df.collect()]


def one(spark, expression):
    return spark.range(1).select(expression).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [("a@b.com", "b.com"), ("a@b@c", "b@c"), ("none", ""), ("x@", ""), ("", ""), (None, None)],
)
def test_captured(spark, text, expected):
    assert one(spark, functions.captured(F.lit(text).cast("string"), "@(.+)")) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-31", datetime.date(2024, 1, 31)),
        ("2024-02-30", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_parsed_date(spark, text, expected):
    assert one(spark, functions.parsed_date(F.lit(text).cast("string"), "yyyy-MM-dd")) == expected


@pytest.mark.parametrize("text", ["  a b ", "\t\n x\r\n", "", "   ", " 名　", "\xa0", "x"])
def test_stripped_equals_python(spark, text):
    assert one(spark, functions.stripped(F.lit(text))) == text.strip()
    assert one(spark, functions.is_blank(F.lit(text))) == (not text.strip())


def test_whitespace_is_what_python_strips():
    assert sorted(WHITESPACE) == [chr(c) for c in range(0x3100) if not chr(c).strip()]


@pytest.mark.parametrize(
    "body, expected",
    [
        ('{"results": 3}', 3),
        ('{"results": "4"}', 4),
        ('{"results": null}', 0),
        ('{"results": "many"}', 0),
        ("{}", 0),
        ("no json", 0),
        (None, 0),
    ],
)
def test_json_field_with_default(spark, body, expected):
    field = functions.json_field(F.lit(body).cast("string"), "$.results", "bigint", default=0)
    assert one(spark, field) == expected


def test_json_record_nested(spark):
    record = functions.json_record(F.lit('{"a": {"b": [1, 2]}}'), "a struct<b: array<int>>, c int")
    assert one(spark, record).asDict(recursive=True) == {"a": {"b": [1, 2]}, "c": None}


def test_records_from_json_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, '{"league": {"id": 9}}', "x")], "k int, body string, z string")
    rows = sources.records_from_json(df, "body", "league struct<id: bigint>")
    assert rows.columns == ["k", "z", "league"]
    assert tuple(rows.select("k", "z", "league.id").first()) == (1, "x", 9)


def test_flattened(spark):
    df = spark.createDataFrame([([[1, 2], [], None, [2]],), ([],), (None,)], "a array<array<int>>")
    assert column(df.select(functions.flattened("a"))) == [[1, 2, 2], [], None]


def test_exploded(spark):
    df = spark.createDataFrame([(1, [7, 7]), (2, []), (3, None)], "k int, a array<int>")
    rows = operators.exploded(df, "a", "x")
    assert [tuple(r) for r in rows.collect()] == [(1, 7), (1, 7)]
    rows = operators.exploded(df, F.array("k", "k"), "x").select("k", "x")
    assert rows.count() == 6


def test_where_equal_drops_nulls_and_reaches_into_structs(spark):
    df = spark.createDataFrame([((1,),), ((2,),), ((None,),), (None,)], "league struct<id: bigint>")
    assert operators.where_equal(df, "league.id", 1).count() == 1


def test_nested_field_is_named_after_its_last_part(spark):
    df = spark.createDataFrame([((1,),), (None,)], "league struct<id: bigint>")
    assert operators.nested_fields(df, "league.id").columns == ["id"]
    assert column(operators.nested_fields(df, "league.id")) == [1, None]


def test_named_like_is_literal(spark):
    names = ["part-1.json", "part-2.txt", "xpart-1.json", "part-3.json.crc", "part_1.json", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert column(operators.named_like(df, "name", "part-", ".json")) == ["part-1.json"]
    assert operators.named_like(df, "name").count() == 6
    assert operators.named_like(df, "name", suffix=".txt").count() == 1


def test_non_blank(spark):
    df = spark.createDataFrame([("a",), (" ",), ("\t\n",), ("",), (None,), (" b ",)], "value string")
    assert column(operators.non_blank(df)) == ["a", " b "]


def test_request_grid_golden(spark):
    # The requested leagues and seasons.
    leagues = (140, 39, 45, 2, 3, 143, 135)
    ids = spark.createDataFrame([(i,) for i in leagues], "league_id int")
    grid = operators.request_grid(ids, "season", [2022, 2023])
    rows = {tuple(r) for r in grid.collect()}
    assert len(rows) == grid.count() == 14
    assert (143, 2022) in rows
    with pytest.raises(ValueError):
        operators.request_grid(ids, "season", [])


def test_union_all_by_name_with_duplicates(spark):
    left = spark.createDataFrame([(1, "a")], "n int, s string")
    right = spark.createDataFrame([("a", 1), ("b", 2)], "s string, n int")
    rows = operators.union_all([left, right, left])
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "a")] * 3 + [(2, "b")]
    with pytest.raises(ValueError):
        operators.union_all([])


@pytest.mark.parametrize("count", [1, 2, 3, 7, 300])
def test_union_all_of_many_slices(spark, count):
    slices = [spark.range(i, i + 1) for i in range(count)]
    assert sorted(column(operators.union_all(slices))) == list(range(count))


def test_limits(spark):
    df = spark.range(100).withColumn("name", F.concat(F.lit("f"), F.col("id").cast("string")))
    assert column(operators.first_n(df, 5, F.desc("id"))) == [99, 98, 97, 96, 95]
    assert column(operators.first_match(df, F.col("name").startswith("f4"), "id")) == [4]
    assert operators.first_match(df, F.col("name") == "none", "id").count() == 0


def test_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert column(operators.row_count(df)) == [3]
    counts = {r.k: r.row_count for r in operators.count_by_key(df, "k").collect()}
    assert counts == {"a": 2, None: 1}
    assert column(operators.row_count(df.filter("k = 'z'"))) == [0]


def test_id_range_and_literals(spark):
    assert column(sources.id_range(spark, 10)) == list(range(10))
    assert sources.literal_rows(spark, [], "a string").schema.simpleString() == "struct<a:string>"
