"""What Spark makes of the queries: pushed filters, pruned columns, shuffles, skew."""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import workload
from __spark_entry__ import queries
from layerloom import operators, sinks, sources
from layerloom.plans import gold, silver
from workload.flows import ORDERS, raw_orders
from workload.sources import ELEMENT


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def explained(spark, sf_dir):
    # Long plan fields would otherwise be cut in the text.
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    yield lambda name: plan(queries()[name](spark, sf_dir))
    spark.conf.set("spark.sql.maxMetadataStringLength", before)


def test_equality_filter_reaches_the_scan(explained):
    assert "EqualTo(o_orderstatus,F)" in explained("filter_eq")


def test_silver_is_narrow_filtered_at_the_scan_and_pruned(explained):
    text = explained("layer_silver")
    assert "EqualTo(o_orderstatus,F)" in text
    assert "o_totalprice" not in text
    assert "Exchange" not in text


def test_subset_reads_only_its_columns(explained):
    read = re.search(r"ReadSchema: struct<(.*)>", explained("project_subset")).group(1)
    assert {field.split(":")[0] for field in read.split(",")} == {
        "l_shipdate",
        "l_orderkey",
        "l_linenumber",
    }


def test_nested_field_is_pruned_and_its_filter_pushed(explained):
    assert "ReadSchema: struct<customer:struct<id:bigint>>" in explained("project_nested")
    text = explained("filter_nested_eq")
    assert "EqualTo(customer.id,77)" in text
    assert "o_totalprice" not in text


def test_name_filters_reach_the_scan(explained):
    text = explained("filter_prefix_suffix")
    assert "StringStartsWith(p_name,red)" in text
    assert "StringEndsWith(p_name,widget)" in text


def test_count_reads_no_column(explained):
    assert "ReadSchema: struct<>" in explained("count_rows")


def test_partition_filter_prunes_directories(explained):
    text = explained("scan_layer_pruned")
    assert re.search(r"PartitionFilters: \[.*event_type.* = error", text)


def test_outcome_filter_prunes_directories(explained):
    text = explained("responses_to_bronze")
    assert re.search(r"PartitionFilters: \[.*outcome.* = accepted", text)


def test_gold_combines_before_its_one_shuffle(spark, sf_dir):
    text = plan(gold(silver(with_stamp(raw_orders(spark, sf_dir)), ORDERS.clean), ORDERS.metrics))
    assert text.count("Exchange") == 1
    assert text.index("HashAggregate") < text.index("Exchange") < text.rindex("HashAggregate")
    assert "partial_count(1)" in text


def with_stamp(raw):
    return operators.add_ingest_metadata(raw, "sample_system")


@pytest.mark.parametrize("name", ["limit_first_n", "limit_first_match"])
def test_limits_are_top_k(explained, name):
    text = explained(name)
    assert "TakeOrderedAndProject" in text
    assert "Exchange rangepartitioning" not in text


@pytest.mark.parametrize(
    "name", ["request_grid", "union_all_slices", "ingest_envelope", "fn_explode", "add_ingest_metadata"]
)
def test_narrow_queries_do_not_shuffle(explained, name):
    assert "Exchange" not in explained(name)


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_no_join_of_all_pairs_and_no_row_python(explained, name):
    text = explained(name)
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "PythonUDF"):
        assert forbidden not in text


@pytest.mark.parametrize("element", [None, ELEMENT])
@pytest.mark.parametrize("side", [sources.accepted, sources.rejected, sources.opened])
def test_bodies_are_parsed_once(spark, tmp_path, side, element):
    spark.createDataFrame([(1, "{}")], "r int, body string").write.parquet(str(tmp_path / "b"))
    landed = spark.read.parquet(str(tmp_path / "b"))
    text = plan(side(landed, element=element))
    executed = text.replace("DataFilters: [", "DataFilters: \0").split("\0")[0]
    assert executed.count("from_json(") == 1


def test_inventory_reads_no_content(spark, tmp_path):
    (tmp_path / "part-0.txt").write_text("x")
    assert "content" not in plan(sources.file_inventory(spark, str(tmp_path)))


@pytest.fixture
def skewed(spark):
    """60,000 rows, a third of them with one key."""
    return spark.range(0, 60_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40 + 1).alias("k"),
        F.col("id").alias("n"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )


@pytest.fixture
def small_targets(spark):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def files_per_key(path):
    found = Path(path).rglob("part-*")
    return Counter(p.parent.name for p in found if p.suffix != ".crc")


def test_hot_key_is_split_over_tasks_and_kept_whole(spark, skewed, small_targets, tmp_path):
    path = sinks.write_by_key(skewed, str(tmp_path / "out"), "k", "k")
    files = files_per_key(path)
    assert files["k=0"] > 3
    assert sum(files.values()) < 16 * 41
    back = sources.read_by_key(spark, path, "n bigint, text string, k bigint")
    counts = {r.k: r.row_count for r in operators.count_by_key(back, "k").collect()}
    assert counts == {r.k: r.row_count for r in operators.count_by_key(skewed, "k").collect()}
    assert counts[0] == 20_000


@pytest.mark.parametrize("listed", [16, 17])
def test_listed_keys_are_clustered_whatever_their_number(spark, skewed, tmp_path, listed):
    keys = list(range(listed))
    path = sinks.write_by_key(skewed, str(tmp_path / "out"), "k", "k", keys=keys)
    assert sum(files_per_key(path).values()) <= 2 * listed
    back = sources.read_by_key(spark, path, "n bigint, text string, k bigint")
    assert back.count() == skewed.filter(F.col("k").isin(keys)).count()
    assert "REBALANCE" in plan(sinks.tables.clustered(skewed, "k")).upper()


def test_unclustered_keys_are_written_without_a_shuffle(spark, skewed, tmp_path):
    path = sinks.write_by_key(skewed, str(tmp_path / "out"), "k", "k", keys=[0, 1], cluster=False)
    assert files_per_key(path)["k=0"] == 16


def test_hot_partition_of_a_layer_is_split(spark, skewed, small_targets, config):
    path = sinks.write_layer(skewed, config, "bronze", "t", partition_by=["k"])
    assert files_per_key(path)["k=0"] > 1
    assert sources.read_layer(spark, config, "bronze", "t", skewed.schema).count() == 60_000


SPLITS_HOT_KEYS = ["spark.sql.adaptive.enabled", "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled"]


@pytest.mark.parametrize("setting", SPLITS_HOT_KEYS)
def test_where_spark_splits_no_key_no_task_gets_a_whole_one(spark, skewed, tmp_path, setting):
    spark.conf.set(setting, "false")
    try:
        assert "salt" in plan(sinks.tables.clustered(skewed, "k"))
        path = sinks.write_by_key(skewed, str(tmp_path / "out"), "k", "k")
        assert files_per_key(path)["k=0"] > 1
    finally:
        spark.conf.set(setting, "true")
    assert sources.read_by_key(spark, path, "n bigint, text string, k bigint").count() == 60_000


def test_hot_group_sends_one_row_per_task(spark, skewed):
    counts = operators.key_metrics(skewed, "k", "n", "rows", "latest")
    text = plan(counts)
    assert text.count("Exchange") == 1 and "partial_max" in text
    assert {r.k: r.rows for r in counts.collect()}[0] == 20_000
