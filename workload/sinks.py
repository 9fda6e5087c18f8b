from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom import functions, sinks, sources
from layerloom.functions import json_text
from layerloom.operators import count_by_key, where_equal
from layerloom.workspace import new_run_dir
from workload.registry import fresh_config, query, table


@query("select * from lineitem")
def write_layer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    config = fresh_config(spark, "write_layer_roundtrip")
    sinks.write_layer(lines, config, "silver", "lineitem")
    return sources.read_layer(spark, config, "silver", "lineitem", lines.schema)


@query("select * from events")
def write_layer_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    config = fresh_config(spark, "write_layer_partitioned")
    sinks.write_layer(
        events, config, "bronze", "events", partition_by=["event_type"], cluster=False
    )
    return sources.read_layer(spark, config, "bronze", "events", events.schema)


@query("select * from events where event_type = 'error'")
def scan_layer_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One partition of a partitioned layer: the others' directories are not read."""
    events = table(spark, sf_dir, "events")
    config = fresh_config(spark, "scan_layer_pruned")
    sinks.write_layer(events, config, "bronze", "events", partition_by=["event_type"])
    stored = sources.read_layer(spark, config, "bronze", "events", events.schema)
    return where_equal(stored, "event_type", "error")


@query("select * from part union all select * from part")
def write_layer_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    config = fresh_config(spark, "write_layer_append")
    for _ in range(2):
        sinks.write_layer(parts, config, "bronze", "part", mode="append")
    return sources.read_layer(spark, config, "bronze", "part", parts.schema)


@query("select * from orders where o_orderstatus = 'O'")
def write_layer_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    config = fresh_config(spark, "write_layer_overwrite")
    for status in ("F", "O"):
        sinks.write_layer(where_equal(orders, "o_orderstatus", status), config, "gold", "orders")
    return sources.read_layer(spark, config, "gold", "orders", orders.schema)


@query("select * from orders where o_orderstatus = 'O'")
def write_layer_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Swapped in one step: all rows of the second write, none of the first."""
    orders = table(spark, sf_dir, "orders")
    config = fresh_config(spark, "write_layer_replace")
    for status in ("F", "O"):
        rows = where_equal(orders, "o_orderstatus", status)
        sinks.write_layer(rows, config, "gold", "orders", mode="replace")
    return sources.read_layer(spark, config, "gold", "orders", orders.schema)


@query(
    """select event_id, user_id, event_type, case when event_type = 'error' then 2 else 1 end as run
       from events"""
)
def write_layer_partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One type of events is run again, twice; the rows of all others stay from the first run."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    config = fresh_config(spark, "write_layer_partition_replace")
    schema = events.withColumn("run", F.lit(1)).schema
    for number, rows in enumerate((events, *[where_equal(events, "event_type", "error")] * 2), start=1):
        sinks.write_layer(
            rows.withColumn("run", F.least(F.lit(number), F.lit(2))),
            config,
            "bronze",
            "events",
            mode="replace_partitions",
            partition_by=["event_type"],
        )
    stored = sources.read_layer(spark, config, "bronze", "events", schema)
    return stored.select("event_id", "user_id", "event_type", "run")


@query("select * from events")
def write_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    path = sinks.write_csv(events, new_run_dir(spark, "write_csv_roundtrip"))
    return sources.read_csv(spark, path, schema=events.schema)


@query("select * from events")
def write_json_array_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    path = sinks.write_json_array(events, new_run_dir(spark, "write_json_array_roundtrip"))
    return sources.read_json_array(spark, path, events.schema)


@query("select * from orders")
def write_json_one_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = sinks.write_json_one_array(orders, new_run_dir(spark, "write_json_one_array"))
    return sources.read_json_one_array(spark, path, orders.schema)


@query("select * from orders")
def write_json_lines_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = sinks.write_json_lines(orders, new_run_dir(spark, "write_json_lines_roundtrip"))
    return sources.read_json_lines(spark, path, orders.schema)


@query("select * from customer")
def write_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    texts = customers.select(json_text(F.struct("*")).alias("value"))
    path = sinks.write_text(texts, new_run_dir(spark, "write_json_roundtrip"))
    return sources.read_json_lines(spark, path, customers.schema)


@query(
    """select source, count(*) as document_count, max(n_chars) as longest
       from documents group by 1"""
)
def write_json_documents_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON document per source."""
    reports = table(spark, sf_dir, "documents").groupBy("source").agg(
        F.count("*").alias("document_count"), F.max("n_chars").alias("longest")
    )
    path = new_run_dir(spark, "write_json_documents_roundtrip")
    sinks.write_json_documents(reports, path)
    return sources.read_json_document(spark, path, reports.schema)


@query(
    """select line, count(*) as line_count
       from (select unnest(string_split(text, chr(10))) as line from documents) group by 1"""
)
def write_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_run_dir(spark, "write_text_roundtrip")
    sinks.write_text(table(spark, sf_dir, "documents"), path, "text")
    lines = sources.read_text_lines(spark, path, lineSep="\n")
    return count_by_key(lines.withColumnRenamed("value", "line"), "line", name="line_count")


@query(
    """select event_type || chr(10) || count(*) || ' events' || chr(10) as value
       from events group by event_type"""
)
def write_text_files_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text file of two lines per event type."""
    counts = count_by_key(table(spark, sf_dir, "events"), "event_type")
    report = F.concat("event_type", F.lit("\n"), F.col("row_count").cast("string"), F.lit(" events"))
    path = new_run_dir(spark, "write_text_files_roundtrip")
    sinks.write_text_files(counts.select(report.alias("report")), path, "report")
    return sources.read_whole_text(spark, path)


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def fanout_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    path = new_run_dir(spark, "fanout_by_key")
    sinks.write_by_key(customers, path, "c_nationkey", "c_nationkey")
    return sources.read_by_key(spark, path, customers.schema)


@query(
    """select l_returnflag, l_orderkey, l_linenumber, l_quantity from lineitem
       where l_returnflag in ('A', 'R')"""
)
def fanout_listed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"
    )
    path = new_run_dir(spark, "fanout_listed_keys")
    sinks.write_by_key(lines, path, "l_returnflag", "l_returnflag", keys=["A", "R"])
    return sources.read_by_key(spark, path, lines.schema)


@query(
    """select page_id, url, regexp_extract(url, '[?](.+)$', 1) as request from pages"""
)
def fanout_capture_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A captured key that is empty for many rows: the files tell it from a null."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", functions.captured("url", "[?](.+)$").alias("request")
    )
    path = new_run_dir(spark, "fanout_capture_key")
    sinks.write_by_key(pages, path, "request", "request_key")
    stored = sources.read_by_key(spark, path, "page_id bigint, url string, request string")
    return stored.select("page_id", "url", "request")


@query("select * from orders")
def fanout_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON array per status; no array is lost or cut when all are read back."""
    orders = table(spark, sf_dir, "orders")
    path = new_run_dir(spark, "fanout_json_array")
    sinks.write_json_arrays_by_key(orders, path, "o_orderstatus", "status")
    return sources.read_json_array(spark, path, orders.schema).select(*orders.columns)
