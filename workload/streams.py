from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom import sinks, sources
from layerloom.operators import where_equal
from layerloom.plans import bronze, silver
from layerloom.streaming import append_new, append_unread, keep_metrics, kept_metrics, new_files
from workload.flows import GOLD_SQL, ORDERS, checked_date, raw_orders
from workload.registry import fresh_config, query, table


@query("select event_id, user_id, event_type from events")
def stream_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    config = fresh_config(spark, "stream_available_now")
    sinks.write_layer(events, config, "bronze", "events")
    stream = new_files(spark, config, "bronze", "events", events.schema)
    rows = stream.select("event_id", "user_id", "event_type")
    append_new(rows, config, "silver", "events", job="events")
    return sources.read_layer(spark, config, "silver", "events", rows.schema)


@query(
    """select o_orderkey, case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as run
       from orders"""
)
def stream_incremental_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files land between runs; each row carries the run that took it, once."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    config = fresh_config(spark, "stream_incremental_runs")
    listed = ("F", "O")
    slices = [where_equal(orders, "o_orderstatus", status) for status in listed]
    slices.append(orders.filter(~F.coalesce(F.col("o_orderstatus").isin(*listed), F.lit(False))))
    for number, slice_of_orders in enumerate(slices, start=1):
        sinks.write_layer(slice_of_orders, config, "bronze", "orders", mode="append")
        stream = new_files(spark, config, "bronze", "orders", orders.schema)
        rows = stream.select("o_orderkey", F.lit(number).alias("run"))
        append_new(rows, config, "silver", "orders", job="orders")
    return sources.read_layer(spark, config, "silver", "orders", rows.schema)


@query(
    """select o_orderkey, o_custkey, o_orderpriority,
              regexp_extract(o_orderpriority, '-(.+)', 1) as priority,
              cast(o_orderdate as date) as o_orderdate
       from orders where o_orderstatus = 'F'"""
)
def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same silver rules as the batch flow, run on new bronze files only."""
    rows = bronze(raw_orders(spark, sf_dir), ORDERS.source_system)
    config = fresh_config(spark, "stream_silver")
    sinks.write_layer(rows, config, "bronze", ORDERS.raw_table)
    stream = new_files(spark, config, "bronze", ORDERS.raw_table, rows.schema)
    clean = silver(stream, ORDERS.clean)
    append_new(clean, config, "silver", ORDERS.clean_table, job="orders_clean")
    stored = sources.read_layer(spark, config, "silver", ORDERS.clean_table, clean.schema)
    return stored.drop("ingestion_timestamp", "processed_timestamp")


@query("select user_id, event_type from events union all select c_custkey, c_mktsegment from customer")
def stream_then_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that a stream and a batch writer fill: readers see the rows of both."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("event_type")
    )
    config = fresh_config(spark, "stream_then_batch")
    sinks.write_layer(events, config, "bronze", "users")
    append_new(
        new_files(spark, config, "bronze", "users", events.schema), config, "silver", "users", job="users"
    )
    sinks.write_layer(customers, config, "silver", "users", mode="append")
    return sources.read_layer(spark, config, "silver", "users", events.schema)


@query(GOLD_SQL)
def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after three runs over what landed between them: the same as of all rows at once."""
    orders = bronze(raw_orders(spark, sf_dir), ORDERS.source_system)
    config = fresh_config(spark, "stream_gold")
    for number in range(3):
        landed = orders.filter(F.col("o_orderkey") % 3 == number)
        sinks.write_layer(landed, config, "bronze", ORDERS.raw_table, mode="append")
        stream = new_files(spark, config, "bronze", ORDERS.raw_table, orders.schema)
        clean = silver(stream, ORDERS.clean)
        keep_metrics(clean, config, ORDERS.metric_table, ORDERS.metrics, job="gold", merged_after=2)
    return checked_date(kept_metrics(spark, config, ORDERS.metric_table, ORDERS.metrics, clean.schema))


@query("select o_orderkey, o_orderstatus, 1 + o_orderkey % 3 as run from orders")
def stream_unread_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files land between runs that list what they read; each row carries the run that took it."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    config = fresh_config(spark, "stream_unread_files")
    source, target = ("bronze", "orders"), ("silver", "orders")
    for number in range(3):
        landed = orders.filter(F.col("o_orderkey") % 3 == number)
        sinks.write_layer(landed, config, *source, mode="append")
        run = F.lit(number + 1).cast("bigint").alias("run")
        append_unread(
            spark, config, source, orders.schema, lambda rows, run=run: rows.select("*", run), target, job="orders"
        )
    return sources.read_layer(spark, config, *target, orders.select("*", run).schema)
