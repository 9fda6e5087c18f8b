from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom import operators, sinks, sources
from workload.registry import fresh_config, query, table


@query("select c_custkey, c_name, lower(c_mktsegment) as c_mktsegment from customer")
def project_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return customers.withColumn("c_mktsegment", F.lower("c_mktsegment"))


@query("select l_shipdate, l_orderkey, l_linenumber from lineitem")
def project_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber")


def nested_orders(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Orders stored with a nested ``customer`` struct."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.struct(F.col("o_custkey").alias("id"), "o_orderpriority").alias("customer"),
    )
    config = fresh_config(spark, name)
    sinks.write_layer(orders, config, "bronze", "orders")
    return sources.read_layer(spark, config, "bronze", "orders", orders.schema)


@query("select o_custkey as id from orders")
def project_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.nested_fields(nested_orders(spark, sf_dir, "project_nested"), "customer.id")


@query("select o_orderkey, o_custkey as id from orders where o_custkey = 77")
def filter_nested_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = nested_orders(spark, sf_dir, "filter_nested_eq")
    return operators.where_equal(stored, "customer.id", 77).select("o_orderkey", "customer.id")


@query("select *, 'sample_system' as source_system, true as stamped from orders")
def add_ingest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = operators.add_ingest_metadata(table(spark, sf_dir, "orders"), "sample_system")
    on_time = F.col("ingestion_timestamp") == F.current_timestamp()
    return stamped.withColumn("stamped", on_time).drop("ingestion_timestamp")


@query("select * from orders where o_orderstatus = 'F'")
def filter_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.where_equal(table(spark, sf_dir, "orders"), "o_orderstatus", "F")


@query(
    """select line, count(*) as line_count
       from (select unnest(string_split(text, chr(10))) as line from conversations)
       where trim(line) <> '' group by 1"""
)
def filter_nonblank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "conversations").select(
        F.explode(F.split("text", "\n")).alias("line")
    )
    return operators.count_by_key(operators.non_blank(lines, "line"), "line", name="line_count")


@query("select * from part where p_name like 'red%' and p_name like '%widget'")
def filter_prefix_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.named_like(table(spark, sf_dir, "part"), "p_name", "red", "widget")


@query(
    """select c_custkey as league_id, season
       from customer cross join (values (2022), (2023)) as s(season)"""
)
def request_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("league_id"))
    return operators.request_grid(ids, "season", [2022, 2023])


@query("select * from orders")
def union_all_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two listed slices and all the rest make the whole table again."""
    orders = table(spark, sf_dir, "orders")
    listed = ("O", "F")
    slices = [operators.where_equal(orders, "o_orderstatus", status) for status in listed]
    others = ~F.coalesce(F.col("o_orderstatus").isin(*listed), F.lit(False))
    return operators.union_all([*slices, orders.filter(others)])


@query("select * from lineitem union all select * from lineitem")
def union_all_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return operators.union_all([lines, lines])


@query("select * from orders order by o_orderkey limit 5")
def limit_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.first_n(table(spark, sf_dir, "orders"), 5, "o_orderkey")


@query("select * from part where p_name like 'red%' order by p_partkey limit 1")
def limit_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return operators.first_match(parts, F.col("p_name").startswith("red"), "p_partkey")
