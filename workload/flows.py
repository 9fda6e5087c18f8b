from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom import sinks, sources
from layerloom.plans import (
    CleanRules,
    LayerFlow,
    MetricRules,
    bronze,
    export_by_key,
    gold,
    run,
    silver,
    store_responses,
    stored_elements,
    stored_rejects,
)
from layerloom.workspace import new_run_dir
from workload.registry import fresh_config, query, table
from workload.sources import ELEMENT, landed_responses

ORDERS = LayerFlow(
    source_system="sample_system",
    raw_table="orders_raw",
    clean_table="orders_clean",
    metric_table="order_priority_metrics",
    clean=CleanRules(
        status="o_orderstatus",
        kept_status="F",
        text="o_orderpriority",
        pattern="-(.+)",
        captured_as="priority",
        date="o_orderdate",
        date_format="yyyy-MM-dd",
        output=(
            "o_orderkey",
            "o_custkey",
            "o_orderpriority",
            "priority",
            "o_orderdate",
            "ingestion_timestamp",
            "processed_timestamp",
        ),
    ),
    metrics=MetricRules(
        key="priority",
        count_name="order_count",
        latest_of="o_orderdate",
        latest_name="latest_order",
    ),
)

GOLD_SQL = """select regexp_extract(o_orderpriority, '-(.+)', 1) as priority,
                     count(*) as order_count,
                     max(cast(o_orderdate as date)) as latest_order,
                     true as dated_today
              from orders where o_orderstatus = 'F' group by 1"""


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as they would arrive: dates are text."""
    orders = table(spark, sf_dir, "orders")
    return orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query(
    """select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
              strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, o_orderpriority,
              'sample_system' as source_system
       from orders"""
)
def layer_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = fresh_config(spark, "layer_bronze")
    rows = bronze(raw_orders(spark, sf_dir), ORDERS.source_system)
    sinks.write_layer(rows, config, "bronze", ORDERS.raw_table)
    stored = sources.read_layer(spark, config, "bronze", ORDERS.raw_table, rows.schema)
    return stored.drop("ingestion_timestamp")


@query(
    """select o_orderkey, o_custkey, o_orderpriority,
              regexp_extract(o_orderpriority, '-(.+)', 1) as priority,
              cast(o_orderdate as date) as o_orderdate
       from orders where o_orderstatus = 'F'"""
)
def layer_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bronze(raw_orders(spark, sf_dir), ORDERS.source_system)
    return silver(rows, ORDERS.clean).drop("ingestion_timestamp", "processed_timestamp")


@query(GOLD_SQL)
def layer_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bronze(raw_orders(spark, sf_dir), ORDERS.source_system)
    return checked_date(gold(silver(rows, ORDERS.clean), ORDERS.metrics))


def checked_date(metrics: DataFrame) -> DataFrame:
    """Whether the report's date is today's, in place of a date that changes by the day."""
    today = F.col("report_date") == F.to_date(F.current_timestamp())
    return metrics.withColumn("dated_today", today).drop("report_date")


@query(GOLD_SQL)
def layers_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = fresh_config(spark, "layers_end_to_end")
    return checked_date(run(raw_orders(spark, sf_dir), config, ORDERS))


@query(
    """select lang, doc_id as id, unnest(range(len(lines))) as position, unnest(lines) as line
       from (select lang, doc_id, string_split(text, chr(10)) as lines from documents)"""
)
def responses_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = fresh_config(spark, "responses_to_bronze")
    schema = store_responses(landed_responses(spark, sf_dir), config, "lines", element=ELEMENT)
    rows = stored_elements(spark, config, "lines", schema)
    return rows.select("lang", "element.league.id", "element.position", "element.line")


@query("select 'html' as lang, html as rejected_body from pages")
def responses_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = fresh_config(spark, "responses_rejected")
    schema = store_responses(landed_responses(spark, sf_dir), config, "lines", element=ELEMENT)
    return stored_rejects(spark, config, "lines", schema)


@query(
    """select lang, doc_id as id, unnest(range(len(lines))) as position, unnest(lines) as line
       from (select lang, doc_id, string_split(text, chr(10)) as lines from documents)"""
)
def responses_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole second flow: land, unpack, store, then export per key in one pass."""
    config = fresh_config(spark, "responses_fanout")
    schema = store_responses(landed_responses(spark, sf_dir), config, "lines", element=ELEMENT)
    rows = stored_elements(spark, config, "lines", schema)
    keyed = rows.withColumn("element", F.col("element").withField("lang", F.col("lang")))
    path = export_by_key(keyed, config, "lines_by_lang", "lang", "lang")
    stored = sources.read_by_key(spark, path, f"{ELEMENT}, lang string")
    return stored.select("lang", "league.id", "position", "line")


#: Ids of documents that every test table has.
LISTED_LEAGUES = [7, 42, 101, 150, 199]


@query(
    f"""select doc_id as league_id, count(*) as element_count, max(length(line)) as longest
        from (select doc_id, unnest(string_split(text, chr(10))) as line from documents
              where doc_id in ({", ".join(map(str, LISTED_LEAGUES))}))
        group by 1"""
)
def responses_fanout_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export of the listed leagues only, by the key inside the elements, and its counts."""
    config = fresh_config(spark, "responses_fanout_listed")
    schema = store_responses(landed_responses(spark, sf_dir), config, "lines", element=ELEMENT)
    rows = stored_elements(spark, config, "lines", schema)
    path = export_by_key(rows, config, "lines_by_league", "league.id", "league_id", LISTED_LEAGUES)
    stored = sources.read_by_key(spark, path, f"{ELEMENT}, league_id bigint")
    return stored.groupBy("league_id").agg(
        F.count("*").alias("element_count"), F.max(F.length("line")).alias("longest")
    )


@query(
    """select lang, doc_id as id, unnest(range(len(lines))) as position, unnest(lines) as line
       from (select lang, doc_id, string_split(text, chr(10)) as lines from documents)"""
)
def responses_to_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All requests' elements in one JSON array dataset, beside the request's parameter."""
    rows = sources.accepted(landed_responses(spark, sf_dir), element=ELEMENT)
    flat = rows.select("lang", "element.*")
    path = sinks.write_json_array(flat, new_run_dir(spark, "responses_to_json_array"))
    stored = sources.read_json_array(spark, path, flat.schema)
    return stored.select("lang", "league.id", "position", "line")
