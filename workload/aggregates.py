from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom import operators
from layerloom.functions import captured
from workload.registry import query, table


@query(
    """select regexp_extract(url, '://([^/]+)', 1) as host, count(*) as page_count,
              max(page_id) as latest_page
       from pages group by 1"""
)
def agg_domain_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").withColumn("host", captured("url", "://([^/]+)"))
    return operators.key_metrics(pages, "host", "page_id", "page_count", "latest_page")


@query(
    """select l_suppkey, count(*) as line_count, max(l_shipdate) as latest_shipment
       from lineitem group by 1"""
)
def agg_key_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return operators.key_metrics(
        lines, "l_suppkey", "l_shipdate", "line_count", "latest_shipment"
    )


@query("select count(*) as row_count from lineitem")
def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.row_count(table(spark, sf_dir, "lineitem"))


@query("select event_type, count(*) as row_count from events group by 1")
def count_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.count_by_key(table(spark, sf_dir, "events"), "event_type")
