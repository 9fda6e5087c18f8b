from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom import functions, operators, sources
from layerloom.fixed_values import EMAIL_DOMAIN_PATTERN
from workload.registry import query, table


@query("select doc_id, regexp_extract(text, '@(.+)', 1) as after_at from documents")
def fn_regexp_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    after_at = functions.captured("text", EMAIL_DOMAIN_PATTERN)
    return table(spark, sf_dir, "documents").select("doc_id", after_at.alias("after_at"))


@query(
    """select cast(o_orderdate as date) as order_date, count(*) as order_count,
              count(*) as null_count
       from orders group by 1"""
)
def fn_parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as text parse; other text (the priority) gives null, so it is counted as null."""
    dates = table(spark, sf_dir, "orders").select(
        functions.parsed_date(F.date_format("o_orderdate", "yyyy-MM-dd"), "yyyy-MM-dd").alias(
            "order_date"
        ),
        functions.parsed_date("o_orderpriority", "yyyy-MM-dd").alias("no_date"),
    )
    return dates.groupBy("order_date").agg(
        F.count("*").alias("order_count"),
        F.count_if(F.col("no_date").isNull()).alias("null_count"),
    )


@query(
    """select event_type, true as is_today, count(*) as row_count
       from events group by 1"""
)
def fn_report_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = operators.count_by_key(table(spark, sf_dir, "events"), "event_type")
    dated = counts.withColumn("report_date", F.current_date())
    is_today = F.col("report_date") == F.to_date(F.current_timestamp())
    return dated.select("event_type", is_today.alias("is_today"), "row_count")


@query(
    """select event_id, cast(props->>'$.k' as bigint) as k, 0 as missing
       from events"""
)
def fn_json_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        functions.json_field("props", "$.k", "bigint").alias("k"),
        functions.json_field("props", "$.results", "int", default=0).alias("missing"),
    )


@query("select * from lineitem")
def fn_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    bodies = lines.select(functions.json_text(F.struct("*")).alias("body"))
    return sources.records_from_json(bodies, "body", lines.schema)


@query("select doc_id, unnest(string_split(text, chr(10))) as line from documents")
def fn_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return operators.exploded(documents, F.split("text", "\n"), "line").select("doc_id", "line")


@query(
    """select word, count(*) as word_count
       from (select unnest(flatten(list_transform(string_split(text, chr(10)),
                                                  lambda line: string_split(line, ' ')))) as word
             from documents)
       group by 1"""
)
def fn_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    words_by_line = F.transform(F.split("text", "\n"), lambda line: F.split(line, " "))
    documents = table(spark, sf_dir, "documents")
    words = operators.exploded(documents, functions.flattened(words_by_line, null_parts=False), "word")
    return operators.count_by_key(words, "word", name="word_count")


@query(
    """select doc_id,
              trim(chr(9) || ' ' || text || chr(10) || chr(160), chr(9) || chr(10) || ' ' || chr(160))
                  as text
       from documents"""
)
def fn_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("\t "), "text", F.lit("\n\xa0"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", functions.stripped(padded).alias("text")
    )
