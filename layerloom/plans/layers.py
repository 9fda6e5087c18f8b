"""Raw rows to bronze, cleaned rows to silver, metrics to gold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.config import LayerConfig
from layerloom.fixed_values import (
    ACTIVE_STATUS,
    CREATED_DATE_FORMAT,
    EMAIL_DOMAIN_PATTERN,
    SAMPLE_SOURCE_SYSTEM,
)
from layerloom.functions import captured, parsed_date
from layerloom.operators import add_ingest_metadata, key_metrics, where_equal
from layerloom.sinks import write_layer
from layerloom.sources import read_layer


@dataclass(frozen=True)
class CleanRules:
    """Which rows silver keeps, what it derives, and its columns in order."""

    status: str
    kept_status: str
    text: str
    pattern: str
    captured_as: str
    date: str
    date_format: str
    output: tuple[str, ...]


@dataclass(frozen=True)
class MetricRules:
    """What gold counts."""

    key: str
    count_name: str
    latest_of: str
    latest_name: str


@dataclass(frozen=True)
class LayerFlow:
    """One subject's way through the layers."""

    source_system: str
    raw_table: str
    clean_table: str
    metric_table: str
    clean: CleanRules
    metrics: MetricRules


# The names of the customer flow's tables and columns.
CUSTOMERS = LayerFlow(
    source_system=SAMPLE_SOURCE_SYSTEM,
    raw_table="customer_raw",
    clean_table="customer_clean",
    metric_table="customer_domain_metrics",
    clean=CleanRules(
        status="status",
        kept_status=ACTIVE_STATUS,
        text="email",
        pattern=EMAIL_DOMAIN_PATTERN,
        captured_as="email_domain",
        date="created_date",
        date_format=CREATED_DATE_FORMAT,
        output=(
            "id",
            "name",
            "email",
            "email_domain",
            "created_date",
            "ingestion_timestamp",
            "processed_timestamp",
        ),
    ),
    metrics=MetricRules(
        key="email_domain",
        count_name="customer_count",
        latest_of="created_date",
        latest_name="latest_registration",
    ),
)


def bronze(raw: DataFrame, source_system: str) -> DataFrame:
    """Raw rows, all of them, with their ingestion metadata."""
    return add_ingest_metadata(raw, source_system)


def silver(rows: DataFrame, rules: CleanRules) -> DataFrame:
    """Kept rows with the captured text, a real date and the time of processing.

    Every step is narrow: no shuffle, and the status filter reaches the scan.
    """
    derived = {
        rules.captured_as: captured(rules.text, rules.pattern),
        rules.date: parsed_date(rules.date, rules.date_format),
        "processed_timestamp": F.current_timestamp(),
    }
    kept = where_equal(rows, rules.status, rules.kept_status)
    return kept.withColumns(derived).select(*rules.output)


def gold(rows: DataFrame, rules: MetricRules) -> DataFrame:
    """Count and latest date per key, with the day of the report."""
    return dated(key_metrics(rows, rules.key, rules.latest_of, rules.count_name, rules.latest_name))


def dated(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("report_date", F.current_date())


def run(raw: DataFrame, config: LayerConfig, flow: LayerFlow) -> DataFrame:
    """Build all three layers and return the stored gold table.

    Each layer is computed once and the next one reads it back, so a lost executor costs
    at most one layer, and what is reported is what was stored. Each table is replaced in one
    step, so a run that fails leaves the old rows of the layers that it did not finish.
    """
    spark = raw.sparkSession
    stages = (
        ("bronze", flow.raw_table, lambda df: bronze(df, flow.source_system)),
        ("silver", flow.clean_table, lambda df: silver(df, flow.clean)),
        ("gold", flow.metric_table, lambda df: gold(df, flow.metrics)),
    )
    rows = raw
    for layer, table, build in stages:
        built = build(rows)
        write_layer(built, config, layer, table, mode="replace")
        rows = read_layer(spark, config, layer, table, built.schema)
    return rows
