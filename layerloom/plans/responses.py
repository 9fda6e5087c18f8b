"""Landed API responses to a bronze table and on to one export per key."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from layerloom.config import LayerConfig
from layerloom.operators import where_equal
from layerloom.sinks import write_by_key, write_layer
from layerloom.sources import opened, read_layer


def store_responses(
    landed: DataFrame,
    config: LayerConfig,
    table: str,
    body: str = "body",
    element: DataType | str | None = None,
) -> StructType:
    """Parse every landed body once and store elements and rejects side by side.

    The bronze table is partitioned by ``outcome``, so that reading one side skips the
    other's files. Returns its schema.
    """
    rows = opened(landed, body, element)
    write_layer(rows, config, "bronze", table, partition_by=["outcome"], cluster=False)
    return rows.schema


def stored_elements(
    spark: SparkSession, config: LayerConfig, table: str, schema: StructType | None = None
) -> DataFrame:
    rows = where_equal(read_layer(spark, config, "bronze", table, schema), "outcome", "accepted")
    return rows.drop("outcome", "rejected_body")


def stored_rejects(
    spark: SparkSession, config: LayerConfig, table: str, schema: StructType | None = None
) -> DataFrame:
    rows = where_equal(read_layer(spark, config, "bronze", table, schema), "outcome", "rejected")
    return rows.drop("outcome", "element")


def export_by_key(
    elements: DataFrame,
    config: LayerConfig,
    table: str,
    key: Column | str,
    name: str,
    keys: Sequence[Any] | None = None,
) -> str:
    """Elements of typed responses as JSON Lines, one directory per key, in one pass."""
    fields = elements.select(F.col("element.*"))
    return write_by_key(fields, config.layer_path("bronze", table), key, name, keys)
