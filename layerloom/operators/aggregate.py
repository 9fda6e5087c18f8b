"""Aggregations. Each is combined in the map tasks first, so a hot key sends one row per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_metrics(
    df: DataFrame, key: str, latest_of: str, count_name: str, latest_name: str
) -> DataFrame:
    """Row count and latest value per key. Null keys and ``''`` are groups of their own."""
    return df.groupBy(key).agg(
        F.count("*").alias(count_name),
        F.max(latest_of).alias(latest_name),
    )


def count_by_key(df: DataFrame, *keys: str, name: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """Number of rows, as a one-row DataFrame."""
    return df.agg(F.count("*").alias(name))
