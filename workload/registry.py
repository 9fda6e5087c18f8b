from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from layerloom import LayerConfig
from layerloom.workspace import new_run_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that has the same result."""

    def register(function: Query) -> Query:
        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_config(spark: SparkSession, name: str) -> LayerConfig:
    """Layers in a directory of their own. It has to outlive the returned DataFrame."""
    return LayerConfig(new_run_dir(spark, name))
