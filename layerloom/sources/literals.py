from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def literal_rows(
    spark: SparkSession, rows: Iterable[tuple], schema: StructType | str
) -> DataFrame:
    """Rows written in the program itself; types come from the schema, never from inference."""
    return spark.createDataFrame(list(rows), schema)


def id_range(spark: SparkSession, count: int) -> DataFrame:
    """``id`` 0 to ``count - 1``, made by the executors."""
    return spark.range(count)
