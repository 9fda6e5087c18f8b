from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.functions.text import is_blank


def where_equal(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Rows whose column (``league.id`` reaches into structs) equals ``value``; nulls drop."""
    return df.filter(F.col(column) == F.lit(value))


def non_blank(df: DataFrame, column: str = "value") -> DataFrame:
    """Rows whose text is more than white space."""
    return df.filter(~is_blank(column))


def named_like(df: DataFrame, column: str, prefix: str = "", suffix: str = "") -> DataFrame:
    """Rows whose name starts with ``prefix`` and ends with ``suffix``, taken literally."""
    name = F.col(column)
    if prefix:
        df = df.filter(name.startswith(prefix))
    if suffix:
        df = df.filter(name.endswith(suffix))
    return df
