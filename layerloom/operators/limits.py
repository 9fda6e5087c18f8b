"""First-row operators. Spark keeps only the best rows of every task, never a full sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def first_n(df: DataFrame, n: int, *order_by: Column | str) -> DataFrame:
    """The first ``n`` rows in the given order, which has to be total to be repeatable."""
    return df.orderBy(*order_by).limit(n)


def first_match(df: DataFrame, condition: Column, *order_by: Column | str) -> DataFrame:
    """The first row that meets ``condition``; no row when none does."""
    return first_n(df.filter(condition), 1, *order_by)
