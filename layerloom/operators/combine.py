from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def request_grid(ids: DataFrame, name: str, values: Sequence[Any]) -> DataFrame:
    """Every row of ``ids`` with every one of the few ``values`` (the seasons to ask for).

    The values are parameters, so each row expands in place: no join and no shuffle.
    """
    if not values:
        raise ValueError("values must not be empty")
    return ids.select("*", F.explode(F.array(*(F.lit(v) for v in values))).alias(name))


def union_all(slices: Sequence[DataFrame]) -> DataFrame:
    """All rows of all slices, matched by column name; duplicates stay.

    Slices are joined in pairs, so that the plan of many slices stays shallow.
    """
    if not slices:
        raise ValueError("slices must not be empty")
    level = list(slices)
    while len(level) > 1:
        pairs = zip(level[::2], level[1::2])
        odd = level[-1:] if len(level) % 2 else []
        level = [left.unionByName(right) for left, right in pairs] + odd
    return level[0]
