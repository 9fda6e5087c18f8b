from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerloom.fixed_values import WHITESPACE


def captured(value: Column | str, pattern: str, group: int = 1) -> Column:
    """Capture group of the first match; ``''`` without a match, null for null."""
    return F.regexp_extract(value, pattern, group)


def stripped(value: Column | str) -> Column:
    """Both ends freed of all Unicode white space (Spark's plain ``trim`` takes spaces only)."""
    return F.trim(value, F.lit(WHITESPACE))


def is_blank(value: Column | str) -> Column:
    return stripped(value) == ""
