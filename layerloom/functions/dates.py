from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed_date(value: Column | str, fmt: str) -> Column:
    """Date read by ``fmt``; null where the text is not such a date, also in ANSI mode."""
    return F.try_to_date(value, fmt)
