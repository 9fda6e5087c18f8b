from __future__ import annotations

from pyspark.sql import DataFrame


def show(df: DataFrame, rows: int = 20) -> None:
    """Print the first rows; only these travel to the driver."""
    df.show(rows, truncate=False)
