from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_ingest_metadata(df: DataFrame, source_system: str) -> DataFrame:
    """Stamp rows with the query's time and the system they came from."""
    return df.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp(),
            "source_system": F.lit(source_system),
        }
    )


def nested_fields(df: DataFrame, *paths: str) -> DataFrame:
    """Fields out of structs, each named after its last part (``league.id`` gives ``id``).

    Only the named fields are read from Parquet.
    """
    return df.select(*(F.col(path) for path in paths))


def exploded(df: DataFrame, array: Column | str, name: str) -> DataFrame:
    """One row per array element beside the other columns; empty and null arrays add none.

    Pass an array that has yet to be computed as an expression: exploding a computed column
    by name makes Spark filter on it first, and so compute it more than once.
    """
    kept = [c for c in df.columns if c != array] if isinstance(array, str) else df.columns
    return df.select(*kept, F.explode(array).alias(name))
