from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from layerloom import storage, versions
from layerloom.config import LayerConfig


def read_layer(
    spark: SparkSession,
    config: LayerConfig,
    layer: str,
    table: str,
    schema: StructType | None = None,
    format: str | None = None,
) -> DataFrame:
    """Scan a layered table; a missing one raises Spark's ``PATH_NOT_FOUND``.

    A known ``schema`` saves the footer-reading job of Parquet. Delta keeps its own. A table
    in partition directories needs the schema: Spark would guess the type of a directory's
    value, and read ``01`` as a number. A folder with a Delta log is read as Delta, whatever the
    configured format; ``format`` is for a table stored in another format than both, and to
    read a Delta table as another format is an error, since its folder holds files that the
    table no longer has. Of a table that was replaced, the version is read that is current now;
    it stays readable until it is replaced twice more.
    """
    path = config.layer_path(layer, table)
    stored_as = format or ("delta" if _is_delta(spark, path) else config.format)
    reader = spark.read.format(stored_as)
    if stored_as != "delta":
        if format and _is_delta(spark, path):
            raise ValueError(f"{path} is a Delta table, not {format}")
        path = versions.readable(spark, path)
        names = {entry.name for entry in storage.children(spark, path) if entry.is_dir}
        if schema is not None:
            reader = reader.schema(schema)
        elif any("=" in name for name in names):
            raise ValueError(f"{path} has partition directories: pass its schema")
    return reader.load(path)


def _is_delta(spark: SparkSession, path: str) -> bool:
    return storage.exists(spark, f"{path}/_delta_log")
