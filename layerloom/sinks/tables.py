from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from layerloom import storage, versions
from layerloom.config import LayerConfig
from layerloom.functions.json import LOSSLESS_TIME

#: Tasks that share a key where Spark does not split hot keys by itself.
SALTS = 16


def write_layer(
    df: DataFrame,
    config: LayerConfig,
    layer: str,
    table: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    cluster: bool = True,
    format: str | None = None,
) -> str:
    """Store a layered table and return its path. ``mode`` is any Spark save mode, or one of two more.

    Spark's ``overwrite`` deletes the old rows before it writes the new ones. ``replace`` swaps
    them in one step, after all new rows are written: until then readers see the old ones, also
    if the write fails (see :mod:`layerloom.versions`). A table that was replaced once stays of
    that kind: it is read by ``read_layer``, and ``overwrite`` replaces it as well.
    ``replace_partitions`` replaces only the partitions that ``df`` has rows of and leaves the
    files of all others alone, so that a day can be run again. Delta does both by itself.

    With ``partition_by``, rows are first clustered by those columns (see
    :func:`clustered`); ``cluster=False`` saves that shuffle when there are few partitions.
    A directory name cannot tell an empty string from a null, so an empty string in a
    partition column fails the write. ``format`` overrides the configured one for this
    table. A table that holds a stream log of Spark's own file sink is refused, as readers
    would not see what is added beside the log.
    """
    spark, path = df.sparkSession, config.layer_path(layer, table)
    stored_as = format or config.format
    refuse_stream_log(spark, path)
    place, options = path, {}
    if mode == "replace_partitions":
        if not partition_by:
            raise ValueError("replace_partitions needs the partition columns")
        if versions.is_versioned(spark, path):
            raise ValueError(f"{path} is replaced as a whole, which would undo a change of some partitions")
        mode, options = "overwrite", {"partitionOverwriteMode": "dynamic"}
    elif stored_as != "delta":
        now = versions.current(spark, path)
        if mode == "replace" or (mode == "overwrite" and now):
            mode, place = "errorifexists", versions.new_version(path)
        elif now and mode == "append":
            place = now
        elif now:
            place = path  # which exists, so that Spark raises or does nothing, as the mode says
    elif mode == "replace":
        mode = "overwrite"
    if partition_by:
        df = df.withColumns({name: _directory_value(df, name, F.col(name)) for name in partition_by})
        if cluster:
            df = clustered(df, *partition_by)
    writer = df.write.mode(mode).format(stored_as).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    replaces = place != path and mode == "errorifexists"
    try:
        writer.save(place)
    except BaseException:
        if replaces:  # nobody knows of these files
            storage.remove(spark, place)
        raise
    if replaces:
        versions.commit(spark, path, place)
    return path


def write_by_key(
    df: DataFrame,
    path: str,
    key: Column | str,
    name: str,
    keys: Sequence[Any] | None = None,
    format: str = "json",
    mode: str = "overwrite",
    cluster: bool = True,
) -> str:
    """Export each key's rows to a directory of its own, ``<path>/<name>=<key>``.

    All keys are written in one pass. ``keys`` limits the export to those listed, without
    it every key is exported. Rows are clustered by key first (see :func:`clustered`);
    ``cluster=False`` saves that shuffle, but then each task writes to every directory.

    ``key`` may be a nested field (``league.id``) or an expression. The files keep all
    columns, and the directory repeats the key as ``name``, which must be a new column.
    Only a key that is the column ``name`` itself moves from the files to the directory; an
    empty string, which a directory cannot tell from a null, then fails the export.
    """
    keyed = with_key(df, key, name, keys)
    if cluster:
        keyed = clustered(keyed, name)
    keyed.write.mode(mode).options(**LOSSLESS_TIME).partitionBy(name).format(format).save(path)
    return path


def with_key(df: DataFrame, key: Column | str, name: str, keys: Sequence[Any] | None) -> DataFrame:
    """The rows of the listed keys with the key as ``name``."""
    moves = isinstance(key, str) and key == name
    if name in df.columns and not moves:
        raise ValueError(f"{name!r} is a column already: give the directories another name")
    value = F.col(key) if isinstance(key, str) else key
    if keys is not None:
        df = df.filter(value.isin(list(keys)))
    return df.withColumn(name, _directory_value(df, name, value) if moves else value)


def clustered(df: DataFrame, *columns: str) -> DataFrame:
    """Bring equal values together so that a partitioned write makes few, well-sized files.

    The rebalance is sized at run time: small keys share a task, and a key with far more
    rows than the others is split over many tasks. Where adaptive execution or its split of
    skewed rebalances is switched off, each key goes to up to ``SALTS`` tasks instead, by
    the task its rows come from, so that no task gets a whole hot key.
    """
    setting = lambda name: df.sparkSession.conf.get(name, "true").lower() == "true"
    if setting("spark.sql.adaptive.enabled") and setting(
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled"
    ):
        return df.hint("rebalance", *columns)
    salt = "_layerloom_salt"
    salted = df.withColumn(salt, F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    return salted.repartition(*columns, salt).drop(salt)


def refuse_stream_log(spark: SparkSession, path: str) -> None:
    if storage.exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} was written by Spark's stream file sink, whose log hides other files")


def _directory_value(df: DataFrame, name: str, value: Column) -> Column:
    if name not in df.columns or not isinstance(df.schema[name].dataType, StringType):
        return value
    failure = F.raise_error(F.lit(f"empty string in {name}: its directory would read as null"))
    return F.when(value == "", failure.cast("string")).otherwise(value)
