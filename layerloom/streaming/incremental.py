from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from layerloom import storage, versions
from layerloom.config import LayerConfig
from layerloom.sinks.tables import refuse_stream_log

#: Older than any file, so that a file's age never decides whether it is read.
ANY_AGE = "36500d"

_JOB = re.compile(r"[A-Za-z0-9._-]+")


def new_files(
    spark: SparkSession,
    config: LayerConfig,
    layer: str,
    table: str,
    schema: StructType,
    max_files_per_batch: int | None = None,
    max_file_age: str = ANY_AGE,
) -> DataFrame:
    """A layered table as a stream: each run takes the files added since the last one.

    The table must only grow by appended files; one that is replaced as a whole is refused. ``max_files_per_batch`` bounds a batch; a
    run then works through all new files in several batches, one after another.

    ``max_file_age`` drops nothing by default, so files that arrive with old modification
    times (backfills, copies that keep them) are read. In return the job remembers each
    file it has seen, an entry on the driver and in the checkpoint. Where files never come
    late, a shorter age, counted back from the newest file, bounds that state; so does one
    job per dated landing folder. ``append_unread`` keeps its list in storage instead.
    """
    path = config.layer_path(layer, table)
    refuse_versions(spark, path)
    reader = spark.readStream.format(config.format)
    if config.format != "delta":
        reader = reader.schema(schema).option("maxFileAge", max_file_age)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.load(path)


def append_new(
    stream: DataFrame,
    config: LayerConfig,
    layer: str,
    table: str,
    job: str,
    partition_by: Sequence[str] = (),
) -> str:
    """Append everything new to a layered table, wait for the end, and return its path.

    Progress is kept in the job's checkpoint, so each input file counts exactly once, also
    when a run fails half-way and is started again. A failure is raised.

    The table stays a plain one that batch writers may append to or overwrite: there is no
    stream log beside it. A batch's files carry the checkpoint's id and the batch number
    in their names, and a batch that is run again first removes what it left before.
    """
    path, checkpoint = config.layer_path(layer, table), config.checkpoint_path(checked_job(job))
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if config.format == "delta":
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.format("delta").outputMode("append").start(path).awaitTermination()
        return path
    refuse_stream_log(stream.sparkSession, path)
    refuse_versions(stream.sparkSession, path)

    def append(batch: DataFrame, number: int) -> None:
        name = f"part-{checkpoint_id(batch.sparkSession, checkpoint)}-{number:09d}"
        append_batch(batch, path, name, config.format, partition_by)

    writer.foreachBatch(append).start().awaitTermination()
    return path


def append_batch(
    batch: DataFrame, path: str, name: str, format: str, partition_by: Sequence[str]
) -> None:
    """Append files whose names begin with ``name``, in place of any that a run before left."""
    levels = "*/" * len(partition_by)
    storage.remove_matching(batch.sparkSession, f"{path}/{levels}{name}-*")
    files = batch.write.mode("append").format(format)
    files.option("mapreduce.output.basename", name).partitionBy(*partition_by).save(path)


def checked_job(job: str) -> str:
    if not _JOB.fullmatch(job):
        raise ValueError(f"job {job!r} may hold letters, digits, '.', '_' and '-' only")
    return job


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the checkpoint: a new checkpoint never touches an old one's files."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def refuse_versions(spark: SparkSession, path: str) -> None:
    if versions.is_versioned(spark, path):
        raise ValueError(f"{path} is replaced as a whole, and no stream can follow or extend that")
