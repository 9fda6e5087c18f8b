"""Incremental runs that keep the list of read files in storage and not in the driver's memory."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerloom import storage
from layerloom.config import LayerConfig
from layerloom.sinks.tables import refuse_stream_log
from layerloom.sources import file_inventory
from layerloom.streaming.batches import Batches
from layerloom.streaming.incremental import append_batch, checked_job, refuse_versions

#: Files of one batch: so many names are on the driver at a time.
BATCH_FILES = 1000
#: The lists of batches are merged once there are so many.
MERGED_AFTER = 16

_FILES = StructType().add("path", "string")
_OWN = "list-"


def append_unread(
    spark: SparkSession,
    config: LayerConfig,
    source: tuple[str, str],
    schema: StructType,
    made: Callable[[DataFrame], DataFrame],
    target: tuple[str, str],
    job: str,
    partition_by: Sequence[str] = (),
    batch_files: int = BATCH_FILES,
    merged_after: int = MERGED_AFTER,
) -> str:
    """Append ``made`` of all files that were not read yet to a table, and return its path.

    ``source`` and ``target`` are each a layer and a table. What is read is told by a list of
    files, which is stored with the job, and joined in Spark with the files that are there: a
    file's age plays no part, and nothing is remembered between runs but that list. The list is
    merged from time to time, and then forgets the files that are gone from the source, so it
    stays as long as the source has files, and in a level number of directories.

    A batch's files are listed before it is read, and marked as done after it is written. A run
    that fails between the two is taken up again with the very same files: what it left is
    removed first, so each file counts once. Files must not change, and get new names when new.
    """
    if config.format == "delta":
        raise ValueError("a Delta table is more than its files: follow it with new_files")
    (from_layer, from_table), (to_layer, to_table) = source, target
    read_from, path = config.layer_path(from_layer, from_table), config.layer_path(to_layer, to_table)
    for place in (read_from, path):
        refuse_versions(spark, place)
        refuse_stream_log(spark, place)
    state = config.checkpoint_path(checked_job(job))
    planned = Batches(spark, f"{state}/files", _FILES)
    own = _own_id(spark, state)
    number = planned.last()
    while True:
        # The last list that was planned may not have been worked off.
        if number >= 0 and not storage.exists(spark, f"{state}/done-{number:09d}"):
            rows = spark.read.schema(schema).format(config.format).option("basePath", read_from)
            listed = spark.read.schema(_FILES).parquet(f"{state}/files/batch-{number:09d}")
            paths = [storage.literal(row["path"]) for row in listed.collect()]  # at most ``batch_files``
            append_batch(made(rows.load(paths)), path, f"part-{own}-{number:09d}", config.format, partition_by)
            storage.touch(spark, f"{state}/done-{number:09d}")
            storage.remove(spark, f"{state}/done-{number - 1:09d}")
        there = file_inventory(spark, read_from).select("path")
        planned.merge(lambda lists, there=there: lists.join(there, "path", "left_semi"), merged_after)
        unread = there.join(planned.rows(), "path", "left_anti").orderBy("path").limit(batch_files)
        found = unread.collect()
        if not found:
            return path
        number += 1
        planned.add(number, spark.createDataFrame(found, _FILES).coalesce(1))


def _own_id(spark: SparkSession, state: str) -> str:
    """The id in the names of the files that this list's batches write."""
    known = [e.name for e in storage.children(spark, state) if e.name.startswith(_OWN)]
    if not known:
        known = [f"{_OWN}{uuid.uuid4()}"]
        storage.touch(spark, f"{state}/{known[0]}")
    return min(known).removeprefix(_OWN)
