"""Gold kept up by a stream: each batch adds its own counts and latest values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerloom import storage
from layerloom.config import LayerConfig
from layerloom.operators import key_metrics
from layerloom.plans import MetricRules, dated
from layerloom.streaming.batches import Batches
from layerloom.streaming.incremental import checkpoint_id, checked_job

#: Batches are merged once there are so many.
MERGED_AFTER = 16


def keep_metrics(
    stream: DataFrame,
    config: LayerConfig,
    table: str,
    rules: MetricRules,
    job: str,
    merged_after: int = MERGED_AFTER,
) -> str:
    """Add the metrics of everything new to a gold table, and return the table's path.

    A batch is counted by itself, with a row per key and task in the one shuffle, and stored
    under its number; no older row is read or written again. Counts add up and maxima
    stay maxima, so the batches merge in any grouping. A batch that runs again, after a failure,
    is known by its number and adds nothing. The numbers are those of the job's checkpoint.
    """
    spark = stream.sparkSession
    path, checkpoint = config.layer_path("gold", table), config.checkpoint_path(checked_job(job))
    schema = _metrics(stream, rules).schema

    def keep(batch: DataFrame, number: int) -> None:
        batches = Batches(spark, f"{path}/{checkpoint_id(spark, checkpoint)}", schema)
        batches.add(number, _metrics(batch, rules))
        batches.merge(lambda rows: _merged(rows, rules), merged_after)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.foreachBatch(keep).start().awaitTermination()
    return path


def kept_metrics(
    spark: SparkSession, config: LayerConfig, table: str, rules: MetricRules, schema: StructType
) -> DataFrame:
    """The gold rows of all batches so far, with the day of the report.

    ``schema`` is that of the rows that were counted.
    """
    path = config.layer_path("gold", table)
    metrics = _metrics(spark.createDataFrame([], schema), rules)
    parts = [
        Batches(spark, entry.path, metrics.schema).rows()
        for entry in storage.children(spark, path)
        if entry.is_dir
    ]
    return dated(_merged(reduce(DataFrame.unionByName, parts, metrics), rules))


def _metrics(rows: DataFrame, rules: MetricRules) -> DataFrame:
    return key_metrics(rows, rules.key, rules.latest_of, rules.count_name, rules.latest_name)


def _merged(metrics: DataFrame, rules: MetricRules) -> DataFrame:
    return metrics.groupBy(rules.key).agg(
        F.sum(rules.count_name).alias(rules.count_name), F.max(rules.latest_name).alias(rules.latest_name)
    )
