"""Positions of rows within groups, counted in parallel however large a group is."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from layerloom.llm.common import settled


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The rows with ``position``, from 0, and ``size``: their place in their group, and its rows.

    ``group`` holds strings and no null. A range partitioning by the group and the order
    deals a hot group over tasks; each task counts its own rows, and a small table, a row per
    task and group, has what comes before. Rows that are equal in group and order may take
    each other's place.
    """
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    added = [StructField("_part", IntegerType()), StructField("_nth", LongType())]
    schema = StructType([*dealt.schema.fields, *added])
    at = dealt.columns.index(group)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(at).to_pylist()
            starts = np.array([a != b for a, b in zip([last, *names], names, strict=False)])
            index = np.arange(len(names))
            nth = index - np.maximum.accumulate(np.where(starts, index, -1 - seen))
            # Before the first start, the count goes on from the batch before.
            nth = np.where(np.logical_or.accumulate(starts), nth, index + seen)
            last, seen = names[-1], int(nth[-1]) + 1
            columns = [*batch.columns, pa.array(np.full(len(names), part, np.int32)), pa.array(nth)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    ranked = settled(dealt.mapInArrow(counted, schema), "ranked")
    sizes = ranked.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_of")).agg(F.count("*").alias("rows"))
    whole = Window.partitionBy("_group")
    before = whole.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_group",
        "_of",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_before"),
        F.sum("rows").over(whole).alias("size"),
    )
    same = (F.col(group) == F.col("_group")) & (F.col("_part") == F.col("_of"))
    found = ranked.join(settled(offsets, "offsets"), same)
    return found.select(*rows.columns, (F.col("_nth") + F.col("_before")).alias("position"), "size")
