from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from layerloom import storage

_BATCH, _MERGED, _WHOLE = "batch-", "upto-", "_SUCCESS"


class Batches:
    """Rows in numbered batches, of which each counts once, however often it is added.

    A batch is a directory, and counts when its write has ended. From time to time all batches
    are merged into one directory that takes their place, so that their number stays level. A
    batch that is added again, as after a failure, is told by its number: it changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def add(self, number: int, rows: DataFrame) -> None:
        if not self.has(number):
            rows.write.mode("overwrite").parquet(self._place(_BATCH, number))

    def has(self, number: int) -> bool:
        return number <= self._merged() or number in self._numbers(_BATCH)

    def last(self) -> int:
        """The highest number so far, or -1."""
        return max([self._merged(), *self._numbers(_BATCH)])

    def rows(self) -> DataFrame:
        """The rows of all batches, each once, merged or not."""
        places = [self._place(_BATCH, number) for number in self._unmerged()]
        if self._merged() >= 0:
            places.append(self._place(_MERGED, self._merged()))
        if not places:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*places)

    def merge(self, merged: Callable[[DataFrame], DataFrame], after: int = 1) -> None:
        """Put ``merged`` of all rows in place of the batches, once there are ``after`` of them.

        What was merged the time before is deleted now, so that its readers had time to end.
        """
        if len(self._unmerged()) < after:
            return
        before, last = self._merged(), self.last()
        merged(self.rows()).write.mode("overwrite").parquet(self._place(_MERGED, last))
        for kind in (_BATCH, _MERGED):
            for number in self._numbers(kind):
                if number < before or (kind == _BATCH and number == before):
                    storage.remove(self.spark, self._place(kind, number))

    def _unmerged(self) -> list[int]:
        merged = self._merged()
        return [number for number in self._numbers(_BATCH) if number > merged]

    def _merged(self) -> int:
        return max(self._numbers(_MERGED), default=-1)

    def _numbers(self, kind: str) -> list[int]:
        """Of the directories of a kind those that were written to their end."""
        found = [e for e in storage.children(self.spark, self.path) if e.name.startswith(kind)]
        whole = [e for e in found if storage.exists(self.spark, f"{e.path}/{_WHOLE}")]
        return sorted(int(entry.name.removeprefix(kind)) for entry in whole)

    def _place(self, kind: str, number: int) -> str:
        return f"{self.path}/{kind}{number:09d}"
