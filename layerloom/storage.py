"""File-system metadata through Hadoop, so that any store Spark can read is reached alike."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import SparkSession


class Entry(NamedTuple):
    name: str
    path: str
    size: int
    is_dir: bool


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _located(spark, path)
    return files.exists(target)


def children(spark: SparkSession, path: str) -> Iterator[Entry]:
    """The direct entries of a directory, hidden ones too; none if it is missing."""
    files, target = _located(spark, path)
    if not files.exists(target):
        return
    for status in files.listStatus(target):
        place, is_dir = status.getPath(), status.isDirectory()
        yield Entry(place.getName(), place.toString(), 0 if is_dir else status.getLen(), is_dir)


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file, in one step, with the directories above it."""
    files, target = _located(spark, path)
    files.create(target, True).close()


def literal(path: str) -> str:
    """The path for a reader that takes patterns, where it shall stand for itself alone."""
    return re.sub(r"([*?{}\[\]\\])", r"\\\1", path)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or a whole directory; whether there was one."""
    files, target = _located(spark, path)
    return files.delete(target, True)


def remove_matching(spark: SparkSession, pattern: str) -> None:
    """Delete the files that match a glob pattern."""
    files, target = _located(spark, pattern)
    for status in files.globStatus(target) or ():
        files.delete(status.getPath(), False)


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target
