"""Tables that are replaced as a whole, so that a reader sees all of the old rows or all of the new.

A replaced table keeps each version in a directory of its own, below ``_versions``. A version
counts once a file that names it stands in ``_versions/_commits``; to make that empty file is
one step on every file system. The file's name begins with the number of the commit, and
readers take the last. Of writers that commit at the same time one comes last, as if they had
written one after the other. A write that fails leaves no such file, and so changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from layerloom import storage

#: Versions that stay, so that who has opened the one before can read on.
KEPT = 2

_VERSIONS = "_versions"
_COMMITS = f"{_VERSIONS}/_commits"


def current(spark: SparkSession, path: str) -> str | None:
    """Where the table's rows are now, or none if it was never replaced."""
    committed = _committed(spark, path)
    return f"{path}/{_VERSIONS}/{_version(committed[-1])}" if committed else None


def readable(spark: SparkSession, path: str) -> str:
    """Where to read the table: its current version, or the path itself.

    Of a table whose first version failed there is nothing to read. Its version that never
    was is a missing path, as that of any table that is not there.
    """
    now = current(spark, path)
    if now is None and {entry.name for entry in storage.children(spark, path)} == {_VERSIONS}:
        return f"{path}/{_COMMITS}/none"
    return now or path


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(_committed(spark, path))


def new_version(path: str) -> str:
    """A directory for the rows of the next version, which no reader knows of."""
    return f"{path}/{_VERSIONS}/{uuid.uuid4().hex}"


def commit(spark: SparkSession, path: str, version: str, kept: int = KEPT) -> None:
    """Make a written version the current one, and let go of those before the last ones."""
    committed = _committed(spark, path)
    number = int(committed[-1].split(".")[0]) + 1 if committed else 1
    name = f"{number:019d}.{version.rsplit('/', 1)[1]}"
    storage.touch(spark, f"{path}/{_COMMITS}/{name}")
    for old in [*committed, name][:-kept]:
        storage.remove(spark, f"{path}/{_COMMITS}/{old}")
        storage.remove(spark, f"{path}/{_VERSIONS}/{_version(old)}")


def _version(committed: str) -> str:
    return committed.split(".")[1]


def _committed(spark: SparkSession, path: str) -> list[str]:
    entries = storage.children(spark, f"{path}/{_COMMITS}")
    return sorted(entry.name for entry in entries if entry.name[:1].isdigit())
