"""Shared working directories for jobs that have to write before they can read."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import SparkSession

from layerloom import storage

SHARED_DIR_SETTING = "spark.checkpoint.dir"
_RUNS = "layerloom"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    A machine-local folder is made only in local mode and only when the session names
    none; on a cluster a missing setting is an error, as a local folder would be lost
    with its executor.
    """
    configured = spark.conf.get(SHARED_DIR_SETTING, None)
    one_machine = spark.conf.get("spark.master", "").startswith("local")
    if configured:
        if configured.startswith("file:") and not one_machine:
            raise RuntimeError(f"{SHARED_DIR_SETTING} is {configured}, a folder of each machine's own")
        return configured.rstrip("/")
    if not one_machine:
        raise RuntimeError(f"set {SHARED_DIR_SETTING} to a folder shared by the cluster")
    return _local_dir()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="layerloom-")


_folder: ContextVar[str | None] = ContextVar("folder", default=None)


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{_folder.get() or f'{shared_dir(spark)}/{_RUNS}'}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """One folder for all that is written within, for the caller to release.

    It is not deleted by itself, as DataFrames that were made within may still read from it.
    """
    folder = new_run_dir(spark, name)
    before = _folder.set(folder)
    try:
        yield folder
    finally:
        _folder.reset(before)


def release(spark: SparkSession, run_dir: str) -> bool:
    """Delete a run's directory once nothing reads it any more; whether it was there."""
    if not run_dir.startswith(f"{shared_dir(spark)}/{_RUNS}/") or ".." in run_dir.split("/"):
        raise ValueError(f"{run_dir} is no run directory of this session")
    return storage.remove(spark, run_dir)
