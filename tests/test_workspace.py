from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

from layerloom import workspace

ROOT = Path(__file__).resolve().parent.parent


class FakeConf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, name, default=None):
        return self.values.get(name, default)


class FakeSession:
    def __init__(self, **values):
        self.conf = FakeConf({k.replace("_", "."): v for k, v in values.items()})


def test_session_setting_wins():
    session = FakeSession(spark_checkpoint_dir="hdfs://shared/work/", spark_master="yarn")
    assert workspace.shared_dir(session) == "hdfs://shared/work"
    first, second = (workspace.new_run_dir(session, "job") for _ in range(2))
    assert first != second
    assert first.startswith("hdfs://shared/work/layerloom/job-")


def test_a_run_can_be_released_as_a_whole(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    with workspace.run_folder(spark, "run") as folder:
        with workspace.run_folder(spark, "step") as inner:
            spark.range(3).write.parquet(workspace.new_run_dir(spark, "a"))
        rows = spark.range(5).write.parquet(workspace.new_run_dir(spark, "b"))
    assert rows is None and inner.startswith(f"{folder}/step-")
    assert not workspace.new_run_dir(spark, "c").startswith(folder)
    assert workspace.release(spark, inner) and workspace.release(spark, folder)
    assert not workspace.release(spark, folder)
    assert spark.conf.get("spark.checkpoint.dir", None) == before


def test_cluster_without_setting_is_an_error():
    with pytest.raises(RuntimeError):
        workspace.shared_dir(FakeSession(spark_master="yarn"))


def test_local_folder_on_a_cluster_is_an_error():
    session = FakeSession(spark_checkpoint_dir="file:///tmp/work", spark_master="yarn")
    with pytest.raises(RuntimeError):
        workspace.shared_dir(session)


def test_release_removes_a_run_and_nothing_else(spark):
    path = workspace.new_run_dir(spark, "job")
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError):
        workspace.release(spark, workspace.shared_dir(spark))
    with pytest.raises(ValueError):
        workspace.release(spark, f"{path}/../../other")
    assert workspace.release(spark, path)
    assert not Path(path).exists()
    assert not workspace.release(spark, path)


def test_local_mode_makes_its_own_once():
    session = FakeSession(spark_master="local[2]")
    assert workspace.shared_dir(session) == workspace.shared_dir(session)


def test_real_local_session_without_setting(tmp_path):
    program = """
from pyspark.sql import SparkSession
from layerloom import workspace
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
path = workspace.new_run_dir(spark, "job")
spark.range(3).write.parquet(path)
print(spark.read.parquet(path).count(), workspace.shared_dir(spark))
"""
    environment = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(ROOT)}
    done = subprocess.run(
        [sys.executable, "-c", program], capture_output=True, text=True, env=environment, timeout=120
    )
    assert done.returncode == 0, done.stderr
    assert done.stdout.split()[0] == "3"
    assert "layerloom-" in done.stdout
