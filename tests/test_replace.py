from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from layerloom import sinks, sources, versions
from layerloom.streaming import append_new, new_files

SCHEMA = "id bigint, part string"


def rows(spark, start, count, part="p"):
    return spark.range(start, start + count, 1, 4).select("id", F.lit(part).alias("part"))


def stored(spark, config):
    return sorted(r.id for r in sources.read_layer(spark, config, "gold", "t", SCHEMA).collect())


def put(df, config, mode="replace", **options):
    return sinks.write_layer(df, config, "gold", "t", mode=mode, **options)


def test_a_failed_replacement_leaves_the_old_rows(spark, config):
    path = put(rows(spark, 0, 10), config)
    failing = rows(spark, 100, 50).withColumn("id", F.when(F.col("id") == 149, F.raise_error("boom").cast("bigint")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="boom"):
        put(failing, config)
    assert stored(spark, config) == list(range(10))
    assert len([d for d in (Path(path) / "_versions").iterdir() if d.name != "_commits"]) == 1


def test_a_failed_first_write_leaves_no_table(spark, config):
    with pytest.raises(Exception, match="boom"):
        put(spark.range(3).select("id", F.raise_error(F.lit("boom")).cast("string").alias("part")), config)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|UNABLE_TO_INFER|does not exist"):
        sources.read_layer(spark, config, "gold", "t", SCHEMA).count()


def test_what_was_written_but_not_committed_is_not_read(spark, config):
    path = put(rows(spark, 0, 5), config)
    rows(spark, 50, 5).write.parquet(versions.new_version(path))
    assert stored(spark, config) == list(range(5))


def test_who_reads_the_version_before_can_go_on(spark, config):
    put(rows(spark, 0, 10), config)
    before = sources.read_layer(spark, config, "gold", "t", SCHEMA)
    put(rows(spark, 10, 3), config)
    assert before.count() == 10 and stored(spark, config) == [10, 11, 12]
    path = put(rows(spark, 20, 1), config)
    assert stored(spark, config) == [20]
    assert len(list((Path(path) / "_versions").iterdir())) == 1 + versions.KEPT


def test_other_modes_on_a_replaced_table(spark, config):
    put(rows(spark, 0, 3), config)
    put(rows(spark, 3, 2), config, mode="append")
    assert stored(spark, config) == [0, 1, 2, 3, 4]
    put(rows(spark, 9, 1), config, mode="overwrite")
    put(rows(spark, 10, 1), config, mode="ignore")
    with pytest.raises(Exception, match="already exists"):
        put(rows(spark, 11, 1), config, mode="error")
    assert stored(spark, config) == [9]
    with pytest.raises(ValueError, match="as a whole"):
        put(rows(spark, 12, 1), config, mode="replace_partitions", partition_by=["part"])


def test_a_plain_table_can_become_a_replaced_one(spark, config):
    put(rows(spark, 0, 3), config, mode="append")
    put(rows(spark, 5, 1), config)
    assert stored(spark, config) == [5]


def test_replaced_partitioned_and_empty(spark, config):
    put(rows(spark, 0, 3, "a").union(rows(spark, 3, 3, "b")), config, partition_by=["part"])
    table = sources.read_layer(spark, config, "gold", "t", SCHEMA)
    assert table.filter("part = 'b'").count() == 3
    put(rows(spark, 0, 0), config)
    assert stored(spark, config) == []


def test_streams_refuse_replaced_tables(spark, config):
    put(rows(spark, 0, 3), config)
    with pytest.raises(ValueError, match="as a whole"):
        new_files(spark, config, "gold", "t", rows(spark, 0, 1).schema)
    sinks.write_layer(rows(spark, 0, 3), config, "bronze", "t")
    stream = new_files(spark, config, "bronze", "t", rows(spark, 0, 1).schema)
    with pytest.raises(ValueError, match="as a whole"):
        append_new(stream, config, "gold", "t", job="t")


def test_only_the_partitions_of_a_run_are_replaced(spark, config):
    put(rows(spark, 0, 30, "a").union(rows(spark, 30, 30, "b")), config, mode="replace_partitions", partition_by=["part"])
    path = Path(config.layer_path("gold", "t"))
    untouched = {file: file.stat().st_mtime_ns for file in path.glob("part=a/*.parquet")}
    for _ in range(2):  # the second run changes nothing
        again = rows(spark, 90, 5, "b").union(rows(spark, 95, 1, "c"))
        put(again, config, mode="replace_partitions", partition_by=["part"])
        assert stored(spark, config) == [*range(30), *range(90, 96)]
    assert untouched and untouched == {file: file.stat().st_mtime_ns for file in path.glob("part=a/*.parquet")}
    put(rows(spark, 0, 0), config, mode="replace_partitions", partition_by=["part"])
    assert len(stored(spark, config)) == 36
    with pytest.raises(ValueError, match="partition columns"):
        put(again, config, mode="replace_partitions")


def test_a_failed_partition_replacement_leaves_the_old_rows(spark, config):
    put(rows(spark, 0, 30, "a"), config, mode="replace_partitions", partition_by=["part"])
    failing = rows(spark, 50, 30, "a").withColumn("id", F.when(F.col("id") == 79, F.raise_error("boom").cast("bigint")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="boom"):
        put(failing, config, mode="replace_partitions", partition_by=["part"], cluster=False)
    assert stored(spark, config) == list(range(30))


def joined(path):
    return json.loads("".join(file.read_text() for file in sorted(Path(path).glob("part-*"))))


@pytest.mark.parametrize("tasks", [1, 7])
def test_the_parts_of_one_array_are_one_array(spark, tmp_path, tasks):
    df = spark.range(0, 500, 1, tasks).select("id", F.when(F.col("id") % 3 > 0, "ü\n[,]").alias("s"))
    path = sinks.write_json_one_array(df, str(tmp_path / "out"))
    want = [{"id": i, **({"s": "ü\n[,]"} if i % 3 else {})} for i in range(500)]
    assert sorted(joined(path), key=lambda r: r["id"]) == want
    assert len(list(Path(path).glob("part-1-*"))) == tasks  # written side by side
    back = sources.read_json_one_array(spark, path, df.schema)
    assert back.exceptAll(df).count() == 0 and back.count() == 500


@pytest.mark.parametrize("kept", ["id < 0", "id = 7", "id in (3, 250)", "id > 490"])
def test_one_array_with_empty_partitions(spark, tmp_path, kept):
    df = spark.range(0, 500, 1, 8).filter(kept)
    path = sinks.write_json_one_array(df, str(tmp_path / "out"))
    assert sorted(row["id"] for row in joined(path)) == sorted(r.id for r in df.collect())
    assert sources.read_json_one_array(spark, path, df.schema).count() == df.count()


def test_one_array_is_replaced_and_never_added_to(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_json_one_array(spark.range(20), path)
    sinks.write_json_one_array(spark.range(3), path)
    assert len(joined(path)) == 3
    with pytest.raises(ValueError, match="added"):
        sinks.write_json_one_array(spark.range(3), path, mode="append")
    with pytest.raises(Exception, match="already exists"):
        sinks.write_json_one_array(spark.range(3), path, mode="error")


def test_one_array_needs_no_shuffle_and_no_single_task(spark, tmp_path, monkeypatch):
    plans = []
    from pyspark.sql import DataFrameWriter

    write = DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, path: (plans.append(self._df._jdf.queryExecution().executedPlan().toString()), write(self, path))[1])
    sinks.write_json_one_array(spark.range(0, 100, 1, 5), str(tmp_path / "out"))
    assert len(plans) == 3 and not any("Exchange" in plan or "Coalesce" in plan for plan in plans)
