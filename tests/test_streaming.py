from __future__ import annotations

import os
import time
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerloom.plans import MetricRules
from layerloom.sinks import write_layer
from layerloom.sources import read_layer
from layerloom.streaming import append_new, append_unread, keep_metrics, kept_metrics, new_files

SCHEMA = "id bigint, part string"


def land(spark, config, start, count):
    rows = spark.range(start, start + count).select("id", F.lit(f"p{start}").alias("part"))
    write_layer(rows.coalesce(2), config, "bronze", "t", mode="append")
    return rows.schema


def run(spark, config, schema, **options):
    stream = new_files(spark, config, "bronze", "t", schema, **options)
    append_new(stream, config, "silver", "t", job="t", partition_by=["part"])
    return read_layer(spark, config, "silver", "t", schema)


def test_each_run_takes_only_new_files(spark, config):
    schema = land(spark, config, 0, 100)
    assert run(spark, config, schema).count() == 100
    assert run(spark, config, schema).count() == 100
    land(spark, config, 1000, 40)
    rows = run(spark, config, schema)
    assert rows.count() == rows.distinct().count() == 140


def test_bounded_batches_take_everything(spark, config):
    for start in range(0, 50, 10):
        schema = land(spark, config, start, 10)
    rows = run(spark, config, schema, max_files_per_batch=1)
    assert sorted(r.id for r in rows.collect()) == list(range(50))


def test_failed_run_continues_without_loss_or_repeats(spark, config):
    schema = land(spark, config, 0, 10)
    run(spark, config, schema)
    land(spark, config, 100, 10)
    stream = new_files(spark, config, "bronze", "t", schema)
    broken = stream.withColumn("id", F.when(F.col("id") == 105, F.raise_error("boom")).otherwise(F.col("id")).cast("bigint"))
    with pytest.raises(StreamingQueryException):
        append_new(broken, config, "silver", "t", job="t", partition_by=["part"])
    rows = run(spark, config, schema)
    assert sorted(r.id for r in rows.collect()) == [*range(10), *range(100, 110)]


def test_files_with_old_times_are_read(spark, config):
    schema = land(spark, config, 0, 10)
    run(spark, config, schema)
    before = set(Path(config.layer_path("bronze", "t")).glob("part-*"))
    land(spark, config, 100, 7)
    long_ago = time.time() - 10 * 24 * 3600
    for file in set(Path(config.layer_path("bronze", "t")).glob("part-*")) - before:
        os.utime(file, (long_ago, long_ago))
    assert run(spark, config, schema).count() == 17


def test_batch_writers_share_the_table(spark, config):
    schema = land(spark, config, 0, 10)
    run(spark, config, schema)
    extra = spark.range(50, 57).select("id", F.lit("batch").alias("part"))
    write_layer(extra, config, "silver", "t", mode="append", partition_by=["part"])
    assert read_layer(spark, config, "silver", "t", schema).count() == 17
    write_layer(extra, config, "silver", "t", partition_by=["part"])
    land(spark, config, 200, 5)
    assert run(spark, config, schema).count() == 12
    assert not (Path(config.layer_path("silver", "t")) / "_spark_metadata").exists()


def test_a_batch_that_runs_again_adds_nothing(spark, config):
    schema = land(spark, config, 0, 10)
    run(spark, config, schema)
    commits = Path(config.checkpoint_path("t")) / "commits"
    for file in (commits / "0", commits / ".0.crc"):  # as if the run had died before its commit
        file.unlink()
    assert run(spark, config, schema).count() == 10


def test_a_new_checkpoint_leaves_the_old_files(spark, config):
    schema = land(spark, config, 0, 10)
    run(spark, config, schema)
    stream = new_files(spark, config, "bronze", "t", schema)
    append_new(stream, config, "silver", "t", job="other", partition_by=["part"])
    assert read_layer(spark, config, "silver", "t", schema).count() == 20


def test_tables_with_a_stream_log_are_refused(spark, config):
    schema = land(spark, config, 0, 10)
    (Path(config.layer_path("silver", "t")) / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError, match="log"):
        write_layer(spark.range(1), config, "silver", "t", mode="append")
    with pytest.raises(ValueError, match="log"):
        run(spark, config, schema)


RULES = MetricRules(key="part", count_name="n", latest_of="id", latest_name="latest")


def gold_rows(spark, config, schema):
    found = kept_metrics(spark, config, "m", RULES, schema).collect()
    return sorted(((r.part, r.n, r.latest) for r in found), key=repr)


def keep(spark, config, schema, merged_after=3, **options):
    keep_metrics(new_files(spark, config, "bronze", "t", schema, **options), config, "m", RULES, "m", merged_after)
    return gold_rows(spark, config, schema)


def land_part(spark, config, part, start, count):
    rows = spark.range(start, start + count).select("id", F.lit(part).alias("part"))
    write_layer(rows.coalesce(1), config, "bronze", "t", mode="append")
    return rows.schema


def test_metrics_of_batches_add_up(spark, config):
    schema = StructType.fromDDL(SCHEMA)
    assert gold_rows(spark, config, schema) == []
    places = []
    for number in range(8):
        land_part(spark, config, f"p{number % 2}", 10 * number, 10)
        want = [(f"p{i}", 10 * ((number - i) // 2 + 1), 10 * (number - (number - i) % 2) + 9) for i in range(min(number + 1, 2))]
        assert keep(spark, config, schema) == want
        assert keep(spark, config, schema) == want  # a run without anything new
        places.append(len([*Path(config.layer_path("gold", "m")).glob("*/*-*")]))
    assert max(places) <= 8  # merged batches go


def test_null_and_empty_keys_are_counted_apart(spark, config):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, None)], SCHEMA)
    write_layer(rows, config, "bronze", "t", mode="append")
    keep(spark, config, rows.schema, merged_after=1)
    found = kept_metrics(spark, config, "m", RULES, rows.schema).collect()
    assert {(r.part, r.n, r.latest) for r in found} == {(None, 2, 3), ("", 1, 2)}


@pytest.mark.parametrize("merged_after", [1, 100])
def test_a_batch_that_is_counted_again_adds_nothing(spark, config, merged_after):
    schema = land_part(spark, config, "p", 0, 10)
    keep(spark, config, schema, merged_after)
    commits = Path(config.checkpoint_path("m")) / "commits"
    for file in (commits / "0", commits / ".0.crc"):  # as if the run had died before its commit
        file.unlink()
    assert keep(spark, config, schema, merged_after) == [("p", 10, 9)]


def test_a_batch_that_was_not_written_to_its_end_counts_once(spark, config):
    schema = land_part(spark, config, "p", 0, 10)
    keep(spark, config, schema)
    (batch,) = Path(config.layer_path("gold", "m")).glob("*/batch-*")
    (batch / "_SUCCESS").unlink()
    assert gold_rows(spark, config, schema) == []
    commits = Path(config.checkpoint_path("m")) / "commits"
    for file in (commits / "0", commits / ".0.crc"):
        file.unlink()
    assert keep(spark, config, schema) == [("p", 10, 9)]


def run_unread(spark, config, schema, made=lambda rows: rows, **options):
    options = {"partition_by": ["part"], "merged_after": 4, **options}
    append_unread(spark, config, ("bronze", "t"), schema, made, ("silver", "t"), "u", **options)


def unread(spark, config, schema, made=lambda rows: rows, **options):
    run_unread(spark, config, schema, made, **options)
    return sorted(r.id for r in read_layer(spark, config, "silver", "t", schema).collect())


def test_listed_runs_take_each_file_once_and_their_state_stays_level(spark, config):
    state, sizes = Path(config.checkpoint_path("u")), []
    for number in range(50):
        schema = land_part(spark, config, "p", 10 * number, 1)
        if number == 30:  # a copy that kept its old time
            file = max(Path(config.layer_path("bronze", "t")).glob("part-*"), key=lambda f: f.stat().st_mtime_ns)
            os.utime(file, (1, 1))
        run_unread(spark, config, schema)
        if number % 10 == 9:  # what was read may go, and is then forgotten
            for file in Path(config.layer_path("bronze", "t")).glob("part-*"):
                file.unlink()
        sizes.append(len(list(state.rglob("*"))))
    assert unread(spark, config, schema) == [10 * i for i in range(50)]
    assert max(sizes[25:]) <= max(sizes[:25])


def test_batches_of_files_are_bounded(spark, config):
    for start in range(0, 70, 10):
        schema = land_part(spark, config, "p", start, 10)
    taken = []
    count = lambda rows: (taken.append(len(rows.inputFiles())), rows)[1]
    assert unread(spark, config, schema, count, batch_files=3) == list(range(70))
    assert taken == [3, 3, 1]


def test_a_listed_run_that_failed_is_taken_up_again(spark, config):
    schema = land_part(spark, config, "p", 0, 10)
    unread(spark, config, schema)
    land_part(spark, config, "p", 100, 10)
    boom = F.when(F.col("id") == 105, F.raise_error("boom").cast("bigint")).otherwise(F.col("id"))
    with pytest.raises(Exception, match="boom"):
        unread(spark, config, schema, lambda rows: rows.withColumn("id", boom))
    land_part(spark, config, "p", 200, 5)
    assert unread(spark, config, schema) == [*range(10), *range(100, 110), *range(200, 205)]
    state = Path(config.checkpoint_path("u"))
    (done,) = state.glob("done-*")
    done.unlink()  # as if the last run had died before its mark
    assert unread(spark, config, schema) == [*range(10), *range(100, 110), *range(200, 205)]


def test_listed_runs_of_an_empty_source(spark, config):
    schema = StructType.fromDDL(SCHEMA)
    append_unread(spark, config, ("bronze", "t"), schema, lambda rows: rows, ("silver", "t"), "u")
    assert not Path(config.layer_path("silver", "t")).exists()
