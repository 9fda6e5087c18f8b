"""The three-row customer table, whose outcome in every layer is known."""

from __future__ import annotations

import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from layerloom import LayerConfig
from layerloom.plans import CUSTOMERS, bronze, gold, run, silver
from layerloom.sinks import write_layer
from layerloom.sources import literal_rows, read_layer

SCHEMA = "id string, name string, email string, created_date string, status string"
# The sample customers.
CUSTOMER_ROWS = [
    ("1", "John Doe", "john@email.com", "2024-01-01", "active"),
    ("2", "Jane Smith", "jane@email.com", "2024-01-02", "inactive"),
    ("3", "Bob Johnson", "bob@email.com", "2024-01-03", "active"),
]
EDGE_ROWS = [
    ("4", "No Mail", None, "2024-02-01", "active"),
    ("5", "Odd Mail", "nobody", "2024-02-30", "active"),
    ("6", "No State", "x@email.com", "2024-02-03", None),
    ("7", "Two Signs", "a@b@c.com", "tomorrow", "active"),
    ("8", "Ünïcødé 名", "ü@email.com", None, "active"),
]


def silver_rows(spark, rows):
    raw = literal_rows(spark, rows, SCHEMA)
    clean = silver(bronze(raw, CUSTOMERS.source_system), CUSTOMERS.clean)
    return {r.id: (r.email_domain, r.created_date) for r in clean.collect()}


def test_bronze_keeps_all_rows_and_stamps_them(spark):
    raw = literal_rows(spark, CUSTOMER_ROWS, SCHEMA)
    rows = bronze(raw, "sample_system").collect()
    assert [tuple(r)[:5] for r in rows] == CUSTOMER_ROWS
    assert {r.source_system for r in rows} == {"sample_system"}
    assert len({r.ingestion_timestamp for r in rows}) == 1


def test_silver_golden(spark):
    assert silver_rows(spark, CUSTOMER_ROWS) == {
        "1": ("email.com", datetime.date(2024, 1, 1)),
        "3": ("email.com", datetime.date(2024, 1, 3)),
    }


def test_silver_columns_in_order(spark):
    raw = literal_rows(spark, CUSTOMER_ROWS, SCHEMA)
    clean = silver(bronze(raw, "sample_system"), CUSTOMERS.clean)
    assert clean.dtypes == [
        ("id", "string"),
        ("name", "string"),
        ("email", "string"),
        ("email_domain", "string"),
        ("created_date", "date"),
        ("ingestion_timestamp", "timestamp"),
        ("processed_timestamp", "timestamp"),
    ]


def test_silver_edges(spark):
    assert silver_rows(spark, EDGE_ROWS) == {
        "4": (None, datetime.date(2024, 2, 1)),
        "5": ("", None),
        "7": ("b@c.com", None),
        "8": ("email.com", None),
    }


def test_gold_groups_null_and_empty_keys_apart(spark):
    raw = literal_rows(spark, CUSTOMER_ROWS + EDGE_ROWS, SCHEMA)
    metrics = gold(silver(bronze(raw, "s"), CUSTOMERS.clean), CUSTOMERS.metrics)
    rows = {r.email_domain: (r.customer_count, r.latest_registration) for r in metrics.collect()}
    assert rows == {
        "email.com": (3, datetime.date(2024, 1, 3)),
        None: (1, datetime.date(2024, 2, 1)),
        "": (1, None),
        "b@c.com": (1, None),
    }


def test_run_golden(spark, config):
    stored = run(literal_rows(spark, CUSTOMER_ROWS, SCHEMA), config, CUSTOMERS)
    today = spark.range(1).select(F.current_date()).first()[0]
    assert stored.columns == [
        "email_domain",
        "customer_count",
        "latest_registration",
        "report_date",
    ]
    assert [tuple(r) for r in stored.collect()] == [
        ("email.com", 2, datetime.date(2024, 1, 3), today)
    ]
    counts = {
        (layer, table): read_layer(spark, config, layer, table).count()
        for layer, table in [
            ("bronze", "customer_raw"),
            ("silver", "customer_clean"),
            ("gold", "customer_domain_metrics"),
        ]
    }
    assert list(counts.values()) == [3, 2, 1]


def test_run_twice_overwrites(spark, config):
    raw = literal_rows(spark, CUSTOMER_ROWS, SCHEMA)
    run(raw, config, CUSTOMERS)
    assert run(raw, config, CUSTOMERS).count() == 1


def test_run_on_empty_table(spark, config):
    stored = run(literal_rows(spark, [], SCHEMA), config, CUSTOMERS)
    assert stored.count() == 0
    assert read_layer(spark, config, "silver", "customer_clean").count() == 0


def test_missing_table_raises(spark, config):
    with pytest.raises(AnalysisException) as error:
        read_layer(spark, config, "bronze", "nothing")
    assert error.value.getCondition() == "PATH_NOT_FOUND"


@pytest.mark.parametrize("mode, count", [("append", 6), ("ignore", 3), ("overwrite", 3)])
def test_save_modes(spark, config, mode, count):
    raw = literal_rows(spark, CUSTOMER_ROWS, SCHEMA)
    write_layer(raw, config, "bronze", "t")
    write_layer(raw, config, "bronze", "t", mode=mode)
    assert read_layer(spark, config, "bronze", "t").count() == count


def test_save_mode_error(spark, config):
    raw = literal_rows(spark, CUSTOMER_ROWS, SCHEMA)
    write_layer(raw, config, "bronze", "t")
    with pytest.raises(AnalysisException):
        write_layer(raw, config, "bronze", "t", mode="error")


def test_config_paths():
    config = LayerConfig("/data/")
    assert config.layer_path("bronze") == "/data/bronze"
    assert config.layer_path("gold", "t") == "/data/gold/t"
    assert config.checkpoint_path("job") == "/data/checkpoints/job"
    assert config.temp_path("x.json") == "/data/temp/x.json"
    assert config.as_dict() == {
        "base_path": "/data",
        "format": "parquet",
        "bronze_path": "/data/bronze",
        "silver_path": "/data/silver",
        "gold_path": "/data/gold",
        "checkpoint_path": "/data/checkpoints",
        "temp_path": "/data/temp",
    }
    with pytest.raises(ValueError):
        config.layer_path("platinum")
    with pytest.raises(ValueError):
        LayerConfig("")


def test_config_on_adls():
    config = LayerConfig.on_adls("lake", "acct")
    assert config.layer_path("silver", "t") == "abfss://lake@acct.dfs.core.windows.net/silver/t"
    assert config.format == "delta"


def test_config_is_immutable():
    with pytest.raises(AttributeError):
        LayerConfig("/data").base_path = "/other"


@pytest.mark.parametrize("format", ["orc", "json"])
def test_table_in_another_format(spark, config, format):
    raw = literal_rows(spark, CUSTOMER_ROWS, SCHEMA)
    write_layer(raw, config, "bronze", "t", partition_by=["status"], format=format)
    stored = read_layer(spark, config, "bronze", "t", raw.schema, format=format)
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, raw.select(stored.columns).collect()))
