"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import workload
from __spark_entry__ import oracle_sql, queries


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        files = f"{path}/*.parquet" if path.is_dir() else path
        connection.execute(f"create view {path.stem} as select * from '{files}'")
    yield connection
    connection.close()


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(name, spark, sf_dir, duck):
    result = queries()[name](spark, sf_dir)
    relation = duck.sql(oracle_sql()[name])
    assert sorted(result.columns) == sorted(relation.columns)
    spark_rows = multiset(result.columns, result.collect())
    duck_rows = multiset(relation.columns, relation.fetchall())
    assert spark_rows.total() > 0
    assert spark_rows == duck_rows


def test_every_query_has_sql():
    assert set(workload.ORACLES) == set(workload.QUERIES)
