from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import workload
from __spark_entry__ import entry, oracle_sql, queries


def test_entry_is_the_gold_table(spark):
    result = entry(spark)
    assert result.dtypes == [
        ("priority", "string"),
        ("order_count", "bigint"),
        ("latest_order", "date"),
        ("dated_today", "boolean"),
    ]
    assert result.count() == 5


def test_registries_are_copies():
    queries().clear()
    oracle_sql().clear()
    assert queries() and oracle_sql()


@pytest.mark.parametrize("also_pipeline", [True, False])
def test_entry_without_the_training_data_operators(tmp_path, also_pipeline):
    """A copy of the library alone imports, and has all of its own queries."""
    root = Path(__file__).resolve().parent.parent
    for name in ("layerloom", "workload"):
        shutil.copytree(root / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    if also_pipeline:
        shutil.copy(root / "corpus_pipeline.py", tmp_path)
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    names, checked = (line.split() for line in found.stdout.splitlines())
    assert names == checked == sorted(workload.QUERIES)
