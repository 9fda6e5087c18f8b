from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerloom.llm import quality
from layerloom.llm.queries import QUERIES


def gaussian_score(vector, rows_by_class, shrinkage=quality.SHRINKAGE):
    """The score by the definition: densities with explicit inverses and determinants."""
    sizes = [len(rows) for rows in rows_by_class]
    spreads = [np.cov(rows, rowvar=False, bias=True) for rows in rows_by_class]
    pooled = sum(n * np.diag(s) for n, s in zip(sizes, spreads, strict=True)) / sum(sizes)
    logs = []
    for rows, spread, n in zip(rows_by_class, spreads, sizes, strict=True):
        cov = (1 - shrinkage) * spread + shrinkage * np.diag(pooled) + quality.LEAST_VARIANCE * np.eye(len(pooled))
        away = vector - rows.mean(axis=0)
        logs.append(np.log(n) - (away @ np.linalg.inv(cov) @ away + np.linalg.slogdet(cov)[1]) / 2)
    return 1 / (1 + np.exp(-(logs[1] - logs[0]) / len(vector)))


def test_query_equals_brute_force_and_held_out_rows_are_told_apart(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    labels = dict(spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").collect())
    held_out = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in docs}
    vectors = {r.doc_id: np.array(quality.statistics(r.text)) for r in docs}
    known = [
        np.array([vectors[i] for i, label in labels.items() if label == side and i in vectors and not held_out[i]])
        for side in (0, 1)
    ]
    found = {r.doc_id: r for r in QUERIES["op13_quality"](spark, sf_dir).collect()}
    assert set(found) == set(vectors)
    for i, row in found.items():
        assert row.held_out == held_out[i]
        assert row.score == pytest.approx(gaussian_score(vectors[i], known), abs=1e-6)
        assert row.predicted == int(row.score >= 0.5)
    judged = [found[i].predicted == label for i, label in labels.items() if i in found and held_out[i]]
    assert len(judged) > 50 and np.mean(judged) >= 0.97


def test_statistics_of_odd_texts():
    assert quality.statistics(None) == quality.statistics("") == [0.0] * quality.WIDTH
    for text in (" ", "\n\n", "\ud800", "x" * 3_000_000, "日本語", "!?" * 50, "a　b\x00"):
        found = quality.statistics(text)
        assert len(found) == quality.WIDTH and np.isfinite(found).all()


def test_slices_change_no_statistic(monkeypatch):
    text = "Der Der Der und | 12 ABC!! Straße\n" * 40 + "lang" * 90 + " Ende."
    whole = quality.statistics(text)
    monkeypatch.setattr(quality, "_SLICE", 7)
    assert quality.statistics(text) == whole


def test_odd_rows_and_labels(spark):
    docs = spark.createDataFrame(
        [(i, f"Good words number {i} stand here.\nThey differ." if i % 2 else "no no no no no ### no no", 0.1, "x") for i in range(40)]
        + [(1, "Good words number 1 stand here.\nThey differ.", 0.1, "x"), (None, None, None, None), (99, "", 1.0, "y")],
        "doc_id long, text string, SCORE double, row string",
    )
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(30)] + [(1, 1), (2, 1), (2, 0), (None, 1), (3, None), (5, 7), (1000, 0)],
        "doc_id long, quality int",
    )
    found = quality.quality(docs, labels, F.lit(True))
    assert found.columns == ["doc_id", "row", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == 43 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == r.doc_id % 2 for r in rows if r.doc_id is not None and r.doc_id < 40)
    assert len({r.score for r in rows if r.doc_id == 1}) == 1
    assert quality.quality(docs.limit(0), labels, F.lit(True)).count() == 0


@pytest.mark.parametrize(("given", "score"), [([], 0.5), ([(1, 1)], 1.0), ([(1, 0), (2, 0)], 0.0)])
def test_labels_of_one_class_or_none(spark, given, score):
    docs = spark.createDataFrame([(1, "a b"), (2, "c"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame(given, "doc_id long, quality int")
    assert {r.score for r in quality.quality(docs, labels, F.lit(True)).collect()} == {score}
