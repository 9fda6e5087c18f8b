"""Columns that clash with added ones only by the case of their letters: results can be stored."""

from __future__ import annotations

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from layerloom.llm import bpe, html_text, language, mixing, quality, url_filter

CLASHING = ["IDS", "Lang_Pred", "SCORE", "Block", "SLOT", "pLace", "N_Chars", "Host", "PATH", "Rule", "VERDICT", "Statistics", "Predicted"]


def encoded(docs):
    return bpe.encoded(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, kept=5), {"ids"}


def identified(docs):
    return language.identified(docs, language.fitted(docs)), {"lang_pred", "score"}


def mixed(docs):
    return mixing.mixed(docs), {"block", "slot", "place"}


def extracted(docs):
    return html_text.extracted(docs, "html"), {"text", "n_chars"}


def judged(docs):
    return url_filter.judged(docs, [url_filter.rule("block", "net/")]), {"host", "path", "rule", "verdict"}


def scored(docs):
    return quality.quality(docs, docs.select("doc_id", F.lit(1).alias("quality")), F.lit(True)), {"score", "predicted"}


@pytest.mark.parametrize("operator", [encoded, identified, mixed, extracted, judged, scored])
def test_names_are_compared_without_case(spark, tmp_path, operator):
    rows = [(i, f"text {i}", "en", "s", "<p>x</p>", "http://a.net/") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string, html string, url string")
    docs = docs.select("*", *(F.lit("own").alias(name) for name in CLASHING))
    found, added = operator(docs)
    names = [name.lower() for name in found.columns]
    assert len(names) == len(set(names)) and added <= set(found.columns)
    found.write.parquet(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
