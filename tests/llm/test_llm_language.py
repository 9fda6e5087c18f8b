from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerloom.llm import language
from layerloom.llm.queries import QUERIES


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op6_language_id"](spark, sf_dir)
    assert found.count() == docs.count()
    held_out = found.filter("held_out").join(docs, "doc_id")
    right = held_out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.99
    assert found.filter("score < 0 or score > 1").count() == 0


def test_edges(spark):
    rows = [(i, text, lang, "x") for i, (text, lang) in enumerate(
        [("aaa bbb " * 20, "aa"), ("aaa abb " * 20, "aa"), ("zzz yyy " * 20, "zz"), (None, "aa"), ("xx", None)] * 5
    )]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string, score string")
    filters = language.fitted(docs)
    assert filters.names == ("aa", "zz")
    texts = ["aaa bbb", "zzz", None, "", "123 !?", "日本", "aaa " * 300_000, "Zzz\u00a0YYY"]
    asked = spark.createDataFrame(list(enumerate(texts)), "n int, text string").repartition(2)
    found = {r.n: (r.lang_pred, r.score) for r in language.identified(asked, filters).collect()}
    assert [found[i][0] for i in range(8)] == ["aa", "zz", "und", "und", "und", "aa", "aa", "zz"]
    assert found[2][1] == found[3][1] == found[4][1] == found[5][1] == 0
    assert language.identified(docs, filters).columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert language.identified(docs.limit(0), filters).count() == 0
    nothing = language.fitted(docs.limit(0))
    assert nothing.judge("aaa") == ("und", 0.0)


def test_more_languages_than_bits_of_a_word():
    grams = {f"l{i:03d}": np.arange(i * 50, i * 50 + 50, dtype=np.uint64) for i in range(130)}
    filters = language.built(grams)
    for i in (0, 63, 64, 129):
        word, bit = divmod(i, 64)
        assert (filters.masks(grams[f"l{i:03d}"])[:, word] >> np.uint64(bit) & np.uint64(1)).all()


def test_slices_see_the_same_grams(monkeypatch):
    text = "Abc dé-fg " * 50
    whole = np.concatenate(list(language._grams(text)))
    monkeypatch.setattr(language, "_SLICE", 7)
    assert np.array_equal(np.concatenate(list(language._grams(text))), whole)


def trigrams(text):
    """Each letter between its neighbours, anything else as a space, as plain strings."""
    shown = [c if c.isalpha() else " " for c in (text or "").lower()]
    padded = [" ", *shown, " "]
    return ["".join(padded[i - 1 : i + 2]) for i in range(1, len(padded) - 1) if padded[i] != " "]


def packed(gram):
    return sum(ord(c) << shift for c, shift in zip(gram, (42, 21, 0), strict=True))


def test_filters_and_counts_equal_exact_sets(spark):
    """The query's filters against plain sets of n-grams, and its scores against plain counts."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()
    known = [r for r in docs if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang is not None and r.text is not None]
    counts, texts = defaultdict(Counter), Counter(r.lang for r in known)
    for r in known:
        counts[r.lang].update(trigrams(r.text))
    frequent = {}
    for lang, found in counts.items():
        top = sorted(((-n, packed(g), g) for g, n in found.items() if n >= language.LEAST_COUNT))
        frequent[lang] = {g: -n for n, _, g in top[: language.GRAMS_PER_LANGUAGE]}
    share = {lang: {g: n / sum(own.values()) for g, n in own.items()} for lang, own in frequent.items()}
    highest = Counter()
    for own in share.values():
        for g, s in own.items():
            highest[g] = max(highest[g], s)
    exact = {lang: {g for g, s in own.items() if s >= language.LEAST_SHARE * highest[g]} for lang, own in share.items()}

    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    filters = language.fitted(spark.read.parquet(f"{sf_dir}/documents.parquet").filter(~held))
    assert list(filters.names) == sorted(texts, key=lambda lang: (-texts[lang], lang))
    every = sorted({g for own in counts.values() for g in own})
    masks = filters.masks(np.array([packed(g) for g in every], np.uint64))[:, 0]
    for number, lang in enumerate(filters.names):
        claimed = {g for g, mask in zip(every, masks.tolist(), strict=True) if mask >> number & 1}
        assert exact[lang] <= claimed  # a Bloom filter forgets nothing
        wrong = len(claimed - exact[lang]) / max(1, len(set(every) - exact[lang]))
        assert wrong <= 3 * filters.wrong_rates[number] + 0.01

    for row in QUERIES["op6_language_id"](spark, sf_dir).collect():
        text = next(r.text for r in docs if r.doc_id == row.doc_id)
        grams = trigrams(text)
        if not grams:
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        plain = {lang: sum(g in exact[lang] for g in grams) / len(grams) for lang in filters.names}
        best = max(plain.values())
        assert plain[row.lang_pred] >= best - 0.02
        assert row.score == pytest.approx(plain[row.lang_pred], abs=0.02)
