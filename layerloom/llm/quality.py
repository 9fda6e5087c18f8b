"""Quality scores by a regularised quadratic discriminant over document statistics.

Each text becomes a short vector of statistics: lengths as logarithms, shares by the arc sine
of their root, which evens out their spread. Each class, high and low quality, is a normal
distribution of such vectors with a mean and a covariance of its own. A covariance is shrunk
towards the diagonal of the pooled one, so that it has an inverse however few its rows are
and however little a statistic varies within a class. A text's score comes from the
difference of the two log densities: squared Mahalanobis distances through the Cholesky
factors, which are computed once and kept with the model, and the logarithms of the factors'
determinants. Statistics of a text are not independent, so the difference is divided by their
number before the logistic function; its sign, and so the decision, stays the same.

Statistics cover every whole text and are stored, a few numbers a row. The model is fitted on
all labelled rows by sums of weights, vectors and outer products: each task adds up its rows,
Spark adds up the tasks, and the driver gets a number per class and product, however many rows
there are. Labels are joined with the stored vectors, and never with texts.

Defined cases: a null text counts as empty; an empty text has only zeros as statistics and is
scored like any other. Very long texts are read in slices cut at white space. Rows that repeat
a document are scored each. Labels other than 0 and 1 are ignored; several labels of an id
share its weight between the classes. A null id has no label. Without labels of both classes
the score is the share of label 1 among the labels, or 0.5 without any. An empty table gives
an empty result. ``score`` and ``predicted`` replace columns of that name, in any case of
letters; other columns play no part.
"""

from __future__ import annotations

import operator
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import others, settled, whole_text

#: How much of each covariance is taken from the diagonal of the pooled one.
SHRINKAGE = 0.2
#: Added to each variance, so that a statistic that never varies still has one.
LEAST_VARIANCE = 1e-4

_SLICE = 1 << 20
_SYMBOL, _LOWER, _UPPER, _DIGIT, _SPACE, _END, _COMMON = range(7)
# Marks that end sentences, and marks usual within them.
_ENDS, _COMMON_MARKS = ".!?…", ",;:'\"()-–—’“”„«»¿¡"


@cache
def _kinds() -> np.ndarray:
    """The kind of each code point."""
    kinds = np.full(0x110000, _SYMBOL, np.uint8)
    for point in range(len(kinds)):
        category = unicodedata.category(chr(point))
        if category[0] in "LM":
            kinds[point] = _UPPER if category in ("Lu", "Lt") else _LOWER
        elif category[0] == "N":
            kinds[point] = _DIGIT
        elif category[0] == "Z":
            kinds[point] = _SPACE
    for kind, marks in ((_SPACE, "\t\n\v\f\r"), (_END, _ENDS), (_COMMON, _COMMON_MARKS)):
        kinds[[ord(mark) for mark in marks]] = kind
    return kinds


def _slices(text: str) -> Iterator[str]:
    """The text in parts that are cut at white space only."""
    start = 0
    while start < len(text):
        end = min(start + _SLICE, len(text))
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[start:end]
        start = end


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one text, ``WIDTH`` of them."""
    text = text or ""
    marks = np.zeros(7, np.int64)
    words: Counter[str] = Counter()
    in_a_row = shouted = bare = 0
    last = None
    for part in _slices(text):
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        marks += np.bincount(_kinds()[points], minlength=7)
        found = part.split()
        if found:
            in_a_row += sum(map(operator.eq, found, found[1:])) + (found[0] == last)
            last = found[-1]
            words.update(found)
    for word, times in words.items():
        if len(word) > 1 and word.isupper():
            shouted += times
        elif not any(map(str.isalnum, word)):
            bare += times
    number = words.total()
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    letters = int(marks[_LOWER] + marks[_UPPER])
    shown = len(text) - int(marks[_SPACE])
    return [
        np.log1p(number),
        np.log1p(shown / max(number, 1)),
        np.log1p(number / max(len(lines), 1)),
        np.log1p(len(words)) / np.log1p(max(number, 1)),
        _share(max(words.values(), default=0) - 1, number),
        _share(in_a_row, number),
        _share(shouted, number),
        _share(bare, number),
        _share(len(lines) - len(set(lines)), len(lines)),
        _share(letters, shown),
        _share(marks[_UPPER], letters),
        _share(marks[_DIGIT], shown),
        _share(marks[_SYMBOL], shown),
        _share(marks[_END], shown),
        _share(marks[_COMMON], shown),
    ]


WIDTH = 15


def _share(part: float, whole: float) -> float:
    return float(np.arcsin(np.sqrt(part / whole))) if part > 0 and whole > 0 else 0.0


@dataclass(frozen=True)
class Model:
    """Means and inverted Cholesky factors of class 0 and class 1, or a score for all texts."""

    means: np.ndarray
    factors: np.ndarray
    offset: float
    constant: float | None = None

    @classmethod
    def of(
        cls, weights: np.ndarray, sums: np.ndarray, products: np.ndarray, shrinkage: float = SHRINKAGE
    ) -> Model:
        """From each class's weight, sum of vectors and sum of their outer products."""
        if not (weights > 0).all():
            known = weights.sum()
            return cls(sums, products, 0.0, float(weights[1] / known) if known else 0.5)
        means = sums / weights[:, None]
        spreads = products / weights[:, None, None] - means[:, :, None] * means[:, None, :]
        pooled = np.einsum("c,cii->i", weights / weights.sum(), spreads)
        shared = np.diag(np.maximum(pooled, 0))
        shrunk = (1 - shrinkage) * spreads + shrinkage * shared + LEAST_VARIANCE * np.eye(len(shared))
        lower = np.linalg.cholesky(shrunk)
        # Half the logarithm of a covariance's determinant is that of its factor.
        halves = np.log(np.diagonal(lower, axis1=1, axis2=2)).sum(axis=1)
        offset = halves[0] - halves[1] + np.log(weights[1] / weights[0])
        return cls(means, np.linalg.inv(lower), float(offset))

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(vectors), self.constant)
        away = [(vectors - mean) @ factor.T for mean, factor in zip(self.means, self.factors, strict=True)]
        distances = [np.einsum("ni,ni->n", one, one) for one in away]
        evidence = (distances[0] - distances[1]) / 2 + self.offset
        return 1 / (1 + np.exp(np.clip(-evidence / vectors.shape[1], -500, 500)))


def vectors(docs: DataFrame, text: str = "text", name: str = "statistics") -> DataFrame:
    """The rows' columns but the text, and the statistics of the whole text."""

    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(statistics)

    kept = [F.col(f"`{c}`") for c in others(docs.columns, text, name)]
    return docs.select(*kept, of(whole_text(F.col(text))).alias(name))


def fitted(rows: DataFrame, statistic: str, weight_of_one: Column, shrinkage: float = SHRINKAGE) -> Model:
    """A model of the labelled rows; ``weight_of_one`` is the share of label 1, null without label."""
    known = rows.select(F.col(statistic).alias("vector"), weight_of_one.cast("double").alias("one"))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each class: its weight, its sums and its products, as numbered values."""
        totals = np.zeros((2, 1 + WIDTH + WIDTH * WIDTH))
        for batch in batches:
            found = np.array(batch.column(0).flatten()).reshape(-1, WIDTH)
            ones = np.array(batch.column(1))
            for number, weights in enumerate((1 - ones, ones)):
                weighted = found * weights[:, None]
                parts = ([weights.sum()], weighted.sum(axis=0), (weighted.T @ found).ravel())
                totals[number] += np.concatenate(parts)
        values = totals.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values)], ["at", "value"])

    sums = (
        known.filter("one is not null and vector is not null")
        .mapInArrow(added, "at int, value double")
        .groupBy("at")
        .agg(F.sum("value").alias("value"))
    )
    totals = np.zeros(2 * (1 + WIDTH + WIDTH * WIDTH))
    for row in sums.collect():  # a fixed number of rows
        totals[row["at"]] = row["value"]
    totals = totals.reshape(2, -1)
    products = totals[:, 1 + WIDTH :].reshape(2, WIDTH, WIDTH)
    return Model.of(totals[:, 0], totals[:, 1 : 1 + WIDTH], products, shrinkage)


def labelled(rows: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """``rows`` as one field each, beside the share of label 1 among the labels of their id."""
    given = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    shares = given.groupBy(F.col(doc_id).alias("labelled_id")).agg(F.avg(label).alias("one"))
    held = rows.select(F.struct("*").alias("row"))
    return held.join(shares, F.col(f"row.{doc_id}") == F.col("labelled_id"), "left").drop("labelled_id")


def scored(rows: DataFrame, model: Model, statistic: str = "statistics") -> DataFrame:
    """The rows with ``score`` and ``predicted`` in place of the statistics."""

    @F.pandas_udf("double")
    def score(found: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(found.to_numpy())))

    held = rows.select(F.struct("*").alias("row"), score(F.col(statistic)).alias("score"))
    return held.select(
        *(F.col("row").getField(c).alias(c) for c in others(rows.columns, "score", "predicted", statistic)),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def quality(
    docs: DataFrame,
    labels: DataFrame,
    learned_from: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    shrinkage: float = SHRINKAGE,
) -> DataFrame:
    """All rows, without their text, with ``score`` and ``predicted``.

    The model learns from the labelled rows for which ``learned_from`` holds.
    """
    found = settled(vectors(docs, text), "statistics")
    known = labelled(found.withColumn("_learned", learned_from), labels, doc_id, label)
    weight = F.when(F.col("row._learned"), F.col("one"))
    return scored(found, fitted(known, "row.statistics", weight, shrinkage))
