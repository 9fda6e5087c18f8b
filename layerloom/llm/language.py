"""Language identification by n-gram filters that hold a bitmask of languages.

Each language's frequent letter n-grams go into a Bloom filter. The filters are bit-sliced:
one table holds, at each position, the mask of all languages whose filter has that bit, so
the masks at an n-gram's few positions, combined by AND, are all languages that contain it.
A text's n-grams are looked up at once, and each language's bit is counted over them. Of
``n`` n-grams a filter that answers wrongly at the rate ``f`` is expected to claim
``c + (n - c) * f``; solved for ``c`` that is the corrected count. The largest decides.

The model is fitted on at most about ``rows_per_language`` texts of each language, drawn by
a hash of their id, and has at most ``grams_per_language`` n-grams of each, so the table
has one fixed size, which bounds its broadcast. Prediction covers every whole text.

Defined cases: a text that is null or without a letter is ``und`` with score 0. A text with
letters but no known n-gram gets the language with most training texts, with score 0. Ties
go to the language with more training texts, then to the smaller name. Without any
training text every text is ``und``. Rows without text or language are not learned from. Very
long texts are read whole, in slices; rows that repeat a document are judged each. An empty
table gives an empty result. ``lang_pred`` and ``score`` replace columns of that name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerloom.llm.common import others

ROWS_PER_LANGUAGE = 4000
GRAMS_PER_LANGUAGE = 20_000
MAX_LANGUAGES = 1024
LEAST_COUNT = 3
#: An n-gram belongs to a language if it is this frequent there, beside where it is most so.
LEAST_SHARE = 0.25
POSITIONS_LOG2 = 18
HASHES = 4
UNDETERMINED = "und"

_SPACE = 32
_SLICE = 1 << 20
#: Odd 64-bit factors that spread an n-gram over the table, one for each hash.
_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64
)


@dataclass(frozen=True)
class Filters:
    """``slices[p, w]``: the languages with bit ``p``, 64 to a word; names by their bit."""

    names: tuple[str, ...]
    slices: np.ndarray
    wrong_rates: np.ndarray

    def masks(self, grams: np.ndarray) -> np.ndarray:
        found = self.slices[_position(grams, 0)]
        for number in range(1, HASHES):
            found &= self.slices[_position(grams, number)]
        return found

    def judge(self, text: str | None) -> tuple[str, float]:
        total, counts = 0, np.zeros(len(self.names))
        for grams in _grams(text or ""):
            total += len(grams)
            masks = self.masks(grams)
            for number in range(len(self.names)):
                word, bit = divmod(number, 64)
                counts[number] += int(((masks[:, word] >> np.uint64(bit)) & np.uint64(1)).sum())
        if not total or not self.names:
            return UNDETERMINED, 0.0
        corrected = np.maximum((counts - total * self.wrong_rates) / (1 - self.wrong_rates), 0)
        best = int(np.argmax(corrected))  # the first of equals; names are in order of choice
        return self.names[best], float(min(corrected[best] / total, 1.0))


def built(languages: dict[str, np.ndarray]) -> Filters:
    """Filters over each language's n-grams; earlier languages win ties."""
    words = max(1, -(-len(languages) // 64))
    slices = np.zeros((1 << POSITIONS_LOG2, words), np.uint64)
    rates = []
    for number, grams in enumerate(languages.values()):
        word, bit = divmod(number, 64)
        own = np.zeros(len(slices), bool)
        for hash_number in range(HASHES):
            own[_position(grams, hash_number)] = True
        slices[own, word] |= np.uint64(1 << bit)
        rates.append(own.mean() ** HASHES)
    return Filters(tuple(languages), slices, np.array(rates))


def _position(grams: np.ndarray, number: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = (grams ^ (grams >> np.uint64(29))) * _FACTORS[number]
    return mixed >> np.uint64(64 - POSITIONS_LOG2)


@cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _grams(text: str) -> Iterator[np.ndarray]:
    """Each letter between its neighbours, where anything but a letter counts as a space.

    Three code points of 21 bits fill a number exactly. Long texts come in slices.
    """
    lowered = text.lower()
    for start in range(0, len(lowered), _SLICE):
        part = lowered[max(0, start - 1) : start + _SLICE + 1]
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[points]
        points = np.where(letter, points, _SPACE).astype(np.uint64)
        points = np.pad(points, (int(start == 0), int(len(lowered) <= start + _SLICE)), constant_values=_SPACE)
        middle = points[1:-1]
        grams = points[:-2] << np.uint64(42) | middle << np.uint64(21) | points[2:]
        yield grams[middle != _SPACE]


def fitted(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    grams_per_language: int = GRAMS_PER_LANGUAGE,
    max_languages: int = MAX_LANGUAGES,
) -> Filters:
    """Learn from the rows that have a text and a language."""
    known = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    rows = known.groupBy(F.col(lang).alias("lang")).count().limit(max_languages + 1).collect()
    if len(rows) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    sizes = {row["lang"]: row["count"] for row in rows}
    names = sorted(sizes, key=lambda name: (-sizes[name], name))
    if not names:
        return built({})
    drawn = F.pmod(F.xxhash64(F.col(doc_id).cast("string")), F.lit(1 << 30)) / float(1 << 30)
    shares = F.create_map(*(F.lit(x) for name in names for x in (name, rows_per_language / sizes[name])))
    sample = known.filter(drawn < shares[F.col(lang)]).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, texts in frame.groupby("lang")["text"]:
                counts: Counter[int] = Counter()
                for one in texts:
                    for grams in _grams(one):
                        values, times = np.unique(grams.view(np.int64), return_counts=True)
                        counts.update(dict(zip(values.tolist(), times.tolist(), strict=True)))
                yield pd.DataFrame({"lang": name, "gram": list(counts), "times": list(counts.values())})

    counts = (
        sample.mapInPandas(counted, "lang string, gram bigint, times bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("times").alias("times"))
        .filter(F.col("times") >= LEAST_COUNT)
    )
    most = Window.partitionBy("lang").orderBy(F.desc("times"), "gram")
    top = counts.withColumn("rank", F.row_number().over(most)).filter(F.col("rank") <= grams_per_language)
    frame = top.select("lang", "gram", "times").toPandas()
    frame["share"] = frame["times"] / frame.groupby("lang")["times"].transform("sum")
    highest = frame.groupby("gram")["share"].transform("max")
    own = frame[frame["share"] >= LEAST_SHARE * highest]
    return built(
        {name: np.sort(own.loc[own["lang"] == name, "gram"].to_numpy(np.int64)).view(np.uint64) for name in names}
    )


def identified(docs: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and ``score``; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    @F.pandas_udf("struct<lang:string,score:double>")
    def judge(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.judge(one) for one in texts], columns=["lang", "score"])

    # The row as one field, so that no name of its columns can clash.
    judged = docs.select(F.struct("*").alias("row"), judge(F.col(text)).alias("found"))
    kept = [F.col("row").getField(c).alias(c) for c in others(docs.columns, "lang_pred", "score")]
    return judged.select(
        *kept, F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )
