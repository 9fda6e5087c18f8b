"""A training corpus from raw documents: five stages, each on all that the one before kept.

Language identification drops texts without a letter, and only those; exact dedup keeps one
of equal texts; SimHash near-dedup keeps one of each group of near copies; mixing orders the
rows by a Pfair schedule of their sources; byte-level BPE encodes what is left. Every stage is
written and read back, so a lost executor costs no earlier stage.

Mixing keeps every row. Its decision is the order: the part files, by name, and the rows in
them follow the mix. A later scan packs files by size and so loses that order, and the rows of
a stage that returns the columns of the documents have no other place for it. So the last
stage works the places out again, from all its rows, and returns the documents with their ids
and with ``block``, ``slot`` and ``place``; its part files are in that order too.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.llm import bpe, exact_dedup, language, mixing, simhash
from layerloom.llm.common import table
from layerloom.workspace import release, run_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Fixed by what the stages must do: three words a shingle, three bits apart.
SHINGLE_WORDS, MAX_BITS = 3, 3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    filters = language.fitted(docs)
    if not filters.names:  # no row names its language, so all would be undetermined
        return docs.filter(F.regexp_like(F.col("text"), F.lit(r"\p{L}")))
    rows = docs.select(F.struct("*").alias("row"), F.col("text"))
    judged = language.identified(rows, filters)
    return judged.filter(F.col("lang_pred") != language.UNDETERMINED).select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each_group(docs, shingle_words=SHINGLE_WORDS, radius=MAX_BITS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.in_mixed_order(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    placed = mixing.mix_sorted(mixing.mixed(docs))
    # The frequent words are of the rows as they were read, so that they are not sorted twice.
    encoded = bpe.encoded(placed, ranks, public_tokenizers.PATTERN, sampled=docs)
    found = encoded.withColumn("ids", bpe.id_array(F.col("ids")))
    decoded = bpe.decoded(found, "ids", ranks, "decoded_sha256")
    return decoded.withColumns(
        {"n_tokens": F.size("ids").cast("bigint"), "decoded_sha256": F.sha2("decoded_sha256", 256)}
    )


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("source_mix", source_mix),
    ("byte_bpe", byte_bpe),
]

#: Language identification, SimHash and BPE are beyond SQL; a brute-force test stands in.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in a row. What a stage wrote besides its result goes when the next one has ended.

    Null texts, texts without a letter, repeats and near copies go; a null id, language or
    source stays; an empty table gives an empty result. Very long texts are worked on whole.
    Columns that the documents have besides are kept, but for those the last stage adds
    (``block``, ``slot``, ``place``, ``n_tokens``, ``ids``, ``decoded_sha256``).
    """
    docs, done = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with run_folder(spark, name) as result, run_folder(spark, "steps") as steps:
            found = stage(spark, docs, sf_dir)
            place = f"{result}/rows"
            found.write.parquet(place)
        docs = spark.read.schema(found.schema).parquet(place)
        for folder in (*done, steps):
            release(spark, folder)
        done = [result]
    return docs
