"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.workspace import new_run_dir


def settled(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet in the shared folder and read back.

    It cuts the lineage, survives the loss of executors, and gives the planner the real
    size of the table, by which it chooses between a broadcast and a shuffle.
    """
    path = new_run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def others(columns: Sequence[str], *added: str) -> list[str]:
    """The columns that stay beside added ones: names that differ only by case clash as well."""
    taken = {name.lower() for name in added}
    return [name for name in columns if name.lower() not in taken]


def whole_text(column: Column | str) -> Column:
    """The text, where a missing one counts as empty."""
    return F.coalesce(column, F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_digest(text: Column | str) -> Column:
    """With the id it names a row: rows that share both are repeats of one document."""
    return F.sha2(whole_text(text).cast("binary"), 256)


def rows_named(docs: DataFrame, names: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows whose id and text digest are listed in ``doc_id, digest``; of repeats, one."""
    listed = names.select(F.col("doc_id").alias("listed_id"), F.col("digest").alias("listed_digest"))
    # The row as one field, so that no name of its columns can clash.
    named = docs.select(
        F.struct("*").alias("row"), F.col(doc_id).alias("id"), text_digest(F.col(text)).alias("digest")
    )
    same = (F.col("digest") == F.col("listed_digest")) & F.col("id").eqNullSafe(F.col("listed_id"))
    kept = named.join(listed, same, "left_semi").dropDuplicates(["id", "digest"])
    return kept.select("row.*")
