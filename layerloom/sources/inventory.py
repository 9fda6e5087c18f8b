from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom import storage

_NO_FILES = "name string, path string, size bigint"


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """``name``, ``path`` and ``size`` of every data file at any depth below ``path``.

    Only file listings are read, no file content. Names that Spark hides (leading ``_``
    or ``.``) are not listed. A missing path gives no rows.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        files = reader.load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _NO_FILES)
    return files.select(
        F.substring_index("path", "/", -1).alias("name"),
        "path",
        F.col("length").alias("size"),
    )


def directory_entries(spark: SparkSession, path: str) -> DataFrame:
    """Direct children of ``path``: ``name``, ``path``, ``size`` and ``is_dir``.

    Only the one level is listed on the driver, hidden names and empty directories included.
    What lies below is listed by Spark, which deals many directories over the executors, and a
    directory's size is rolled up from the data files at any depth below it; files that Spark
    hides there count nothing. A missing path gives no rows.
    """
    entries = list(storage.children(spark, path))
    listed = spark.createDataFrame(entries, f"{_NO_FILES}, is_dir boolean")
    folders = [entry.path for entry in entries if entry.is_dir]
    if not folders:
        return listed
    below = _rolled_up(spark, folders, folders[0].rsplit("/", 1)[0])
    size = F.coalesce("below", F.col("size")).alias("size")
    return listed.join(below, "name", "left").select("name", "path", size, "is_dir")


def _rolled_up(spark: SparkSession, folders: list[str], parent: str) -> DataFrame:
    """``name`` of each folder right below ``parent`` that has files, and their size ``below``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.load([storage.literal(folder) for folder in folders])
    within = F.substring("path", len(parent) + 2, 1 << 30)
    return files.groupBy(F.substring_index(within, "/", 1).alias("name")).agg(F.sum("length").alias("below"))
