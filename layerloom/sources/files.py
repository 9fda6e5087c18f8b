from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Paths = str | list[str]
Schema = StructType | str


def read_csv(
    spark: SparkSession,
    path: Paths,
    header: bool = True,
    infer_schema: bool = True,
    schema: Schema | None = None,
    **options: str,
) -> DataFrame:
    """CSV scan. A schema wins over inference, which costs a second pass over the files."""
    reader = spark.read.options(**options).option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    return reader.csv(path)


def read_json_lines(
    spark: SparkSession, path: Paths, schema: Schema | None = None, **options: str
) -> DataFrame:
    """One JSON object per line, so big files are split between tasks."""
    return _json(spark, path, schema, options)


def read_json_array(
    spark: SparkSession, path: Paths, schema: Schema | None = None, **options: str
) -> DataFrame:
    """Each file is one JSON array and each of its elements one row.

    One task takes a whole file, and Spark reads only its first array.
    """
    return _json(spark, path, schema, {"multiLine": "true", **options})


def read_json_one_array(
    spark: SparkSession, path: Paths, schema: Schema, **options: str
) -> DataFrame:
    """The elements of an array that ``write_json_one_array`` wrote, read line by line."""
    element = F.regexp_replace("value", r"^[\[,]", "").alias("element")
    lines = spark.read.text(path).select(element).filter(~F.col("element").isin("", "]"))
    return lines.select(F.from_json("element", schema, options).alias("row")).select("row.*")


def read_json_document(
    spark: SparkSession, path: Paths, schema: Schema | None = None, **options: str
) -> DataFrame:
    """Each file is one JSON object and gives one row; an empty file gives none.

    Spark reads only the first object of a file: files of many belong to
    :func:`read_json_lines`.
    """
    return _json(spark, path, schema, {"multiLine": "true", **options})


def read_whole_text(spark: SparkSession, path: Paths, **options: str) -> DataFrame:
    """One row per file, in ``value``; partition directories come back as columns.

    A file is read by one task, so this is for files of bounded size.
    """
    return spark.read.options(**options).text(path, wholetext=True)


def read_landed(spark: SparkSession, path: Paths, parameters: str | None = None) -> DataFrame:
    """Landed responses, one file each: the ``body`` and the request's parameters.

    The parameters are the folder names, as in ``league=140/season=2023/response.json``.
    ``parameters`` gives their types (``league string, season int``); without it Spark
    guesses, and reads ``007`` as 7. Files that Spark hides, with a name that starts with
    ``_`` or ``.``, are no responses: they give neither a row nor a reject.
    """
    reader = spark.read
    if parameters is not None:
        reader = reader.schema(f"value string, {parameters}")
    return reader.text(path, wholetext=True).withColumnRenamed("value", "body")


def read_text_lines(spark: SparkSession, path: Paths, **options: str) -> DataFrame:
    """One row per line, in ``value``."""
    return spark.read.options(**options).text(path)


def read_by_key(
    spark: SparkSession, path: str, schema: Schema, format: str = "json"
) -> DataFrame:
    """A per-key export. ``schema`` names the key too, as its files no longer hold it."""
    return spark.read.schema(schema).format(format).load(path)


def _json(
    spark: SparkSession, path: Paths, schema: Schema | None, options: dict[str, str]
) -> DataFrame:
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema is not None else reader).json(path)
