from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from layerloom.functions.json import LOSSLESS_TIME, json_text
from layerloom.sinks.tables import clustered, with_key
from layerloom.workspace import new_run_dir, release

KEEP_WHITE_SPACE = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(
    df: DataFrame, path: str, header: bool = True, mode: str = "overwrite", **options: str
) -> str:
    """Directory of CSV part files.

    Values keep their outer white space, which Spark would cut by default. CSV does not tell
    an empty string from a null: both read back as null. To read values with line breaks,
    pass ``multiLine="true"`` to the reader, which then takes a file in one task.
    """
    settings = {**LOSSLESS_TIME, **KEEP_WHITE_SPACE, **options}
    df.write.mode(mode).options(**settings).option("header", header).csv(path)
    return path


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite", **options: str) -> str:
    """Directory of part files with one JSON object per line; null fields are left out."""
    df.write.mode(mode).options(**{**LOSSLESS_TIME, **options}).json(path)
    return path


def write_json_array(
    df: DataFrame,
    path: str,
    pretty: bool = False,
    mode: str = "overwrite",
    rows_per_file: int | None = None,
) -> str:
    """Directory of part files that are each one valid JSON array; non-ASCII text is kept.

    Every task streams its own partition into one array: no shuffle and no gathered group.
    An empty partition gives ``[]``; where Spark finds the whole input empty and runs no
    partition, it leaves one empty file. A caller who needs a single file passes
    ``df.coalesce(1)`` and bears that cost.

    ``rows_per_file`` cuts a partition into several arrays of so many elements, one per
    file, for readers that take an array whole.
    """
    if rows_per_file is not None and rows_per_file < 1:
        raise ValueError("rows_per_file must be at least 1")
    elements = df.select(json_text(F.struct("*"), pretty).alias("value"))

    def bracketed(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        def lines(texts):
            return pa.RecordBatch.from_arrays([texts], ["value"])

        in_file = None  # elements in the open array, None before the first element
        string = pa.string()
        for batch in batches:
            rest = batch.column(0)
            string = rest.type
            while len(rest):
                room = len(rest) if rows_per_file is None else rows_per_file - (in_file or 0)
                texts, rest = rest[:room], rest[room:]
                opening = "," if in_file else "["
                lead = pa.array([opening] + [","] * (len(texts) - 1), string)
                yield lines(pc.binary_join_element_wise(lead, texts, pa.scalar("", string)))
                in_file = (in_file or 0) + len(texts)
                if in_file == rows_per_file:
                    yield lines(pa.array(["]"], string))
                    in_file = 0
        if in_file is None:
            yield lines(pa.array(["[]"], string))
        elif in_file:
            yield lines(pa.array(["]"], string))

    # A full array is its elements and the line of its closing bracket; 0 is no bound.
    lines_per_file = 0 if rows_per_file is None else rows_per_file + 1
    arrays = elements.mapInArrow(bracketed, "value string")
    arrays.write.mode(mode).option("maxRecordsPerFile", lines_per_file).text(path)
    return path


def write_json_one_array(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """One JSON array over all part files: joined in order of their names they are the array.

    The order of the elements is not fixed. What a file begins with must be known before it is
    written, so the elements are stored first, each once, in the shared working folder. Then
    one of them goes into the first file, behind the opening bracket; all others, each behind
    its comma, go into files that their tasks write side by side, in any number and order; and
    the closing bracket goes into the last. Nothing is shuffled or gathered. The last file is
    also the mark of a whole export: without it the array does not parse.

    Each line is one element, so tasks can read the array line by line again
    (``read_json_one_array``).
    """
    if mode not in ("overwrite", "error", "errorifexists"):
        raise ValueError(f"mode {mode!r}: an array that is written can not be added to")
    spark, staged = df.sparkSession, new_run_dir(df.sparkSession, "one_array")
    df.select(json_text(F.struct("*")).alias("value")).write.parquet(staged)
    try:
        stored = spark.read.schema("value string").parquet(staged)
        place = F.struct(F.col("_metadata.file_name"), F.col("_metadata.row_index"))
        first = stored.agg(F.min(place).alias("first")).first()["first"]
        if first is None:
            head, rest = spark.range(1).select(F.lit("[").alias("value")), None
        else:
            is_first = place == F.struct(F.lit(first[0]), F.lit(first[1]).cast("bigint"))
            head = stored.filter(is_first).select(F.concat(F.lit("["), "value").alias("value"))
            rest = stored.filter(~is_first).select(F.concat(F.lit(","), "value").alias("value"))
        tail = spark.range(1).select(F.lit("]").alias("value"))
        for number, lines in enumerate((head, rest, tail)):
            if lines is not None:
                writer = lines.write.mode("append" if number else mode)
                writer.option("mapreduce.output.basename", f"part-{number}").text(path)
    finally:
        release(spark, staged)
    return path


def write_json_arrays_by_key(
    df: DataFrame,
    path: str,
    key: Column | str,
    name: str,
    keys: Sequence[Any] | None = None,
    pretty: bool = False,
    mode: str = "overwrite",
) -> str:
    """JSON arrays per key, in ``<path>/<name>=<key>``, in one pass over the rows.

    Rows are clustered by key and sorted within their task; each file is one valid array of
    one key's rows, which keep all their columns. A hot key is split over tasks, and so
    over several arrays. ``key``, ``name`` and ``keys`` are as in ``write_by_key``.
    """
    row = json_text(F.struct(*(F.col(f"`{c}`") for c in df.columns)), pretty)
    keyed = with_key(df.withColumn("_array_row", row), key, name, keys)
    keyed = keyed.select(name, F.col("_array_row").alias("value"))
    ordered = clustered(keyed, name).sortWithinPartitions(name)
    schema = StructType([ordered.schema[name], *StructType.fromDDL("_line bigint, value string")])

    def bracketed(batches):
        """Each element with the bracket or comma before it, and a last bracket per key.

        Where the key changes, the element gets the opening bracket, and one line more closes
        the array before it. Elements have even numbers and closing lines odd ones, by which
        the lines are sorted.
        """
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        fields = to_arrow_schema(schema)

        def lines(keys, numbers, values):
            return pa.RecordBatch.from_arrays([keys, pa.array(numbers), values.cast(fields[2].type)], schema=fields)

        def same(one, other):
            """Equal keys, where null equals null."""
            both = pc.and_(pc.is_null(one), pc.is_null(other))
            return pc.or_(pc.fill_null(pc.equal(one, other), False), both).to_numpy(zero_copy_only=False)

        last, line = None, 0  # the key of the open array as an array of one, and the next number
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, values = batch.column(0).cast(fields[0].type), batch.column(1)
            goes_on = np.concatenate([[last is not None and bool(same(last, keys[:1])[0])], same(keys[:-1], keys[1:])])
            numbers = 2 * (line + np.arange(len(keys)))
            marks = pc.if_else(pa.array(goes_on), ",", "[").cast(values.type)
            yield lines(keys, numbers, pc.binary_join_element_wise(marks, values, pa.scalar("", values.type)))
            ended = np.flatnonzero(~goes_on)
            before = pa.concat_arrays([keys[:1] if last is None else last, keys]).take(pa.array(ended))
            if last is None:  # there is no array before the first
                ended, before = ended[1:], before[1:]
            yield lines(before, numbers[ended] - 1, pa.array(["]"] * len(ended), pa.string()))
            last, line = keys[-1:], line + len(keys)
        if last is not None:
            yield lines(last, np.array([2 * line - 1]), pa.array(["]"], pa.string()))

    # Sorted by key, as the writer asks for, and by line, so that it keeps this very order.
    lines = ordered.mapInArrow(bracketed, schema).sortWithinPartitions(name, "_line")
    lines.drop("_line").write.mode(mode).partitionBy(name).text(path)
    return path


def write_json_documents(
    df: DataFrame, path: str, pretty: bool = True, mode: str = "overwrite"
) -> str:
    """One file per row, each a whole JSON document."""
    documents = df.select(json_text(F.struct("*"), pretty).alias("value"))
    return write_text_files(documents, path, "value", mode)


def write_text(
    df: DataFrame,
    path: str,
    column: str = "value",
    mode: str = "overwrite",
    rows_per_file: int | None = None,
) -> str:
    """Text dataset of one string column, each value followed by a line break.

    A value that holds line breaks itself reads back as several lines. ``rows_per_file``
    bounds the size of the files (all rows are still written).
    """
    writer = df.select(F.col(column).alias("value")).write.mode(mode)
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.text(path)
    return path


def write_text_files(
    df: DataFrame, path: str, column: str = "value", mode: str = "overwrite"
) -> str:
    """One text file per row."""
    return write_text(df, path, column, mode, rows_per_file=1)
