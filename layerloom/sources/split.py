"""One huge JSON array, or CSV with line breaks in its values, read by many tasks.

Spark splits a text file at any separator a reader names, here the one that stands between
elements: a comma, or a line break. But a separator may also stand inside a string, or inside
an inner object, and a task that starts in mid-file can't see which. What a split does to the
state of the scan is the same few numbers wherever it starts: whether its quotes are odd, and
by how much brackets raise the depth if it starts outside a string, or inside one. So

1. each task reduces its splits to these numbers;
2. running sums over the splits of a file, a row each, give the state every split starts in;
3. each task scans its splits again, now knowing the state, and cuts them at the borders of the
   elements. What stands before a split's first border and behind its last one are pieces of
   elements that go over splits; they are put together in a scan of their own.

The scans go over whole chunks of bytes with NumPy. No task holds a file, nor more than one
element and one Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerloom.sources.records import found_schema
from layerloom.workspace import new_run_dir

Paths = str | list[str]
Schema = StructType | str

#: So many splits' states are sent to every task; of more, the rows are dealt by their split.
BROADCAST_SPLITS = 200_000

_QUOTE, _ESCAPE = ord('"'), ord("\\")
_MOVES = "file bigint, start bigint, odd int, outside bigint, inside bigint"
_FOUND = "file bigint, start bigint, nth bigint, begins boolean, ends boolean, opens boolean, closes boolean, text string"
_NO_ARRAY = "no JSON array"


def read_json_array_split(
    spark: SparkSession, path: Paths, schema: Schema | None = None, **options: str
) -> DataFrame:
    """Each file is one JSON array, each of its elements a row, and each split of it a task.

    Like :func:`read_json_array`, for files too big for a task. The files are UTF-8 and not
    compressed as a whole, which could not be split. Without ``schema`` it is found from all
    elements. An element that does not fit the schema gives nulls, as in Spark's own reader.
    A file that is cut, that goes on behind its array, or that is none, is an error.
    """
    found = _elements(spark, path, ",", nested=True)
    if schema is None:
        schema = found_schema(found, "text")
    return found.select(F.from_json("text", schema, options).alias("row")).select("row.*")


def read_csv_split(
    spark: SparkSession, path: Paths, schema: Schema, header: bool = True, **options: str
) -> DataFrame:
    """CSV with line breaks inside quoted values, each split of a file read by a task.

    Quotes stand only around whole values, and inside them are doubled or escaped by a
    backslash, as writers do. ``header`` drops each file's first record. A file that ends inside
    a quoted value is an error.
    """
    found = _elements(spark, path, "\n", nested=False)
    if header:
        found = found.filter((F.col("start") > 0) | (F.col("nth") > 0))
    record = F.regexp_replace("text", "\r$", "")
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"`{field.name.replace('`', '``')}` {field.dataType.simpleString()}" for field in schema.fields
    )
    rows = found.select(record.alias("record")).filter(~F.regexp_like("record", F.lit(r"^\s*$")))
    return rows.select(F.from_csv("record", F.lit(ddl), options).alias("row")).select("row.*")


def _elements(spark: SparkSession, path: Paths, separator: str, nested: bool) -> DataFrame:
    """``file, start, nth, text`` of every element: where it begins, by file, split and number."""
    lines = spark.read.option("lineSep", separator).text(path)
    name = F.col("_metadata.file_path")
    # A file goes by a hash of its path, as it stands beside every short fragment.
    fragments = lines.select(F.xxhash64(name).alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    entered, splits, cut = _entered(fragments, separator, nested)
    if cut is not None:
        file = lines.select(name.alias("name")).filter(F.xxhash64("name") == cut).head()["name"]
        raise ValueError(f"{_NO_ARRAY if nested else 'no CSV'}: {file} is cut")
    same = (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start"))
    if splits <= BROADCAST_SPLITS:  # a join that keeps the order of the fragments
        known = fragments.join(F.broadcast(entered), same)
    else:
        numbered = fragments.withColumn("row", F.monotonically_increasing_id())
        known = numbered.join(entered, same).repartition("file", "start").sortWithinPartitions("file", "start", "row")
    known = known.select("file", "start", "value", "quoted", "depth")
    found = known.mapInArrow(_cut(separator, nested), _FOUND)
    whole = found.filter("begins and ends").select("file", "start", "nth", "opens", "closes", "text")
    every = whole.unionByName(_joined(found.filter("not (begins and ends)")))
    blank = F.regexp_like("text", F.lit(r"^\s*$"))
    if not nested:
        return every.select("file", "start", "nth", "text")
    # The one blank text that is no fault is that of an empty array.
    every = every.filter(~(blank & F.col("opens") & F.col("closes")))
    fault = F.raise_error(F.concat(F.lit(f"{_NO_ARRAY}: an element is missing at byte "), F.col("start").cast("string")))
    text = F.when(blank, fault.cast("string")).otherwise(F.col("text"))
    return every.select("file", "start", "nth", text.alias("text"))


def _entered(fragments: DataFrame, separator: str, nested: bool) -> tuple[DataFrame, int, int | None]:
    """The state in which each split starts, how many splits there are, and a file that is cut."""
    spark = fragments.sparkSession
    path = new_run_dir(spark, "splits")
    fragments.mapInArrow(_moves(separator, nested), _MOVES).write.parquet(path)
    moves = spark.read.schema(_MOVES).parquet(path)
    so_far = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    odd = F.pmod(F.sum("odd").over(so_far), F.lit(2)).cast("int")
    left = moves.withColumn("left", odd)
    quoted = F.pmod(F.col("left") + F.col("odd"), F.lit(2)).cast("int")  # before this split's own quotes
    left = left.withColumn("quoted", quoted)
    rise = F.when(F.col("quoted") == 0, F.col("outside")).otherwise(F.col("inside"))
    left = left.withColumn("rise", rise).withColumn("deep", F.sum("rise").over(so_far))
    ended = left.groupBy("file").agg(F.max_by("left", "start").alias("left"), F.max_by("deep", "start").alias("deep"))
    cut = ended.filter("left <> 0 or deep <> 0").select("file").head()
    entered = left.select(
        F.col("file").alias("_file"), F.col("start").alias("_start"), "quoted", (F.col("deep") - F.col("rise")).alias("depth")
    )
    return entered, moves.count(), None if cut is None else cut["file"]


def _joined(pieces: DataFrame) -> DataFrame:
    """The elements that go over splits, each from its pieces: at most two pieces a split."""
    so_far = Window.partitionBy("file").orderBy("start", "nth").rowsBetween(Window.unboundedPreceding, 0)
    numbered = pieces.withColumn("element", F.sum(F.col("begins").cast("bigint")).over(so_far))
    parts = F.array_sort(F.collect_list(F.struct("start", "nth", "text")))
    whole = numbered.groupBy("file", "element").agg(
        F.min(F.struct("start", "nth")).alias("at"),
        F.bool_or("opens").alias("opens"),
        F.bool_or("closes").alias("closes"),
        parts.alias("parts"),
    )
    text = F.array_join(F.transform("parts", lambda part: part["text"]), "")
    return whole.select("file", "at.start", "at.nth", "opens", "closes", text.alias("text"))


def _splits(batches: Iterator) -> Iterator[tuple[tuple[int, int], list]]:
    """Consecutive rows of one split within a batch, as the split and its columns."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files, starts = (batch.column(i).to_numpy() for i in (0, 1))
        changes = np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1
        borders = [0, *changes.tolist(), batch.num_rows]
        for at, end in zip(borders, borders[1:], strict=False):
            yield (int(files[at]), int(starts[at])), [column[at:end] for column in batch.columns]


def _bytes(values, separator: str) -> np.ndarray:
    """The fragments as they stand in the file, each with the separator behind it."""
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = values.cast(pa.large_binary())
    ended = pc.binary_join_element_wise(texts, pa.scalar(b"", texts.type), pa.scalar(separator.encode(), texts.type))
    _, offsets, content = ended.buffers()
    first, last = np.frombuffer(offsets, np.int64)[[ended.offset, ended.offset + len(ended)]]
    return np.frombuffer(content, np.uint8)[first:last]


def _quotes(content: np.ndarray) -> np.ndarray:
    """Where quotes stand that are not escaped. No fragment starts behind a backslash."""
    quotes = content == _QUOTE
    escapes = content == _ESCAPE
    if not escapes.any():
        return quotes
    places = np.arange(len(content))
    other = np.maximum.accumulate(np.where(escapes, -1, places))  # the last byte that is no backslash
    before = np.concatenate([[0], (places - other)[:-1]])  # backslashes right before each byte
    return quotes & (before % 2 == 0)


def _brackets(content: np.ndarray) -> np.ndarray:
    opening = (content == ord("[")) | (content == ord("{"))
    closing = (content == ord("]")) | (content == ord("}"))
    return opening.astype(np.int8) - closing.astype(np.int8)


def _moves(separator: str, nested: bool):
    """What each split does to the state of the scan, a row a split."""

    def moves(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def row() -> pa.RecordBatch:
            columns = [[own[0]], [own[1]], [odd], [outside], [inside]]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["file", "start", "odd", "outside", "inside"])

        own, odd, outside, inside = None, 0, 0, 0
        for split, columns in _splits(batches):
            if split != own:
                if own is not None:
                    yield row()
                own, odd, outside, inside = split, 0, 0, 0
            content = _bytes(columns[2], separator)
            parity = (np.cumsum(_quotes(content)) + odd) % 2
            if nested:
                rises = _brackets(content)
                outside += int(rises[parity == 0].sum(dtype=np.int64))
                inside += int(rises[parity == 1].sum(dtype=np.int64))
            odd = int(parity[-1]) if len(parity) else odd
        if own is not None:
            yield row()

    return moves


def _cut(separator: str, nested: bool):
    """The elements that each split holds whole, and the pieces at its ends."""
    mark = ord(separator)

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64(), pa.int64(), pa.int64(), *[pa.bool_()] * 4, pa.string()]
        names = ["file", "start", "nth", "begins", "ends", "opens", "closes", "text"]

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        def rest() -> list[tuple]:
            """What is left when a split ends: a piece, unless it stands outside the array."""
            held = b"".join(scan.held)
            if scan.depth == 0 and nested:
                _only_blank(held)
                return []
            return [(*scan.split, scan.nth, scan.begins, False, scan.opens, False, held.decode(errors="replace"))] if held else []

        scan = None
        for split, columns in _splits(batches):
            if scan is None or scan.split != split:
                if scan is not None:
                    yield rows(rest())
                scan = _Scan(split, columns[3][0].as_py(), columns[4][0].as_py(), nested)
            yield rows(list(scan.elements(_bytes(columns[2], separator), mark)))
        if scan is not None:
            yield rows(rest())

    return cut


class _Scan:
    """The scan of one split, chunk after chunk."""

    def __init__(self, split: tuple[str, int], quoted: int, depth: int, nested: bool):
        self.split, self.quoted, self.depth, self.nested = split, quoted, depth, nested
        self.nth = 0
        self.held: list[bytes] = []  # of the element that is not ended
        # A split starts behind a separator, and so with an element if that was a border.
        self.begins = not quoted and depth == 1 if nested else not quoted
        self.opens = False

    def elements(self, content: np.ndarray, mark: int) -> Iterator[tuple]:
        quotes = _quotes(content)
        parity = (np.cumsum(quotes) + self.quoted) % 2
        if self.nested:
            rises = np.where(parity == 0, _brackets(content), 0)
            depths = self.depth + np.cumsum(rises, dtype=np.int64)
            opened = (depths == 1) & (rises == 1)
            closed = (depths == 0) & (rises == -1)
            borders = np.flatnonzero(((content == mark) & (parity == 0) & (depths == 1)) | opened | closed)
        else:
            borders = np.flatnonzero((content == mark) & (parity == 0))
        raw, at = content.tobytes(), 0
        for border in borders.tolist():
            self.held.append(raw[at:border])
            at = border + 1
            text = b"".join(self.held)
            self.held = []
            if self.nested and opened[border]:
                _only_blank(text)
                # What stands before an array has no comma, so the array begins in the first split.
                if raw[border : border + 1] != b"[" or self.nth or self.split[1]:
                    raise ValueError(f"{_NO_ARRAY}: the file is no array, or has more than one")
                self.begins = self.opens = True
                continue
            ends_all = bool(self.nested and closed[border])
            yield (*self.split, self.nth, self.begins, True, self.opens, ends_all, text.decode(errors="replace"))
            self.nth += 1
            self.begins, self.opens = not ends_all, False
        self.held.append(raw[at:])
        if len(content):
            self.quoted = int(parity[-1])
            self.depth = int(depths[-1]) if self.nested else 0


def _only_blank(text: bytes) -> None:
    # A byte order mark may stand first, and each fragment has a separator behind it.
    if text.removeprefix(b"\xef\xbb\xbf").strip(b" \t\r\n,"):
        raise ValueError(f"{_NO_ARRAY}: the file has text outside of one")

