"""Token ids in wavelet matrices, one compressed file per shard.

A wavelet matrix holds a sequence of ids as bit-planes, from the highest bit down. After
each plane the sequence is parted stably by that bit, zeros first. With the count of ones
before each position (rank), a token is read, a token's occurrences before a position are
counted, and its n-th occurrence is found, in one step per plane and without decoding the
rest. Each plane is stored compressed, beside a rank directory with a count for every 512
bits.

Documents go to shards in ascending order of their id: a range partitioning, sorted within
each task, which cuts its documents into shards of about ``shard_tokens``. Every document
ends with the end id. The shards are rows of a Parquet table, a file per task, and carry
the ids and lengths of their documents.

Defined cases: a null text is empty and holds only its end id. A null ``doc_id`` comes
first; rows that repeat an id are ordered by a hash of the text. The special tokens' strings
in a text are what the tokenizer file makes of them. Very long texts are encoded whole, and a
shard takes a text whole however long it is. An empty table gives an empty result. Other
columns play no part.
"""

from __future__ import annotations

import io
import os
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerloom.llm.common import whole_text
from layerloom.workspace import new_run_dir

SHARD_TOKENS = 1 << 22
END_ID = 0
#: A process keeps the ids of so many words at hand, in two halves: when the newer one is full,
#: it becomes the older one, and what of the older one was not used again goes.
KEPT_WORDS = 1_000_000
#: Texts of so many characters are parted into words together.
TOGETHER_CHARS = 1 << 22
DIRECTORY_BITS = 512

_SHARDS = "part int, shard int, n_tokens bigint, payload binary"
_DOCUMENTS = "part int, shard int, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint"


class WaveletMatrix:
    def __init__(self, length: int, planes: list[np.ndarray], counts: list[np.ndarray]):
        self.length = length
        self.planes = planes  # packed bits, highest plane first
        self.counts = counts  # ones before each DIRECTORY_BITS bits, and in all, per plane
        self.zeros = [length - int(ones[-1]) for ones in counts]

    @classmethod
    def of(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, counts = [], []
        for bit in range(bits - 1, -1, -1):
            ones = (ids >> ids.dtype.type(bit) & ids.dtype.type(1)).view(f"u{ids.dtype.itemsize}") != 0
            packed = np.packbits(ones, bitorder="little")
            packed = np.pad(packed, (0, -len(packed) % (DIRECTORY_BITS // 8)))
            planes.append(packed)
            counts.append(_directory(packed))
            ids = np.concatenate([ids.compress(~ones), ids.compress(ones)])
        return cls(len(ids), planes, counts)

    def all(self, dtype: np.dtype) -> np.ndarray:
        """The whole sequence: the partings are undone from the last plane up."""
        ids = np.zeros(self.length, dtype)
        for bit, (packed, zeros) in enumerate(zip(self.planes[::-1], self.zeros[::-1], strict=True)):
            ones = np.unpackbits(packed, count=self.length, bitorder="little").view(bool)
            ids[zeros:] |= dtype.type(1 << bit)
            before = np.empty_like(ids)
            before[~ones] = ids[:zeros]
            before[ones] = ids[zeros:]
            ids = before
        return ids

    def _ones(self, plane: int, position: int) -> int:
        """The number of ones before the position: directory, whole bytes, and a last byte."""
        packed = self.planes[plane]
        word, rest = divmod(position, DIRECTORY_BITS)
        start, end = word * (DIRECTORY_BITS // 8), position // 8
        ones = int(self.counts[plane][word]) + int(np.bitwise_count(packed[start:end]).sum())
        if rest % 8:
            ones += (int(packed[end]) & ((1 << rest % 8) - 1)).bit_count()
        return ones

    def _bit(self, plane: int, position: int) -> int:
        return int(self.planes[plane][position >> 3]) >> (position & 7) & 1

    def access(self, position: int) -> int:
        if not 0 <= position < self.length:
            raise IndexError(position)
        token = 0
        for plane, zeros in enumerate(self.zeros):
            bit, ones = self._bit(plane, position), self._ones(plane, position)
            token = token << 1 | bit
            position = zeros + ones if bit else position - ones
        return token

    def rank(self, token: int, position: int) -> int:
        """How often the token occurs before the position."""
        start, end = self._range(token, position)
        return end - start

    def count(self, token: int) -> int:
        return self.rank(token, self.length)

    def select(self, token: int, number: int) -> int:
        """The position of the token's occurrence of that number, from 0."""
        start, end = self._range(token, self.length)
        if not 0 <= number < end - start:
            raise IndexError(number)
        position = start + number
        for plane in range(len(self.planes) - 1, -1, -1):
            if token >> (len(self.planes) - 1 - plane) & 1:
                position = self._nth(plane, position - self.zeros[plane], ones=True)
            else:
                position = self._nth(plane, position, ones=False)
        return position

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, number) for number in range(self.count(token))]

    def _range(self, token: int, position: int) -> tuple[int, int]:
        """Where the token's occurrences before the position stand below the last plane."""
        if token >> len(self.planes):
            return 0, 0
        start, end = 0, position
        for plane, zeros in enumerate(self.zeros):
            low, high = self._ones(plane, start), self._ones(plane, end)
            if token >> (len(self.planes) - 1 - plane) & 1:
                start, end = zeros + low, zeros + high
            else:
                start, end = start - low, end - high
        return start, end

    def _nth(self, plane: int, number: int, ones: bool) -> int:
        """The position of the plane's one (or zero) of that number, by halving."""
        low, high = 0, self.length
        while high - low > 1:
            middle = (low + high) // 2
            before = self._ones(plane, middle)
            if (before if ones else middle - before) <= number:
                low = middle
            else:
                high = middle
        return low


def _directory(packed: np.ndarray) -> np.ndarray:
    ones = np.bitwise_count(packed.view(np.uint64)).reshape(-1, DIRECTORY_BITS // 64).sum(axis=1)
    return np.concatenate([[0], np.cumsum(ones, dtype=np.int64)])


def written(matrix: WaveletMatrix, doc_ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """A shard's file: NumPy arrays, one behind the other, in one compressed stream each."""
    out = io.BytesIO()
    sizes = np.array([matrix.length, len(matrix.planes)], np.int64)
    for array in (sizes, doc_ids, lengths, *matrix.planes, *matrix.counts):
        packed = zstandard.compress(array.tobytes(), 1)
        out.write(len(packed).to_bytes(8, "little") + packed)
    return out.getvalue()


def opened(payload: bytes) -> tuple[WaveletMatrix, np.ndarray, np.ndarray]:
    arrays, at = [], 0
    while at < len(payload):
        size = int.from_bytes(payload[at : at + 8], "little")
        arrays.append(zstandard.decompress(payload[at + 8 : at + 8 + size]))
        at += 8 + size
    length, bits = np.frombuffer(arrays[0], np.int64).tolist()
    doc_ids, lengths = (np.frombuffer(array, np.int64) for array in arrays[1:3])
    planes = [np.frombuffer(array, np.uint8) for array in arrays[3 : 3 + bits]]
    counts = [np.frombuffer(array, np.int64) for array in arrays[3 + bits :]]
    return WaveletMatrix(length, planes, counts), doc_ids, lengths


class Encoder:
    """Ids of whole texts by a ``tokenizers`` file with the byte-level pre-tokenizer.

    A single space between characters that are not white space always begins a pre-token,
    so what stands between two such spaces has the same ids everywhere. Those words are
    encoded once and kept; texts with other white space next to a space, or with the string of
    a special token, are encoded whole.
    """

    _WHITE = "".join(c for c in map(chr, range(0x110000)) if c.isspace())
    #: So many new words are encoded as one text.
    _JOINED = 512

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.marks = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.bits = max(1, (size - 1).bit_length())
        # In this alphabet each character of a token is a byte of the text.
        self.lengths = np.zeros(size, np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            if number < size:
                self.lengths[number] = len(token)
        # The ids of a word behind a space, by the word; those of a text's first word, by the
        # word behind a space, as no other word holds one.
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encoded(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, packed in the smallest type that holds them."""
        alone = [self._alone(text) for text in texts]
        parted = pa.array([text for text, whole in zip(texts, alone, strict=True) if not whole], pa.large_string())
        lists = pc.split_pattern(parted, " ")
        begins = lists.offsets.to_numpy()[:-1]
        words = pc.dictionary_encode(lists.values)
        numbers = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # A text's first word has no space before it: those are entries of their own.
        first = pc.dictionary_encode(lists.values.take(pa.array(begins)))
        distinct = words.dictionary.to_pylist()
        numbers[begins] = first.indices.to_numpy(zero_copy_only=False) + np.int64(len(distinct))
        found = self._of_words(distinct + [" " + word for word in first.dictionary.to_pylist()])
        ids, ends = _gathered(found, numbers, self.dtype)
        # Where a text ends is where its last word does.
        of_texts = iter(np.split(ids, ends[lists.offsets.to_numpy()[1:-1] - 1]) if len(parted) else [])
        others = iter(self._ids([text for text, whole in zip(texts, alone, strict=True) if whole]))
        return [np.frombuffer(next(others), self.dtype) if whole else next(of_texts) for whole in alone]

    def _of_words(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words, kept ones or new ones."""
        if len(self.kept) > KEPT_WORDS // 2:
            self.kept, self.older = {}, self.kept
        kept, older = self.kept, self.older
        found = list(map(kept.get, words))
        absent = [number for number, ids in enumerate(found) if ids is None]
        missing = [words[number] for number in absent]
        kept.update((word, older[word]) for word in missing if word in older)
        missing = [word for word in missing if word not in kept]
        first = [word for word in missing if word[:1] == " "]
        later = [word for word in missing if word[:1] != " "]
        kept.update(zip(first, self._ids([word[1:] for word in first]), strict=True))
        for at in range(0, len(later), self._JOINED):
            some = later[at : at + self._JOINED]
            kept.update(zip(some, self._joined_ids(some), strict=True))
        for number in absent:
            found[number] = kept[words[number]]
        return found

    def _joined_ids(self, words: list[str]) -> list[bytes]:
        """The ids of each word behind a space: of all as one text, cut where the words end.

        A call for each word takes nearly three times as long.
        """
        behind = [" " + word for word in words]
        text = "".join(behind)
        if not any(mark in text for mark in self.marks):  # as a mark may hold a space
            (ids,) = self._ids([text])
            ends = np.cumsum(self.lengths[np.frombuffer(ids, self.dtype)])
            sizes = map(len, behind if text.isascii() else map(str.encode, behind))
            borders = np.cumsum(np.fromiter(sizes, np.int64, len(behind)))
            at = np.searchsorted(ends, borders)
            # A file that adds, drops or joins bytes would show here.
            if len(ends) and ends[-1] == borders[-1] and np.array_equal(ends[at], borders):
                cuts = [0, *((at + 1) * self.dtype.itemsize).tolist()]
                return [ids[start:end] for start, end in zip(cuts, cuts[1:], strict=False)]
        return self._ids(behind)

    def _ids(self, texts: list[str]) -> list[bytes]:
        packed = []
        for at in range(0, len(texts), 4096):
            found = self.tokenizer.encode_batch_fast(texts[at : at + 4096], add_special_tokens=False)
            packed += [np.array(one.ids, self.dtype).tobytes() for one in found]
        return packed

    def _alone(self, text: str) -> bool:
        """Whether the text must be encoded whole, as its words do not encode by themselves."""
        if not text:
            return True
        # A space at an end of the text, or beside other white space.
        if text[0] == " " or text[-1] == " ":
            return True
        if any(white in text and (white + " " in text or " " + white in text) for white in self._WHITE):
            return True
        return any(mark in text for mark in self.marks)


def _gathered(entries: list[bytes], numbers: np.ndarray, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the entries of these numbers, one behind the other, and where each one's end."""
    table = np.frombuffer(b"".join(entries), dtype)
    sizes = np.fromiter(map(len, entries), np.int64, len(entries)) // dtype.itemsize
    starts = np.cumsum(sizes) - sizes
    taken = sizes[numbers]
    ends = np.cumsum(taken)
    places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[numbers] - (ends - taken), taken)
    return table[places], ends


@cache
def _encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def write_shards(
    docs: DataFrame,
    tokenizer_file: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
) -> str:
    """Encode all texts and write their shards; the result is the path of the table."""
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:
        # A tokenizer file has a fixed size, which bounds this broadcast.
        vocabulary = spark.sparkContext.broadcast(file.read())
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), whole_text(F.col(text)).alias("text"))
    texts = texts.withColumn("tie", F.xxhash64("text"))
    ordered = texts.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        encoder = _encoder(vocabulary.value)
        end = np.array([end_id], encoder.dtype)
        held: list[np.ndarray] = []
        ids: list[int | None] = []
        size = 0
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for doc, found in _in_order(rows, encoder):
                held.append(np.concatenate([found, end]))
                ids.append(doc)
                size += len(held[-1])
                if size >= shard_tokens:
                    yield _shard(part, number, ids, held, encoder.bits)
                    held, ids, size, number = [], [], 0, number + 1
        if held:
            yield _shard(part, number, ids, held, encoder.bits)

    path = new_run_dir(spark, "wavelet_shards")
    # The planes are compressed already.
    ordered.select("doc_id", "text").mapInArrow(shards, _SHARDS).write.option(
        "compression", "none"
    ).parquet(path)
    return path


def _in_order(rows: Iterator[tuple], encoder: Encoder) -> Iterator[tuple[int | None, np.ndarray]]:
    """Texts are encoded some megabytes at a time, so that each distinct word is looked up once in them."""
    waiting: list[tuple] = []
    size = 0
    for row in rows:
        waiting.append(row)
        size += len(row[1])
        if size >= TOGETHER_CHARS:
            yield from _encoded(waiting, encoder)
            waiting, size = [], 0
    yield from _encoded(waiting, encoder)


def _encoded(rows: list[tuple], encoder: Encoder) -> Iterator[tuple[int | None, np.ndarray]]:
    found = encoder.encoded([text for _, text in rows])
    return zip((doc for doc, _ in rows), found, strict=True)


#: Stands for a null id in a shard's list.
_NO_ID = np.iinfo(np.int64).min


def _shard(part: int, number: int, ids: list, held: list[np.ndarray], bits: int) -> pa.RecordBatch:
    tokens = np.concatenate(held)
    doc_ids = np.array([_NO_ID if doc is None else doc for doc in ids], np.int64)
    lengths = np.array([len(one) for one in held], np.int64)
    payload = written(WaveletMatrix.of(tokens, bits), doc_ids, lengths)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int32()),
            pa.array([number], pa.int32()),
            pa.array([len(tokens)], pa.int64()),
            pa.array([payload], pa.binary()),
        ],
        ["part", "shard", "n_tokens", "payload"],
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of all documents, from the shards alone."""
    shards = spark.read.schema(_SHARDS).parquet(path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, shard, _, payload = (column[row].as_py() for column in batch.columns)
                matrix, doc_ids, lengths = opened(payload)
                dtype = np.dtype("<u2" if len(matrix.planes) <= 16 else "<u4")
                tokens = matrix.all(dtype)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                checks = [
                    zlib.crc32(tokens[start:end].astype("<u4").tobytes())
                    for start, end in zip(starts.tolist(), ends.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(ends), pa.int32()),
                        pa.array([shard] * len(ends), pa.int32()),
                        pa.array(doc_ids, mask=doc_ids == _NO_ID),
                        pa.array(starts),
                        pa.array(lengths),
                        pa.array(checks, pa.int64()),
                    ],
                    ["part", "shard", "doc_id", "before", "n_tokens", "ids_crc32"],
                )

    sizes = shards.select("part", "shard", "n_tokens")
    # Offsets of the tasks, a row each, and of a task's shards within it.
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "part", "shard", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("shard_start")
    ).join(parts, "part")
    start = F.col("part_start") + F.col("shard_start") + F.col("before")
    return (
        shards.mapInArrow(documents, _DOCUMENTS)
        .join(offsets, ["part", "shard"])
        .select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")
    )
