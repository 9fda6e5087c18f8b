"""Edit-aware token counts: a segment tree of pre-tokens per document.

A byte-level tokenizer splits a text into pre-tokens and encodes each by itself, so a
text's token count is the sum over its pre-tokens. A document keeps that sum as a segment
tree: a leaf per pre-token with its characters and tokens, and in each node the sums of its
subtree. An edit finds its first leaf by the characters' sums, splits again from there, and
stops as soon as a split falls on an old leaf's border behind the edit. Only the leaves in
between are encoded again, and only the sums above them change.

How far an edit reaches back follows from the pattern: a pre-token may depend on the two
characters behind its end (``\\s+(?!\\S)`` looks past the end of white space, ``'ll`` is
three characters), so splitting starts at the first leaf that ends less than two characters
before the edit. Forwards, a split at a border with the same text behind it gives the same
leaves as before.

The tree of a document is kept as two binary columns, its leaves' characters and tokens, a
byte each where they all fit, else 32 bits; the sums above are rebuilt when it is read. A
document that no edit touches is neither split nor encoded again: its count is the sum of
what was kept.

Defined cases: rows that repeat a document are counted each, and very long texts whole. A null text is an empty text without leaves. Edits are sorted by start; one
that begins inside an earlier one begins at that one's end instead, and what lies beyond
the text is cut off. Null edits, and null parts of an edit, change nothing. Equal edits at
one place apply one after the other. Other columns play no part.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from layerloom.llm.common import whole_text

#: Characters behind a pre-token's end that it may depend on.
CONTEXT = 2
KEPT_WORDS = 300_000
TREE = "struct<chars:binary,tokens:binary>"
EDITS = "array<struct<start:bigint,stop:bigint,replacement:string>>"

Edit = tuple[int, int, str]
Counter = Callable[[list[str]], list[int]]


class Tree:
    """Sums of characters and tokens over leaves; ``sums[1]`` is the root."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.size = 1 << max(0, len(chars) - 1).bit_length()
        level = np.zeros((self.size, 2), np.int64)
        level[: len(chars), 0], level[: len(chars), 1] = chars, tokens
        self.sums = np.zeros((2 * self.size, 2), np.int64)
        self.sums[self.size :] = level
        start = self.size
        while start > 1:
            below = self.sums[start : 2 * start]
            self.sums[start // 2 : start] = below[0::2] + below[1::2]
            start //= 2
        self.leaves = len(chars)

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaf_at(self, position: int) -> tuple[int, int]:
        """The leaf that holds the character, and its start; behind the end, past the last."""
        if position >= self.chars:
            return self.leaves, self.chars
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if position >= start + self.sums[node, 0]:
                start += int(self.sums[node, 0])
                node += 1
        return node - self.size, start

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.size
        change = np.array([chars, tokens]) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2


def recount(
    text: str, chars: np.ndarray, tokens: np.ndarray, edits: Iterable[Edit], count: Counter, pattern: regex.Pattern
) -> tuple[str, np.ndarray, np.ndarray, Tree, int]:
    """The edited text, its leaves, the updated tree, and how many leaves were encoded.

    The tree keeps the old leaves' places: what replaces several leaves stands in the first
    of them, the others become empty.
    """
    old = Tree(chars, tokens)
    new_text, spans = _spliced(text, edits)
    kept_chars, kept_tokens = [], []
    changes: list[tuple[int, int, int, int]] = []  # first old leaf, one past the last, sums
    done = encoded = at = 0  # old leaves done; number of the next span
    while at < len(spans):
        first, start = old.leaf_at(max(0, spans[at][0] - CONTEXT))
        if first == old.leaves and first > done:  # nothing behind: the last leaf may still grow
            first, start = old.leaf_at(old.chars - 1)
        if first < done:
            first, start = done, int(chars[:done].sum())
        shift = spans[at][2] - spans[at][0]
        position, pieces, last = start + shift, [], old.leaves
        while position < len(new_text):
            end = pattern.match(new_text, position).end()
            pieces.append(new_text[position:end])
            position = end
            while at + 1 < len(spans) and position > spans[at + 1][2] - CONTEXT:
                at += 1
            _, old_end, _, new_end = spans[at]
            if position >= new_end:
                leaf, border = old.leaf_at(old_end + position - new_end)
                if border == old_end + position - new_end:
                    last = leaf
                    break
        counts = count(pieces)
        kept_chars += [chars[done:first], [len(piece) for piece in pieces]]
        kept_tokens += [tokens[done:first], counts]
        changes.append((first, last, sum(map(len, pieces)), sum(counts)))
        encoded += len(pieces)
        done, at = last, at + 1
    kept_chars.append(chars[done:])
    kept_tokens.append(tokens[done:])
    grown = 0
    for first, last, sum_chars, sum_tokens in changes:
        if first == last:  # nothing old to stand in: text was added behind the last leaf
            grown = 1
            continue
        old.set(first, sum_chars, sum_tokens)
        for leaf in range(first + 1, last):
            old.set(leaf, 0, 0)
    new_chars = np.concatenate(kept_chars).astype(np.int32)
    new_tokens = np.concatenate(kept_tokens).astype(np.int32)
    tree = Tree(new_chars, new_tokens) if grown else old
    return new_text, new_chars, new_tokens, tree, encoded


def _spliced(text: str, edits: Iterable[Edit]) -> tuple[str, list[tuple[int, int, int, int]]]:
    """The edited text, and each edit's start and end in the old and in the new text."""
    parts, spans, done, length = [], [], 0, 0
    for start, stop, replacement in sorted(edits, key=lambda edit: edit[0]):
        start = min(max(start, done), len(text))
        stop = min(max(stop, start), len(text))
        parts += [text[done:start], replacement]
        length += start - done
        spans.append((start, stop, length, length + len(replacement)))
        length += len(replacement)
        done = stop
    return "".join([*parts, text[done:]]), spans


@cache
def _pattern(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


@cache
def _counter(ranks: bytes, pattern: str) -> Counter:
    """Counts the tokens of pre-tokens; a process keeps those of the words it has met."""
    pairs = (line.split() for line in ranks.splitlines() if line)
    table = {base64.b64decode(token): int(rank) for token, rank in pairs}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    kept: dict[str, int] = {}

    def count(pieces: list[str]) -> list[int]:
        if len(kept) > KEPT_WORDS:
            kept.clear()
        counts = []
        for piece in pieces:
            known = kept.get(piece)
            if known is None:
                known = kept[piece] = len(encoding.encode_ordinary(piece))
            counts.append(known)
        return counts

    return count


COUNTS = ("n_tokens_before", "n_edits", "n_tokens", "n_pretokens", "n_reencoded")
_ROWS = 256


def recounted(
    docs: DataFrame,
    rank_file: str,
    pattern: str,
    edits: Column | None = None,
    masks: Mapping[str, str] | None = None,
    tree: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: bool = False,
) -> DataFrame:
    """``doc_id`` with the token counts before and after the edits.

    ``edits`` is an array of ``start, stop, replacement`` in characters of the text;
    ``masks`` adds edits that replace what a pattern matches. ``tree`` is a kept tree, a
    struct of ``chars, tokens``; without it the tree is grown from the text. With ``keep``
    the edited ``text`` and its ``tree`` are returned too, to be stored for the next edits.
    """
    with open(rank_file, "rb") as file:
        # A rank file has a fixed size, which bounds this broadcast.
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        whole_text(F.col(text)).alias("text"),
        (F.lit(None) if edits is None else edits).cast(EDITS).alias("edits"),
        (F.lit(None) if tree is None else tree).cast(TREE).alias("tree"),
    )
    added = ", ".join(f"{name} bigint" for name in COUNTS) + (f", text string, tree {TREE}" if keep else "")
    schema = StructType([rows.schema["doc_id"], *StructType.fromDDL(added)])
    patterns = list((masks or {}).items())

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, split = _counter(ranks.value, pattern), _pattern(pattern)
        arrow = to_arrow_schema(schema)
        # A few rows at a time, so that only their trees and words are objects at once.
        for part in (b.slice(at, _ROWS) for b in batches for at in range(0, b.num_rows, _ROWS)):
            found = [_updated(row, patterns, count, split, keep) for row in part.to_pylist()]
            yield pa.RecordBatch.from_pylist(found, arrow)

    return rows.mapInArrow(update, schema)


def _updated(row: dict, masks: list[tuple[str, str]], count: Counter, split: regex.Pattern, keep: bool) -> dict:
    text = row["text"]
    if row["tree"] is None:
        pieces = split.findall(text)
        chars, tokens = np.fromiter(map(len, pieces), np.int32, len(pieces)), np.array(count(pieces), np.int32)
    else:
        chars, tokens = (_unpacked(row["tree"][name]) for name in ("chars", "tokens"))
    edits = _usable(row["edits"])
    edits += [(m.start(), m.end(), new) for old, new in masks for m in _pattern(old).finditer(text)]
    before = total = int(tokens.sum())
    encoded = 0
    if edits:
        text, chars, tokens, updated, encoded = recount(text, chars, tokens, edits, count, split)
        total = updated.tokens
    counts = dict(zip(COUNTS, (before, len(edits), total, len(chars), encoded), strict=True))
    kept = {"text": text, "tree": {"chars": _packed(chars), "tokens": _packed(tokens)}} if keep else {}
    return {"doc_id": row["doc_id"], **counts, **kept}


def _packed(values: np.ndarray) -> bytes:
    """The values behind a byte that says how many bytes each takes."""
    small = not len(values) or int(values.max()) < 256
    return (b"\x01" + values.astype(np.uint8).tobytes()) if small else (b"\x04" + values.astype("<i4").tobytes())


def _unpacked(packed: bytes) -> np.ndarray:
    kind = np.uint8 if packed[:1] == b"\x01" else np.dtype("<i4")
    return np.frombuffer(packed, kind, offset=1).astype(np.int32)


def _usable(edits: list[dict] | None) -> list[Edit]:
    rows = [edit for edit in edits or [] if edit is not None and None not in edit.values()]
    return [(edit["start"], edit["stop"], edit["replacement"]) for edit in rows]
