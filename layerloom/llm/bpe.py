"""Byte-level BPE in Spark's higher-order functions: encoding and decoding.

A word is an array of bytes, and each byte is a token. A fold merges, again and again, the
adjacent pair whose merged token has the lowest rank, until no pair is in the rank map. The
rank map and the table of tokens are values of the plan, not rows of a join. They come from scalar
subqueries, which become literals when a query starts; written into the expressions, they
would stand in the text of every plan, which the driver keeps. Tokens are written as
single characters whose code points rise with the rank: a word is then a short string, the
lowest rank is the least merged character, and one ``replace`` merges all its occurrences.
That equals merging one by one from the left for every vocabulary in which each token is
what its own bytes encode to; :func:`vocabulary` checks that.

Most of a text is made of frequent words. The distinct words of a bounded sample are folded
first, once each, and the ``kept`` most frequent of them become a value of the same kind, with
frequent beginnings and ends of words. Another word is joined from two such parts where the
tokens at the seam are known to be neighbours, see :func:`_joined_ids`, and is folded where it
stands if not, so the sample decides the speed and never the result. Nothing is joined or shuffled but the sample's words.

Words are the matches of the tokenizer's pattern. Where every space stands between
characters that are not white space, a space always begins a match, so that such texts are
cut at their spaces, which is cheaper, and the pattern runs within an unknown word only.

Decoding looks up each id's bytes and concatenates the pieces.

Defined cases: a null text is an empty text and has no ids. Null ids decode to nothing.
An id outside the vocabulary is an error. Rows that repeat a document are encoded each. Very
long texts are encoded whole; a single word of many thousand bytes takes long, as each merge goes
over all of it. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.llm.common import others, settled, whole_text
from layerloom.workspace import release, run_folder

SAMPLE_DOCS = 100_000
KEPT_WORDS = 1_000_000

_BUCKETS = 1 << 15
#: Of the table of kept words: a few words each.
_KEPT_BUCKETS = 1 << 19
_FIRST = 0x100
#: Marks in literals; words that hold one are not kept.
_KEY, _VALUE, _BUCKET = "\x01", "\x02", "\x03"
#: Marks of what else the table of kept words holds: beginnings and ends of words, and seams.
_BEGIN, _END, _SEAM = "\x04", "\x05", "\x06"
_MARKS = f"[{_KEY}-{_SEAM}]"
#: Where a word is parted, in characters from its end, the likeliest first.
_CUTS = (4, 5, 6, 3, 7, 8, 2)
_LONGEST_BEGIN = 12
_DONE = "\x00"
#: Above every symbol.
_NONE = chr(0x10FFFF)
_SURROGATES = 0xD800, 0x800


@dataclass(frozen=True)
class Vocabulary:
    """Bytes of each id, and the two tokens that each longer one is merged from."""

    pieces: list[bytes]
    pairs: dict[int, tuple[int, int]]


@cache
def vocabulary(rank_file: str) -> Vocabulary:
    """Read a rank file: a token in base 64 and its rank in each line."""
    with open(rank_file, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be the numbers from 0 on")
    return Vocabulary(sorted(ranks, key=ranks.__getitem__), {r: _pair(t, ranks) for t, r in ranks.items() if len(t) > 1})


def _pair(token: bytes, ranks: dict[bytes, int]) -> tuple[int, int]:
    """What is left of a token's bytes before its own merge."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        merges = [(ranks.get(a + b, len(ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
        rank, at = min(merges)
        if rank >= ranks[token]:
            raise ValueError(f"token {token!r} is not what its bytes encode to")
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return ranks[parts[0]], ranks[parts[1]]


def _symbol(token: int) -> str:
    point = _FIRST + token
    return chr(point if point < _SURROGATES[0] else point + _SURROGATES[1])


def _token(symbol: Column) -> Column:
    point = F.ascii(symbol)
    return F.when(point < _SURROGATES[0], point - _FIRST).otherwise(point - _FIRST - _SURROGATES[1])


def _bucket(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode(), seed=42) & (_BUCKETS - 1)


def _bucket_column(key: Column, buckets: int = _BUCKETS) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(buckets - 1)).cast("int")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _rank_map(words: Vocabulary) -> list[str]:
    """The merges of each hash bucket, as a mark, the pair of symbols and the merged one."""
    buckets = [_NONE] * _BUCKETS
    for token, (one, other) in words.pairs.items():
        pair = _symbol(one) + _symbol(other)
        buckets[_bucket(pair)] += _KEY + pair + _symbol(token)
    return buckets


def _merge_of(pair: Column, rank_map: Column) -> Column:
    """The symbol a pair merges to. Without one it is what its bucket begins with."""
    entries, sought = F.get(rank_map, _bucket_column(pair)), F.concat(F.lit(_KEY), pair)
    behind = F.call_function("substring_index", entries, sought, F.lit(-1))
    return F.substring(behind, 1, 1)


def _pair_table(words: Vocabulary) -> list[str]:
    """Each id's pair of symbols; nothing for single bytes."""
    pairs = [words.pairs.get(token) for token in range(len(words.pieces))]
    return [_symbol(pair[0]) + _symbol(pair[1]) if pair else "" for pair in pairs]


def _piece_table(words: Vocabulary) -> list[str]:
    """Each id's bytes, a byte as the character of its number, since a join takes strings."""
    return [piece.decode("latin-1") for piece in words.pieces]


def _value(spark: SparkSession, strings: list[str]) -> Column:
    """An array as a subquery. It may stand in a column of its own only, see :func:`encoded`."""
    one = spark.createDataFrame([(strings,)], "strings array<string>")
    return one.select("strings").scalar()


def folded(word: Column, words: Vocabulary, rank_map: Column, pair_of: Column) -> Column:
    """The symbols of a word: ranked merges folded over its bytes."""
    single = {piece[0]: token for token, piece in enumerate(words.pieces) if len(piece) == 1}
    latin = "".join(map(chr, range(256)))
    own = "".join(_symbol(single[byte]) for byte in range(256))
    content = F.translate(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), latin, own)

    def merged(symbols: Column) -> Column:
        at = F.sequence(F.lit(1), F.length(symbols) - 1)
        best = F.array_min(F.transform(at, lambda i: _merge_of(F.substring(symbols, i, F.lit(2)), rank_map)))
        return _let(
            best,
            lambda m: F.when(m < _NONE, F.replace(symbols, F.get(pair_of, _token(m)), m)).otherwise(
                F.concat(symbols, F.lit(_DONE))
            ),
        )

    def fold(start: Column) -> Column:
        steps = F.sequence(F.lit(1), F.length(start))
        return F.aggregate(
            steps, start, lambda s, _: F.when((F.length(s) < 2) | F.endswith(s, F.lit(_DONE)), s).otherwise(merged(s))
        )

    return F.replace(_let(content, fold), F.lit(_DONE), F.lit(""))


def _numbers(symbols: Column, words: Vocabulary) -> Column:
    """Symbols as decimal ids with commas between."""
    return F.array_join(F.transform(F.split(symbols, ""), lambda c: _token(c).cast("string")), ",")


def java_pattern(pattern: str) -> str:
    r"""The pattern for Java, where ``\s`` alone means ASCII."""
    return pattern.replace(r"\s", r"\p{IsWhite_Space}").replace(r"\S", r"\P{IsWhite_Space}")


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(java_pattern(pattern)), F.lit(0))


def _cut(text: Column, pattern: str) -> Column:
    """A text in pieces that encode by themselves: at its spaces, or where it must be matched."""
    # A space at an end or beside white space. The pattern begins with the space, so that it fails fast.
    beside = F.regexp_like(text, F.lit(r" (?:(?=\p{IsWhite_Space}|$)|(?<=^ |\p{IsWhite_Space} ))"))
    first = F.substring_index(text, " ", 1)
    rest = F.transform(F.split(F.substring(text, F.length(first) + 2, F.length(text)), " "), lambda w: F.concat(F.lit(" "), w))
    spaced = F.when(F.instr(text, " ") > 0, F.concat(F.array(first), rest)).otherwise(F.array(text))
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).when(
        beside, _matches(text, pattern)
    ).otherwise(spaced)


def kept_words(
    docs: DataFrame, text: str, words: Vocabulary, pattern: str, sample_docs: int, kept: int
) -> DataFrame:
    """``piece, ids, count``: the most frequent pieces and matches of a sample, with their decimal ids.

    Under their marks there are a quarter as many beginnings of matches, ends, and seams.
    """
    spark = docs.sparkSession
    with run_folder(spark, "words") as steps:
        sample = docs.sample(min(1.0, sample_docs / max(1, docs.count())), seed=7)
        pieces = sample.select(F.explode(_cut(whole_text(F.col(text)), pattern)).alias("piece"))
        found = settled(pieces.groupBy("piece").count(), "pieces")
        matches = found.select(F.explode(_matches(F.col("piece"), pattern)).alias("piece"), "count")
        counted = found.unionByName(matches).groupBy("piece").agg(F.sum("count").alias("count"))
        plain = ~F.regexp_like("piece", F.lit(_MARKS))
        counted = settled(counted.filter(plain), "counted")
        top = counted.filter(F.col("count") >= _least_count(counted, kept))
        top = settled(top.select("piece", "count", _matches(F.col("piece"), pattern).alias("words")), "top")
        single = top.filter(F.size("words") == 1).select("piece", F.length("piece").alias("length"))
        longest = F.least(F.lit(_LONGEST_BEGIN), F.col("length") - 2)
        begins = F.transform(F.sequence(F.lit(2), longest), lambda n: F.substring("piece", F.lit(1), n))
        longest_end = F.least(F.lit(max(_CUTS)), F.col("length") - 2)
        ends = F.transform(F.sequence(F.lit(2), longest_end), lambda n: F.substring("piece", -n, n))
        parts = [
            _frequent(single.filter(F.col("length") > 3).select(F.explode(begins).alias("piece")), kept // 4, _BEGIN),
            _frequent(single.filter(F.col("length") > 3).select(F.explode(ends).alias("piece")), kept // 4, _END),
        ]
        given = top.select(F.lit("").alias("mark"), "piece", "count", "words")
        for part in parts:  # encoded as they stand: a part of a word is within its match
            given = given.unionByName(part.select("mark", "piece", F.lit(0).alias("count"), F.array("piece").alias("words")))
        ids = _with_tables(
            lambda ranks, pairs: _numbers(
                F.array_join(F.transform(F.col("words"), lambda word: folded(word, words, ranks, pairs)), ""), words
            )
        )
        given = given.repartition("piece").select("mark", "piece", "count", "words", *_tables(spark, words))
        encoded_parts = settled(
            given.select(
                F.concat("mark", "piece").alias("piece"), ids.alias("ids"), "count", F.size("words").alias("words")
            ),
            "encoded_parts",
        )
        tokens = F.split("ids", ",")
        beside = F.transform(
            F.sequence(F.lit(2), F.size(tokens)),
            lambda n: F.concat(F.element_at(tokens, n - 1), F.lit(","), F.element_at(tokens, n)),
        )
        seams = encoded_parts.filter((F.col("words") == 1) & (F.instr("ids", ",") > 0))
        seams = _frequent(seams.select(F.explode(beside).alias("piece")), kept // 4, _SEAM)
        seams = seams.select(F.concat("mark", "piece").alias("piece"), F.lit("+").alias("ids"), F.lit(0).alias("count"))
    found = settled(encoded_parts.select("piece", "ids", "count").unionByName(seams), "kept_words")
    release(spark, steps)  # all words of the sample, which are many more
    return found


def _frequent(pieces: DataFrame, kept: int, mark: str) -> DataFrame:
    """``mark, piece``: the most frequent pieces."""
    counted = settled(pieces.groupBy("piece").count(), "parts")
    top = counted.filter(F.col("count") >= _least_count(counted, kept))
    return top.select(F.lit(mark).alias("mark"), "piece")


def _tables(spark: SparkSession, words: Vocabulary) -> list[Column]:
    """The rank map and the pairs as columns, for :func:`_with_tables`."""
    return [_value(spark, _rank_map(words)).alias("_ranks"), _value(spark, _pair_table(words)).alias("_pairs")]


def _with_tables(use: Callable[[Column, Column], Column]) -> Column:
    """``use`` of the rank map and the pairs. Each column is named once, so that Spark makes one
    projection of it and the subquery, and the arrays are never part of a row."""
    return _let(F.col("_ranks"), lambda ranks: _let(F.col("_pairs"), lambda pairs: use(ranks, pairs)))


def _least_count(counted: DataFrame, kept: int) -> int:
    """The least count of which no more than ``kept`` words have as many."""
    left = kept
    # A row per count: counts that differ add up, so they are few even for very many words.
    sizes = counted.groupBy("count").agg(F.count("*").alias("words")).orderBy(F.desc("count"))
    least = None
    for row in sizes.collect():
        left -= row["words"]
        if left < 0:
            break
        least = row["count"]
    return (1 << 62) if least is None else least


def _kept_table(kept: DataFrame) -> Column:
    """The kept words of each hash bucket in one string, as a subquery for an array of the buckets.

    They are sought from the end, so the most frequent come last.
    """
    bucket = _bucket_column(F.col("piece"), _KEPT_BUCKETS).alias("bucket")
    entry = F.concat(F.lit(_KEY), "piece", F.lit(_VALUE), "ids").alias("entry")
    rising = F.array_sort(F.collect_list(F.struct("count", "entry")))
    filled = kept.select(bucket, "count", entry).groupBy("bucket").agg(
        F.array_join(F.transform(rising, lambda one: one["entry"]), "").alias("entries")
    )
    every = kept.sparkSession.range(_KEPT_BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    every = every.join(filled, "bucket", "left").select("bucket", F.coalesce("entries", F.lit("")).alias("entries"))
    stored = settled(every, "kept_table")
    ordered = F.array_sort(F.collect_list(F.struct("bucket", "entries")))
    return stored.agg(F.transform(ordered, lambda one: one["entries"]).alias("table")).scalar()


def _kept_ids(word: Column, table: Column) -> Column:
    """A kept word's decimal ids, or nothing. The word holds no mark, which would confuse the search.

    Without the word, all entries are left, and nothing is before the first one's mark.
    """
    entries = F.get(table, _bucket_column(word, _KEPT_BUCKETS))
    key = F.concat(F.lit(_KEY), word, F.lit(_VALUE))
    behind = F.call_function("substring_index", entries, key, F.lit(-1))
    return F.substring_index(behind, _KEY, 1)


def _joined_ids(word: Column, table: Column) -> Column:
    """A word's decimal ids from two kept parts of it, or null.

    Tokens that stand side by side are what a word encodes to if each two neighbours are what
    their own bytes encode to: a merge over the border of two tokens would be made in those
    bytes as well, as the merges before it are the same. So the ids of two parts join where
    the tokens at the seam are neighbours in the ids of any word.
    """

    def cut(at: int) -> Column:
        begin = F.concat(F.lit(_BEGIN), F.substring(word, F.lit(1), F.length(word) - at))
        end = F.concat(F.lit(_END), F.substring(word, -at, at))

        def joined(one: Column, other: Column) -> Column:
            seam = F.concat(
                F.lit(_SEAM), F.substring_index(one, ",", -1), F.lit(","), F.substring_index(other, ",", 1)
            )
            return F.when(_kept_ids(seam, table) != "", F.concat(one, F.lit(","), other))

        return _let(
            _kept_ids(begin, table),
            lambda one: F.when(
                one != "", _let(_kept_ids(end, table), lambda other: F.when(other != "", joined(one, other)))
            ),
        )

    return F.coalesce(*(F.when(F.length(word) > at + 1, cut(at)) for at in _CUTS))


def encoded(
    docs: DataFrame,
    rank_file: str,
    pattern: str,
    text: str = "text",
    sample_docs: int = SAMPLE_DOCS,
    kept: int = KEPT_WORDS,
    sampled: DataFrame | None = None,
) -> DataFrame:
    """The rows with ``ids``, the ids of the whole text as decimal numbers with commas between.

    A column of that name is replaced. The frequent words are those of ``sampled``, or of the
    rows themselves; they decide the speed and no result.
    """
    words = vocabulary(rank_file)
    source = docs if sampled is None else sampled
    frequent = _kept_table(kept_words(source, text, words, pattern, sample_docs, kept))

    content = whole_text(F.col("text"))

    def looked_up(pieces: Column, table: Column, marked: Column) -> Column:
        """Each piece's decimal ids, empty if they are not kept."""
        return F.when(
            marked,
            F.transform(pieces, lambda p: F.when(F.regexp_like(p, F.lit(_MARKS)), "").otherwise(_kept_ids(p, table))),
        ).otherwise(F.transform(pieces, lambda p: _kept_ids(p, table)))

    def piece_numbers(piece: Column, table: Column, ranks: Column, pairs: Column) -> Column:
        def of_words(marked: Column, own: Column) -> Column:
            def numbers(word: Column, known: Column) -> Column:
                alone = F.when(~marked, _joined_ids(word, table))
                return F.when(known != "", known).otherwise(
                    F.coalesce(alone, _numbers(folded(word, words, ranks, pairs), words))
                )

            return F.array_join(F.zip_with(own, looked_up(own, table, marked), numbers), ",")

        marked = F.regexp_like(piece, F.lit(_MARKS))
        return _let(marked, lambda m: _let(_matches(piece, pattern), lambda own: of_words(m, own)))

    def all_numbers(pieces: Column, table: Column, ranks: Column, pairs: Column) -> Column:
        def numbers(piece: Column, known: Column) -> Column:
            return F.when(known != "", known).otherwise(piece_numbers(piece, table, ranks, pairs))

        marked = F.regexp_like(content, F.lit(_MARKS))
        return F.array_join(F.zip_with(pieces, looked_up(pieces, table, marked), numbers), ",")

    ids = _with_tables(
        lambda ranks, pairs: _let(
            F.col("_table"),
            lambda table: _let(_cut(content, pattern), lambda pieces: all_numbers(pieces, table, ranks, pairs)),
        )
    )
    # The row as one field, so that no name of its columns can clash. Subqueries are columns
    # first, as they may not stand in a higher-order function.
    tables = [*_tables(docs.sparkSession, words), frequent.alias("_table")]
    given = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"), *tables)
    found = given.select("row", ids.alias("ids"))
    return found.select(*(F.col("row").getField(c).alias(c) for c in others(docs.columns, "ids")), "ids")


def id_array(ids: Column) -> Column:
    return F.when(F.length(ids) > 0, F.split(ids, ",").cast("array<int>")).otherwise(F.array().cast("array<int>"))


def decoded(rows: DataFrame, ids: str, rank_file: str, name: str = "decoded") -> DataFrame:
    """The rows with ``name``, the bytes of an array of ids: the binary pieces, concatenated.

    A column of that name is replaced.
    """
    pieces = _value(rows.sparkSession, _piece_table(vocabulary(rank_file))).alias("_pieces")
    given = rows.select(F.struct("*").alias("row"), F.col(ids).alias("ids"), pieces)

    def joined(table: Column) -> Column:
        # element_at is an error outside the table.
        return F.array_join(F.transform(F.col("ids"), lambda i: F.element_at(table, i + 1)), "")

    found = given.select("row", F.encode(_let(F.col("_pieces"), joined), "ISO-8859-1").alias(name))
    return found.select(*(F.col("row").getField(c).alias(c) for c in others(rows.columns, name)), name)
