from __future__ import annotations

import base64
import random
import re

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken

from layerloom.llm import token_counts
from layerloom.llm.queries import MASKS, QUERIES

FILE = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    with open(FILE, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_edits_give_the_tree_of_the_edited_text():
    with open(FILE, "rb") as file:
        count = token_counts._counter(file.read(), P.PATTERN)
    split = regex.compile(P.PATTERN)

    def leaves(text):
        pieces = split.findall(text)
        return np.array([len(p) for p in pieces], np.int32), np.array(count(pieces), np.int32)

    rnd = random.Random(5)
    parts = ["a", " ", "  ", "\n", "'", "l", "ll", "1", ".", "é", "\t", "they're", " \n ", "", "x y"]
    for _ in range(1500):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        edits = [(a, a + rnd.randint(0, 6), rnd.choice(parts)) for a in (rnd.randint(0, len(text) + 1) for _ in range(rnd.randint(1, 5)))]
        new, chars, tokens, tree, encoded = token_counts.recount(text, *leaves(text), edits, count, split)
        assert [*map(list, (chars, tokens))] == [*map(list, leaves(new))]
        assert (tree.chars, tree.tokens) == (len(new), tokens.sum())


def test_query_equals_full_counts(spark, encoding):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = {r.doc_id: r for r in QUERIES["op1_token_counts"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    touched = 0
    for row in docs:
        spans = sorted((m.start(), m.end(), new) for old, new in MASKS.items() for m in re.finditer(old, row.text))
        text, done = "", 0
        for start, stop, new in spans:
            start, stop = max(start, done), max(stop, done)
            text, done = text + row.text[done:start] + new, stop
        text += row.text[done:]
        own = found[row.doc_id]
        assert own.n_tokens_before == len(encoding.encode_ordinary(row.text))
        assert own.n_tokens == len(encoding.encode_ordinary(text))
        assert own.n_edits == len(spans)
        assert own.n_reencoded < own.n_pretokens or not spans or own.n_pretokens < 60
        touched += bool(spans)
    assert touched


def test_a_kept_tree_takes_the_next_edits(spark, encoding):
    rows = [(1, "one two three", [(4, 7, "2")], "x"), (2, None, [(0, 0, "new")], "x"), (3, "", None, "x"), (4, "a b", [None, (None, 1, "q")], "x")]
    docs = spark.createDataFrame(rows, f"doc_id int, text string, edits {token_counts.EDITS}, tokens string")
    first = token_counts.recounted(docs, FILE, P.PATTERN, edits=docs["edits"], keep=True)
    assert [r.text for r in first.orderBy("doc_id").collect()] == ["one 2 three", "new", "", "a b"]
    again = token_counts.recounted(first, FILE, P.PATTERN, masks={"three": "III"}, tree=first["tree"], keep=True)
    for row in again.collect():
        assert row.n_tokens == len(encoding.encode_ordinary(row.text))
    assert token_counts.recounted(docs.limit(0), FILE, P.PATTERN).count() == 0


def test_untouched_documents_are_not_split_or_encoded_again():
    class Never:
        def findall(self, text, position=0):
            raise AssertionError("split again")

        match = findall

    def never(pieces):
        raise AssertionError("encoded again")

    tree = {"chars": token_counts._packed(np.array([3, 300])), "tokens": token_counts._packed(np.array([1, 70]))}
    row = {"doc_id": 1, "text": "abc" + "x" * 300, "edits": None, "tree": tree}
    found = token_counts._updated(row, [("secret", "")], never, Never(), True)
    assert (found["n_tokens"], found["n_reencoded"], found["n_pretokens"]) == (71, 0, 2)
    assert found["tree"] == tree
    with pytest.raises(AssertionError, match="split again"):
        token_counts._updated({**row, "text": "secret" + row["text"][6:]}, [("secret", "")], never, Never(), True)


def test_very_long_texts_and_repeats(spark, encoding):
    text = "word " * 100_000 + "y" * 500 + " a@b.de"
    docs = spark.createDataFrame([(1, text), (1, text), (2, "a")], "doc_id int, text string")
    grown = token_counts.recounted(docs, FILE, P.PATTERN, keep=True)
    found = token_counts.recounted(grown, FILE, P.PATTERN, masks=MASKS, tree=grown["tree"]).collect()
    want = len(encoding.encode_ordinary(text.replace("a@b.de", "<email>")))
    assert sorted(r.n_tokens for r in found) == [1, want, want]
    assert all(r.n_reencoded < 20 for r in found)
