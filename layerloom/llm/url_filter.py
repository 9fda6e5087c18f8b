"""URL filter: a trie over reversed host labels and path segments.

A rule is a host with an optional path, ``example.net/en/``, and a verdict. It fits its host
and all subdomains, if the URL's path starts with the rule's path. The trie's edges are the
host's labels from the last to the first and then the path's segments, so all rules that
fit a URL lie on one walk, whatever their number. The longest rule wins, by the length of
host and path; a block wins over an equal allow.

The rules are a parameter and not a table. The trie is broadcast in blocks of at most
``block_rules`` rules, so that what a worker holds is bounded; each URL takes the longest of
the blocks' rules.

Defined cases: a null URL, or one without ``://``, has an empty host and path and fits no
rule. A URL that no rule fits gets the default verdict. An empty label (``a..b``) is a
label like any other. A path is compared as it is: case and escapes count. Rows that repeat
a URL are judged each, very long URLs whole. Rules that fit one URL with equal lengths are one
rule; if it is listed with both verdicts, it blocks. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import others

BLOCK_RULES = 200_000
ALLOW, BLOCK = "allow", "block"

_HIT = "struct<length:int,blocks:int,rule:string,verdict:string>"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str = ""

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    """The rule ``host/path`` or ``host``; hosts are compared in lower case."""
    if verdict not in (ALLOW, BLOCK):
        raise ValueError(f"a verdict is {ALLOW!r} or {BLOCK!r}, not {verdict!r}")
    host, slash, path = text.partition("/")
    if not host:
        raise ValueError(f"rule {text!r} names no host")
    return Rule(verdict, _lower(host), slash + path)


def _lower(host: str) -> str:
    """A-Z in lower case, other letters as they are."""
    return host.encode().lower().decode()


class Trie:
    """Nodes are dicts from an edge to a node; ``None`` leads to what ends at a node.

    What ends there are (rest, rule) pairs: ``rest`` is the beginning of a last, unfinished
    segment, so that a path rule without a slash at its end fits as the prefix it is.
    """

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for entry in rules:
            node = self.root
            for edge in [*reversed(entry.host.split(".")), *self._segments(entry.path)[:-1]]:
                node = node.setdefault(edge, {})
            node.setdefault(None, []).append((self._segments(entry.path)[-1], entry))

    @staticmethod
    def _segments(path: str) -> list[str]:
        """Each with its slash behind it, so that labels and segments can't be confused."""
        first, *rest = path.split("/")
        parts = [first, *rest]
        return [part + "/" for part in parts[:-1]] + [parts[-1]]

    def longest(self, host: str, path: str) -> Rule | None:
        found: list[Rule] = []
        node, nodes = self.root, []
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            nodes.append(node)
        segments = self._segments(path)
        for start in nodes:
            node = start
            for segment in segments:
                found.extend(e for rest, e in node.get(None, ()) if segment.startswith(rest))
                node = node.get(segment)
                if node is None:
                    break
        return max(found, key=lambda e: (len(e.text), e.verdict == BLOCK), default=None)


def host_of(url: Column) -> Column:
    """What is between the first ``://`` and the next ``/``, ``?``, ``#`` or the end."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What is between the host and the next ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judged(
    pages: DataFrame,
    rules: Sequence[Rule],
    url: str = "url",
    default: str = ALLOW,
    block_rules: int = BLOCK_RULES,
) -> DataFrame:
    """The rows with ``host``, ``path``, the winning ``rule`` (or null) and the ``verdict``.

    Columns of these names are replaced.
    """
    own = ("host", "path", "rule", "verdict")
    kept = [F.col("row").getField(name).alias(name) for name in others(pages.columns, *own)]
    # The row as one field, so that no name of its columns can clash.
    parted = pages.select(
        F.struct("*").alias("row"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    )
    hits = [
        _matcher(pages, rules[at : at + block_rules])("host", "path")
        for at in range(0, len(rules), block_rules)
    ] or [F.lit(None).cast(_HIT)]
    # The greatest struct: the longest rule, of equals a block. One without a rule is the least.
    best = F.array_max(F.array(*hits))
    hit = parted.select("*", best.alias("hit"))
    verdict = F.coalesce("hit.verdict", F.lit(default)).alias("verdict")
    return hit.select(*kept, "host", "path", F.col("hit.rule").alias("rule"), verdict)


def _matcher(pages: DataFrame, rules: Sequence[Rule]):
    """A pandas UDF over one block's trie, which each worker gets once."""
    shared = pages.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf(_HIT)
    def match(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        longest = shared.value.longest
        hits = [longest(host, path) for host, path in zip(hosts, paths, strict=True)]
        rows = [(len(e.text), int(e.verdict == BLOCK), e.text, e.verdict) if e else (None,) * 4 for e in hits]
        frame = pd.DataFrame(rows, columns=["length", "blocks", "rule", "verdict"])
        return frame.astype({"length": "Int32", "blocks": "Int32"})

    return match
