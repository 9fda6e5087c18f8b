"""A Merkle manifest of a dataset, with multiproofs per partition of leaves.

Each row is a leaf: the digest of its fields, each with its length. The leaves of a source,
in order of their id, stand under a tree in which up to three neighbours have a parent, and
the roots of the sources, in order of their names, stand under a tree of the same kind.

The trees are built in rounds. A round cuts a level into blocks of 3**7 nodes, wherever they
stand, and each block is reduced by itself, so that a source with a third of all rows is just
more blocks; the next round takes the tops of the blocks.

Proofs are made by the Octopus method. A partition of leaves is a range of neighbours in one
tree. Going up from that range, a run of siblings is touched if the range has a member of it;
the members that it has not are missing, and its parent is known on the next level. The union
of the missing coordinates, a few per level, is fetched once, in one join with the stored
nodes. From these and its own leaves the partition derives all interior nodes that its proofs
share, each once, and then expands the proof of every leaf locally.

Defined cases: a null field is written ``-`` and differs from an empty one. A null id comes
first in its source; rows that repeat an id are ordered by their digests, and equal rows are
leaves of their own. A null source is a source. Of a lone leaf the proof within its source is
empty. Very long texts are hashed where they are read and never moved. An empty table has no
root, and gives an empty result. Other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import settled
from layerloom.llm.ranks import numbered

ARITY = 3
#: A block of a round has this many levels, and so ``ARITY**BLOCK_LEVELS`` nodes.
BLOCK_LEVELS = 7
#: Leaves whose proofs are made together. It decides no result.
PART_LEAVES = 2000

#: The tree over the roots of the sources. A source's key begins with ``-`` or ``:``.
_TOP = ""
_NODES = "tree string, level int, position bigint, digest string, root boolean"


@dataclass(frozen=True)
class Manifest:
    """``leaves``: the documents, with ``tree``, ``position``, ``size``, ``part`` and ``digest``.

    ``nodes``: ``tree, level, position, digest`` of all nodes of all trees, leaves included.
    ``sources``: of each source its ``tree``, its ``subroot``, and its place among them.
    ``root``: the digest over all, none if there are no leaves.
    """

    leaves: DataFrame
    nodes: DataFrame
    sources: DataFrame
    root: str | None


def digest_of(fields: Sequence[Column]) -> Column:
    """The digest of the fields, in order: null as ``-``, else length in bytes, ``:``, value."""
    written = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in
               (field.cast("string") for field in fields)]
    return F.sha2(F.concat(*written), 256)


def joined(digests: Sequence[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def level_sizes(size: int) -> list[int]:
    """How many nodes each level has, from the leaves to the root."""
    sizes = [size]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // ARITY))
    return sizes


def missing(first: int, last: int, size: int) -> Iterator[tuple[int, int]]:
    """The coordinates, level and position, that a range of leaves lacks for its proofs."""
    for level, nodes in enumerate(level_sizes(size)[:-1]):
        start, end = first // ARITY * ARITY, min(last // ARITY * ARITY + ARITY, nodes)
        yield from ((level, position) for position in range(start, first))
        yield from ((level, position) for position in range(last + 1, end))
        first, last = first // ARITY, last // ARITY


class Proofs:
    """The interior nodes over a range of leaves, and the proofs of these."""

    def __init__(self, first: int, digests: list[str], size: int, fetched: dict[tuple[int, int], str]):
        self.sizes = level_sizes(size)
        self.levels: list[tuple[int, list[str]]] = []  # first position and nodes, per level
        last = first + len(digests) - 1
        for level, nodes in enumerate(self.sizes):
            start, end = first // ARITY * ARITY, min(last // ARITY * ARITY + ARITY, nodes)
            before = [fetched[level, position] for position in range(start, first)]
            after = [fetched[level, position] for position in range(last + 1, end)]
            run = [*before, *digests, *after]
            self.levels.append((start, run))
            digests = [joined(run[at : at + ARITY]) for at in range(0, len(run), ARITY)]
            first, last = first // ARITY, last // ARITY
        self._shared: dict[tuple[int, int], str] = {}

    def siblings(self, level: int, position: int) -> tuple[list[str], list[str]]:
        """The other nodes of a run, those to the left and those to the right."""
        start, run = self.levels[level]
        at, own = position // ARITY * ARITY - start, position - start
        return run[at:own], run[own + 1 : at + ARITY]

    def proof(self, position: int, level: int = 0) -> str:
        """All siblings on the way up. What neighbours share is put together once."""
        if level == len(self.sizes) - 1:
            return ""
        known = self._shared.get((level, position))
        if known is None:
            left, right = self.siblings(level, position)
            known = "".join(left + right) + self.proof(position // ARITY, level + 1)
            if level:
                self._shared[level, position] = known
        return known

    def folded(self, position: int, digest: str) -> str:
        """The root that a leaf of this digest would give with the siblings as they are."""
        for level in range(len(self.sizes) - 1):
            left, right = self.siblings(level, position)
            digest = joined([*left, digest, *right])
            position //= ARITY
        return digest

    @property
    def root(self) -> str:
        return self.levels[-1][1][0]


def built(
    docs: DataFrame, fields: Sequence[str], source: str = "source", doc_id: str = "doc_id", **presented: Column
) -> Manifest:
    """The manifest of all rows. Expressions given by name are kept beside the leaves."""
    tree = F.coalesce(F.concat(F.lit(":"), F.col(source).cast("string")), F.lit("-"))
    leaves = docs.select(
        tree.alias("tree"),
        F.col(doc_id).alias("doc_id"),
        digest_of([F.col(name) for name in fields]).alias("digest"),
        *(value.alias(name) for name, value in presented.items()),
    )
    leaves = numbered(leaves, "tree", ["doc_id", "digest"])
    leaves = leaves.withColumn("part", F.expr(f"position div {PART_LEAVES}"))
    leaves = settled(leaves, "leaves")
    subroots, nodes = _grown(leaves)
    sources = numbered(subroots.select(F.lit(_TOP).alias("top"), "tree", F.col("digest").alias("subroot")), "top", ["tree"])
    sources = settled(sources.drop("top"), "subroots")
    tops, top_nodes = _grown(sources.select(F.lit(_TOP).alias("tree"), "position", "size", F.col("subroot").alias("digest")))
    root = tops.first()
    return Manifest(leaves, nodes.unionByName(top_nodes), sources, root["digest"] if root else None)


def _grown(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The roots of the trees, ``tree, digest``, and all of their nodes."""
    columns = ["tree", "level", "position", "digest"]
    level, rounds = 0, [leaves.withColumn("level", F.lit(0)).select(*columns)]
    roots = [leaves.filter("size = 1").select("tree", "digest")]
    rows = leaves.filter("size > 1").select("tree", "position", "digest", "size")
    while not rows.isEmpty():
        found = settled(_round(rows, level), "nodes")
        rounds.append(found.select(*columns))
        roots.append(found.filter("root").select("tree", "digest"))
        sizes = rows.groupBy("tree").agg(F.max("size").alias("size")).withColumnRenamed("tree", "of")
        level += BLOCK_LEVELS
        tops = found.filter((F.col("level") == level) & ~F.col("root"))
        size = F.ceil(F.col("size") / ARITY**BLOCK_LEVELS).cast("bigint").alias("size")
        rows = tops.join(sizes, F.col("tree") == F.col("of")).select("tree", "position", "digest", size)
    return reduce(DataFrame.unionByName, roots), reduce(DataFrame.unionByName, rounds)


def _round(rows: DataFrame, base: int) -> DataFrame:
    """The nodes above ``rows``, which are of level ``base``, as far up as a block goes."""
    nodes = ARITY**BLOCK_LEVELS
    block = F.expr(f"position div {nodes}").alias("block")
    dealt = rows.select("tree", block, "position", "digest", "size").repartition("tree", "block")
    ordered = dealt.sortWithinPartitions("tree", "block", "position")

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = None, []
        for batch in batches:
            found = []
            columns = [column.to_pylist() for column in batch.columns]
            for tree, number, _, digest, size in zip(*columns, strict=True):
                if own != (tree, number, size):
                    found += _above(own, held, base)
                    own, held = (tree, number, size), []
                held.append(digest)
            yield _nodes(found)
        yield _nodes(_above(own, held, base))

    return ordered.mapInArrow(reduced, _NODES)


def _above(own: tuple[str, int, int] | None, digests: list[str], base: int) -> list[tuple]:
    if own is None:
        return []
    tree, block, size = own
    found = []
    for level in range(1, BLOCK_LEVELS + 1):
        size = -(-size // ARITY)
        digests = [joined(digests[at : at + ARITY]) for at in range(0, len(digests), ARITY)]
        first = block * ARITY ** (BLOCK_LEVELS - level)
        found += [(tree, base + level, first + at, digest, size == 1) for at, digest in enumerate(digests)]
        if size == 1:
            break
    return found


def _nodes(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [[]] * 5
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.bool_()]
    names = ["tree", "level", "position", "digest", "root"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


_COORDINATES = "tree string, part bigint, of string, level int, position bigint"
_PROVEN = "doc_id bigint, leaf string, subroot string, proof_sha256 string, folded_root string"


def proven(manifest: Manifest, presented: str = "digest") -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of all documents.

    ``folded_root`` is folded from the leaf's column ``presented`` and its own siblings.
    """
    within = manifest.sources.select(
        "tree", "subroot", F.col("position").alias("place"), F.col("size").alias("places")
    )
    ranges = manifest.leaves.groupBy("tree", "part").agg(
        F.min("position").alias("first"), F.max("position").alias("last"), F.max("size").alias("size")
    )
    # A row per partition of leaves; a source with very many of them is split by the join.
    parts = settled(ranges.join(within, "tree"), "parts")
    wanted = parts.mapInArrow(_wanted, _COORDINATES)
    nodes = manifest.nodes.withColumnsRenamed({"tree": "_tree", "level": "_level", "position": "_position"})
    same = (
        (F.col("of") == F.col("_tree")) & (F.col("level") == F.col("_level")) & (F.col("position") == F.col("_position"))
    )
    fetched = wanted.join(nodes, same).select("tree", "part", "of", "level", "position", "digest")
    # The range itself as a row among them, so that every partition has one.
    own = parts.select(
        "tree", "part", F.lit(None).cast("string").alias("of"), F.lit(-1).alias("level"),
        F.col("size").alias("position"), F.col("subroot").alias("digest"), "place", "places",
    )
    none = F.lit(None).cast("bigint")
    given = settled(fetched.select("*", none.alias("place"), none.alias("places")).unionByName(own), "fetched")
    leaves = manifest.leaves.select("tree", "part", "doc_id", "position", "digest", F.col(presented).alias("presented"))
    found = leaves.groupBy("tree", "part").cogroup(given.groupBy("tree", "part")).applyInArrow(_expanded, _PROVEN)
    root = F.lit(manifest.root).cast("string")
    return found.select(
        "doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            own = (row["tree"], row["part"])
            found += [(*own, row["tree"], *at) for at in missing(row["first"], row["last"], row["size"])]
            found += [(*own, _TOP, *at) for at in missing(row["place"], row["place"], row["places"])]
        columns = list(zip(*found, strict=True)) or [[]] * 5
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64()]
        names = ["tree", "part", "of", "level", "position"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _expanded(leaves: pa.Table, given: pa.Table) -> pa.Table:
    """Every proof of one partition of leaves, from its own digests and the fetched nodes."""
    fetched: dict[bool, dict[tuple[int, int], str]] = {True: {}, False: {}}
    size, subroot, place, places = 0, "", 0, 0
    for row in given.to_pylist():
        if row["of"] is None:
            size, subroot, place, places = row["position"], row["digest"], row["place"], row["places"]
        else:
            fetched[row["of"] == _TOP][row["level"], row["position"]] = row["digest"]
    leaves = leaves.sort_by("position")
    positions, digests = leaves["position"].to_pylist(), leaves["digest"].to_pylist()
    within = Proofs(positions[0], digests, size, fetched[False])
    above = Proofs(place, [subroot], places, fetched[True])
    shared = above.proof(place)
    folds = {within.root: above.folded(place, within.root)}
    proofs, roots = [], []
    for position, digest in zip(positions, leaves["presented"].to_pylist(), strict=True):
        proofs.append(joined([within.proof(position), shared]))
        folded = within.folded(position, digest)
        if folded not in folds:
            folds[folded] = above.folded(place, folded)
        roots.append(folds[folded])
    subroots = pa.array([within.root] * len(positions), pa.string())
    columns = [leaves["doc_id"], leaves["digest"], subroots, pa.array(proofs, pa.string()), pa.array(roots, pa.string())]
    return pa.table(columns, names=["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"])
