"""Connected components of an edge table, by hooking to the smallest neighbour.

Each round points every node to its smallest neighbour, follows the pointers to their
ends, and contracts the graph to those ends. All steps are map-side combined aggregates
and joins between stored tables, so a hub with very many edges is never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import settled


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for the nodes of ``one, other``: the smallest node of each component."""
    edges = settled(_proper(edges), "edges")
    members: DataFrame | None = None
    while not edges.isEmpty():
        parents = _ends(edges)
        if members is None:
            members = parents
        else:
            step = parents.withColumnsRenamed({"node": "_node", "root": "_root"})
            members = members.join(step, F.col("root") == F.col("_node"), "left").select(
                "node", F.coalesce("_root", "root").alias("root")
            )
            members = settled(members, "components")
        edges = settled(_contracted(edges, parents), "edges")
    if members is None:
        members = edges.select(F.col("one").alias("node"), F.col("other").alias("root"))
    return members


def _proper(edges: DataFrame) -> DataFrame:
    low, high = F.least("one", "other"), F.greatest("one", "other")
    proper = edges.filter("one <> other").select(low.alias("one"), high.alias("other"))
    return proper.distinct()


def _ends(edges: DataFrame) -> DataFrame:
    """Where the pointers to the smallest neighbours end: pointers double until they stay."""
    both = edges.unionByName(
        edges.select(F.col("other").alias("one"), F.col("one").alias("other"))
    )
    nearest = both.groupBy(F.col("one").alias("node")).agg(F.min("other").alias("root"))
    pointers = settled(nearest.select("node", F.least("node", "root").alias("root")), "pointers")
    while True:
        step = pointers.withColumnsRenamed({"node": "_node", "root": "_root"})
        doubled = pointers.join(step, F.col("root") == F.col("_node")).select(
            "node", F.col("_root").alias("root"), (F.col("root") != F.col("_root")).alias("moved")
        )
        doubled = settled(doubled, "pointers")
        pointers = doubled.select("node", "root")
        if doubled.filter("moved").isEmpty():
            return pointers


def _contracted(edges: DataFrame, parents: DataFrame) -> DataFrame:
    one = parents.select(F.col("node").alias("one"), F.col("root").alias("_one"))
    other = parents.select(F.col("node").alias("other"), F.col("root").alias("_other"))
    half = settled(edges.join(one, "one").select("_one", "other"), "edges")
    return _proper(half.join(other, "other").select(F.col("_one").alias("one"), F.col("_other").alias("other")))
