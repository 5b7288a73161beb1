"""Connected components of a link table, by alternating large and small stars.

Each round points every node at the smallest node it knows; a round is two
grouped minima and two joins, and a graph needs few rounds however long its
chains are.  Minima are written before they are joined: a node with very many
links is then a plain join side, which Spark splits.  Every round is a written
table in the shared folder, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u > v): new edges, again from larger to smaller node."""
    around = edges.select("u", "v")
    if large:
        around = around.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = cut_lineage(around.groupBy("u").agg(F.min("v").alias("least"))
                        .select("u", F.least("u", "least").alias("least")))
    joined = around.join(least, "u")
    if large:
        # Larger neighbours move to the smallest node of the neighbourhood.
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        # Smaller neighbours and the node itself move to the smallest of them.
        moved = (joined.where("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
                 .unionByName(least.select("u", F.col("least").alias("v"))))
    return cut_lineage(moved.where("u > v").distinct())


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a checksum of them."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 31))).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every linked node: the smallest node that links reach.

    Null ends and links of a node to itself connect nothing.  Any orderable node
    type will do.
    """
    edges = cut_lineage(links.where(f"{a} != {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = _state(edges)
    while before[0]:
        edges = _star(_star(edges, large=True), large=False)
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
