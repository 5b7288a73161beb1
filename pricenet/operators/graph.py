"""Threshold networks and their statistics.

A network is three tables keyed by ``(year, category)``:

* ``nodes(year, category, node_id, city)`` — the roster of every network;
* ``edges(year, category, u, v, sim, weight)`` — undirected, ``u < v``;
* ``networks`` — one metadata row per network.

Isolated roster cities are nodes, so every formula uses the roster size n.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricenet.functions.validation import check_tau
from pricenet.operators.vectors import roster_array, roster_pairs
from pricenet.session import GROUP, cut_lineage


def network_nodes(groups: DataFrame, cities: Sequence[str]) -> DataFrame:
    """N3 nodes: every roster city of every network, ``node_id`` = roster index."""
    return groups.select(*GROUP, F.posexplode(roster_array(cities)).alias("node_id", "city"))


def threshold_edges(pairs: DataFrame, tau: float, weighted: bool = False,
                    groups: DataFrame | None = None,
                    cities: Sequence[str] | None = None) -> DataFrame:
    """N1 + N4: keep pairs with ``sim >= tau`` (no self-loops by ``u < v``).

    For tau > 0 the sparse similarity table suffices (absent pairs are 0 <
    tau).  For tau == 0 the rule ``0 >= 0`` links every roster pair, so the
    pairs are generated from the roster and the similarities left-joined.
    Unweighted edges carry weight 1; weighted ones carry the similarity.
    """
    tau = check_tau(tau)
    if tau == 0:
        if groups is None or cities is None:
            raise ValueError("tau = 0 needs the slice groups and the roster")
        full = roster_pairs(groups, cities).join(pairs, GROUP + ["u", "v"], "left")
        cand = full.select(*GROUP, "u", "v", F.coalesce("sim", F.lit(0.0)).alias("sim"))
    else:
        cand = pairs
    edges = cand.where(F.col("sim") >= F.lit(tau))
    weight = F.col("sim") if weighted else F.lit(1.0)
    return edges.select(*GROUP, "u", "v", "sim", weight.alias("weight"))


def adjacency(edges: DataFrame) -> DataFrame:
    """Both orientations of every edge: ``(year, category, src, dst)``."""
    fwd = edges.select(*GROUP, F.col("u").alias("src"), F.col("v").alias("dst"))
    bwd = edges.select(*GROUP, F.col("v").alias("src"), F.col("u").alias("dst"))
    return fwd.unionByName(bwd)


def network_metadata(groups: DataFrame, edges: DataFrame, n: int, tau: float,
                     weighted: bool = False) -> DataFrame:
    """One row per slice with data: sizes, density, parameters."""
    m = edges.groupBy(*GROUP).agg(F.count("*").alias("num_edges"))
    possible = n * (n - 1) / 2.0
    out = groups.join(m, GROUP, "left").select(
        *GROUP,
        F.lit(n).cast("long").alias("num_nodes"),
        F.coalesce("num_edges", F.lit(0)).cast("long").alias("num_edges"))
    density = (F.col("num_edges") / F.lit(possible)) if possible > 0 else F.lit(0.0)
    return out.withColumns({
        "density": density,
        "threshold": F.lit(float(tau)),
        "weighted": F.lit(bool(weighted)),
    })


def nonempty(networks: DataFrame) -> DataFrame:
    """Networks with at least one edge (no-data slices never appear)."""
    return networks.where(F.col("num_edges") > 0)


def degree_table(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Degree of every node, isolated nodes 0."""
    deg = adjacency(edges).groupBy(*GROUP, F.col("src").alias("city")).agg(
        F.count("*").alias("degree"))
    return (nodes.join(deg, GROUP + ["city"], "left")
            .withColumn("degree", F.coalesce("degree", F.lit(0)).cast("long")))


def network_stats(networks: DataFrame, degrees: DataFrame) -> DataFrame:
    """N, m, density and average / max / min degree per network."""
    d = degrees.groupBy(*GROUP).agg(
        F.avg("degree").alias("avg_degree"),
        F.max("degree").alias("max_degree"),
        F.min("degree").alias("min_degree"))
    return networks.select(*GROUP, "num_nodes", "num_edges", "density").join(d, GROUP, "left")


def local_clustering(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Local clustering 2T/(k(k-1)) per node (0 below degree 2).

    Edges point from the node of smaller degree (ties by name) to the larger,
    so a hub has few outgoing ones: no node starts more than sqrt(2m) edges.
    Each triangle is then one wedge (x,y),(x,z) closed by an edge between y
    and z.
    """
    deg = cut_lineage(degree_table(nodes, edges))
    small = [deg.select(*GROUP, F.col("city").alias(c), F.struct("degree", "city").alias(f"r{c}")) for c in ("u", "v")]
    ranked = edges.select(*GROUP, "u", "v").join(small[0], GROUP + ["u"]).join(small[1], GROUP + ["v"])
    up = F.col("ru") < F.col("rv")
    e = cut_lineage(ranked.select(*GROUP, "u", "v", F.when(up, F.col("u")).otherwise(F.col("v")).alias("x"),
                                  F.when(up, F.col("v")).otherwise(F.col("u")).alias("y")))
    a = e.select(*GROUP, "x", "y")
    b = e.select(*GROUP, "x", F.col("y").alias("z"))
    c = e.select(*GROUP, F.col("u").alias("y"), F.col("v").alias("z"))
    tri = (a.join(b, GROUP + ["x"]).where(F.col("y") < F.col("z"))
           .join(c, GROUP + ["y", "z"]))
    per_node = (tri.select(*GROUP, F.explode(F.array("x", "y", "z")).alias("city"))
                .groupBy(*GROUP, "city").agg(F.count("*").alias("triangles")))
    k = F.col("degree")
    cc = F.when(k >= 2, 2.0 * F.col("triangles") / (k * (k - 1))).otherwise(F.lit(0.0))
    return (deg.join(per_node, GROUP + ["city"], "left")
            .withColumn("triangles", F.coalesce("triangles", F.lit(0)).cast("long"))
            .withColumn("clustering", cc))


def average_clustering(local: DataFrame) -> DataFrame:
    """Mean of local clustering over all nodes (isolated nodes count as 0)."""
    return local.groupBy(*GROUP).agg(F.avg("clustering").alias("clustering"))


def network_summary(networks: DataFrame) -> DataFrame:
    """N11 totals: number of networks, total edges, mean / min / max density."""
    return networks.agg(
        F.count("*").alias("num_networks"),
        F.sum("num_edges").cast("long").alias("total_edges"),
        F.avg("density").alias("mean_density"),
        F.min("density").alias("min_density"),
        F.max("density").alias("max_density"))


def induced_subgraph(nodes: DataFrame, edges: DataFrame, first_n: int) -> tuple[DataFrame, DataFrame]:
    """Nodes with roster index < first_n and the edges among them."""
    keep = nodes.where(F.col("node_id") < F.lit(first_n))
    ku = keep.select(*GROUP, F.col("city").alias("u"))
    kv = keep.select(*GROUP, F.col("city").alias("v"))
    sub = edges.join(ku, GROUP + ["u"], "left_semi").join(kv, GROUP + ["v"], "left_semi")
    return keep, sub
