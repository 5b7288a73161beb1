"""Shortest hop paths: all pairs with path counts (C0), and what needs less
than that — closeness (C2), diameter and mean path length (N10) — and
betweenness (C3).  Components (N8) need no paths, see
:mod:`pricenet.operators.components`.

**Reach summaries** (C2, N10) need no pairs.  Sixty-four sources share one long:
a row per (node, word of sources) holds which of them have reached the node,
a hop is a bitwise OR over its neighbours, and the bits that are new count as
that many distances.  In an undirected graph distances are the same both ways,
so the counts at a node are those of its own search.

**Paths and betweenness** (C0, C3) run breadth-first from every source at once,
one DataFrame round per hop.  A node first reached at hop L+1 from the hop-L
frontier can only have been seen at hops L-1 or L, so the anti-join touches
two levels, not the whole history.  Betweenness takes the sources in batches:
a batch's levels are dropped when its dependencies are added up and written.

Every round is written to the shared checkpoint folder: a lost executor
recomputes one round, not the whole search.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricenet.operators.graph import adjacency
from pricenet.session import GROUP, cut_lineage, cut_lineage_counted, scratch


@dataclass
class ShortestPaths:
    """``levels[L]`` holds ``(year, category, s, t, d, sigma)`` with d == L."""

    levels: list[DataFrame]

    @property
    def max_distance(self) -> int:
        return len(self.levels) - 1

    @property
    def table(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.levels)


def shortest_paths(nodes: DataFrame, edges: DataFrame, sources: DataFrame | None = None) -> ShortestPaths:
    """Level-synchronous BFS with path counting (sigma as DOUBLE), from all nodes or some.

    Every level is written to the checkpoint folder (one job) and the loop
    stops at the first empty level, which is exact.
    """
    adj = cut_lineage(adjacency(edges).withColumnRenamed("src", "t"))
    level0 = (nodes if sources is None else sources).select(
        *GROUP, F.col("city").alias("s"), F.col("city").alias("t"),
        F.lit(0).alias("d"), F.lit(1.0).alias("sigma"))
    levels = [level0]
    hop = 0
    while True:
        front = levels[-1]
        step = (front.join(adj, GROUP + ["t"])
                .groupBy(*GROUP, "s", F.col("dst").alias("t"))
                .agg(F.sum("sigma").alias("sigma")))
        seen = front.select(*GROUP, "s", "t")
        if len(levels) > 1:
            seen = seen.unionByName(levels[-2].select(*GROUP, "s", "t"))
        nxt = (step.join(seen, GROUP + ["s", "t"], "left_anti")
               .select(*GROUP, "s", "t", F.lit(hop + 1).alias("d"), "sigma"))
        nxt, rows = cut_lineage_counted(nxt)
        if rows == 0:
            break
        levels.append(nxt)
        hop += 1
    return ShortestPaths(levels)


# Sources in a word, and hops between two writes of the reach table.
WORD_BITS = 64
HOPS_A_ROUND = 3


def _hop(state: DataFrame, adj: DataFrame, hop: int) -> DataFrame:
    """The reach table one hop on."""
    key = [*GROUP, "city", "word"]
    arrived = (state.where("front <> 0").select(*key, "front").join(adj, [*GROUP, "city"])
               .groupBy(*GROUP, F.col("dst").alias("city"), "word").agg(F.bit_or("front").alias("got")))
    zero = F.lit(0).cast("long")
    seen = F.coalesce("seen", zero)
    new = F.coalesce("got", zero).bitwiseAND(F.bitwise_not(seen))
    count = F.bit_count("front").cast("long")
    return (state.drop("front").join(arrived, key, "full")
            .select(*key, seen.bitwiseOR(new).alias("seen"), new.alias("front"),
                    *[F.coalesce(c, zero).alias(c) for c in ("reached", "dist_sum", "eccentricity")])
            .withColumns({"reached": F.col("reached") + count, "dist_sum": F.col("dist_sum") + count * hop,
                          "eccentricity": F.when(F.col("front") != 0, hop).otherwise(F.col("eccentricity"))}))


def reach_summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Per node: the number of other nodes reached, their distance sum and its eccentricity.

    Bit-parallel search: n / 64 rows a node at most, and none per pair.
    """
    adj = cut_lineage(adjacency(edges).withColumnRenamed("src", "city"))
    bit = F.expr(f"shiftleft(1L, node_id % {WORD_BITS})")
    zero = F.lit(0).cast("long")
    state = nodes.select(*GROUP, "city", F.floor(F.col("node_id") / WORD_BITS).alias("word"), bit.alias("seen"), bit.alias("front"),
                         zero.alias("reached"), zero.alias("dist_sum"), zero.alias("eccentricity"))
    hop = 0
    while hop == 0 or not state.where("front <> 0").isEmpty():
        for _ in range(HOPS_A_ROUND):
            hop += 1
            state = _hop(state, adj, hop)
        state = cut_lineage(state)
    return state.groupBy(*GROUP, "city").agg(
        F.sum("reached").alias("reached"), F.sum("dist_sum").alias("dist_sum"), F.max("eccentricity").alias("eccentricity"))


def path_summary(sp: ShortestPaths) -> DataFrame:
    """One pass over all-pairs paths: per source node, the number of other
    nodes reached, their distance sum and its eccentricity.

    Closeness and path metrics derive from this table, so the all-pairs
    table — the largest of the graph stage — is scanned once.
    """
    return sp.table.groupBy(*GROUP, F.col("s").alias("city")).agg(
        F.count_if(F.col("d") > 0).alias("reached"),
        F.sum("d").alias("dist_sum"),
        F.max("d").alias("eccentricity"))


def closeness_from_summary(summary: DataFrame, n: int) -> DataFrame:
    """C = (r / sum d) * (r / (n - 1)), r = other nodes reachable; else 0."""
    r, tot = F.col("reached"), F.col("dist_sum")
    c = (r / tot) * (r / F.lit(float(n - 1))) if n > 1 else F.lit(0.0)
    return summary.select(*GROUP, "city", F.when(tot > 0, c).otherwise(F.lit(0.0)).alias("c_i"))


def closeness(nodes: DataFrame, sp: ShortestPaths, n: int) -> DataFrame:
    """C2 for every node (every node has its distance-0 row, so none is missing)."""
    return closeness_from_summary(path_summary(sp), n)


def path_metrics_from_summary(summary: DataFrame, counts: DataFrame, n: int) -> DataFrame:
    """Diameter and mean shortest path, only for connected networks, n > 1.

    The mean over ordered pairs s != t is sum(dist_sum) / sum(reached).
    """
    agg = summary.groupBy(*GROUP).agg(
        F.max("eccentricity").alias("_diam"),
        (F.sum("dist_sum") / F.sum("reached")).alias("_apl"))
    ok = F.col("is_connected") & F.lit(n > 1)
    return counts.join(agg, GROUP, "left").select(
        *GROUP, "num_components", "is_connected",
        F.when(ok, F.col("_diam")).cast("long").alias("diameter"),
        F.when(ok, F.col("_apl")).alias("avg_path_length"))


def path_metrics(sp: ShortestPaths, counts: DataFrame, n: int) -> DataFrame:
    return path_metrics_from_summary(path_summary(sp), counts, n)


# Sources whose levels are held at a time.
BATCH_SOURCES = 1024


def _dependencies(edges: DataFrame, sp: ShortestPaths) -> DataFrame | None:
    """Brandes' dependencies of every node, summed over the sources of ``sp``; None without any path.

    delta(s,v) = sum over successors w of v (d(s,w) = d(s,v)+1) of
    sigma(s,v)/sigma(s,w) * (1 + delta(s,w)), processed from the deepest
    level up; one DataFrame round per level.
    """
    adj = adjacency(edges).select(*GROUP, F.col("src").alias("w"), F.col("dst").alias("v"))
    deltas = []
    child = None  # (g, s, w, coef) for the level below the current one
    for level in range(sp.max_distance, 0, -1):
        cur = sp.levels[level].select(*GROUP, "s", F.col("t").alias("v"), "sigma")
        if child is None:  # deepest level: no successors, a projection of the level
            dl = cur.withColumn("delta", F.lit(0.0))
        else:
            contrib = (child.join(adj, GROUP + ["w"])
                       .groupBy(*GROUP, "s", "v").agg(F.sum("coef").alias("acc")))
            dl = cut_lineage(cur.join(contrib, GROUP + ["s", "v"], "left")
                             .withColumn("delta", F.col("sigma") * F.coalesce("acc", F.lit(0.0)))
                             .drop("acc"))
        deltas.append(dl.select(*GROUP, "v", "delta"))
        child = dl.select(*GROUP, "s", F.col("v").alias("w"),
                          ((F.lit(1.0) + F.col("delta")) / F.col("sigma")).alias("coef"))
    if not deltas:
        return None
    return reduce(DataFrame.unionByName, deltas).groupBy(*GROUP, F.col("v").alias("city")).agg(F.sum("delta").alias("_b"))


def _normalised(nodes: DataFrame, sums: DataFrame | None, n: int) -> DataFrame:
    """B(v) = summed dependencies / ((n-1)(n-2)), 0 for n <= 2 and for nodes on no path."""
    if sums is None:
        return nodes.select(*GROUP, "city", F.lit(0.0).alias("b_i"))
    scale = 1.0 / ((n - 1) * (n - 2)) if n > 2 else 0.0
    return nodes.join(sums, GROUP + ["city"], "left").select(
        *GROUP, "city", (F.coalesce(F.col("_b"), F.lit(0.0)) * F.lit(scale)).alias("b_i"))


def betweenness(nodes: DataFrame, edges: DataFrame, sp: ShortestPaths, n: int) -> DataFrame:
    """Normalised betweenness from the levels of all sources."""
    return _normalised(nodes, _dependencies(edges, sp), n)


def betweenness_by_batches(nodes: DataFrame, edges: DataFrame, n: int, batch: int = BATCH_SOURCES) -> DataFrame:
    """C3 with the levels of at most ``batch`` sources a network at a time.

    A batch's dependency sums (a row per node) are written before its levels
    are deleted, so the loop goes on from the sums of finished batches.
    """
    written = []
    for first in range(0, n, batch):
        sources = nodes.where(F.col("node_id").between(first, first + batch - 1))
        with scratch(nodes.sparkSession):
            found = _dependencies(edges, shortest_paths(nodes, edges, sources))
            rows = None if found is None else cut_lineage(found, keep=True)
        if rows is not None:
            written.append(rows)
    if not written:
        return _normalised(nodes, None, n)
    sums = reduce(DataFrame.unionByName, written).groupBy(*GROUP, "city").agg(F.sum("_b").alias("_b"))
    return _normalised(nodes, sums, n)
