"""Containment order of networks over time and evolution series.

A "graph" is the edge set of one (key, time) pair, e.g. key = category and
time = year.  Edges are canonical (``u < v``), so set comparison is an
equi-join on ``(key, u, v)``.  E_i can lie only in graphs that hold its
rarest edge, so that edge's posting list names all candidates; they are
confirmed by |E_i and E_j| = |E_i|.  The time points of a frequent edge are
never paired up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(key_cols: Sequence[str]) -> list[str]:
    return list(key_cols)


def edge_subset(e1: DataFrame, e2: DataFrame, key_cols: Sequence[str] = ("year", "category")) -> DataFrame:
    """Per key, is the edge set of ``e1`` contained in that of ``e2``?

    Keys absent from ``e1`` have an empty edge set, which is contained.
    """
    k = _keys(key_cols)
    a = e1.select(*k, "u", "v").distinct()
    b = e2.select(*k, "u", "v").distinct()
    missing = a.join(b, k + ["u", "v"], "left_anti").groupBy(*k).agg(F.count("*").alias("_missing"))
    if not k:  # two whole edge sets: one row
        return missing.select((F.col("_missing") == 0).alias("is_subset"))
    keys = a.select(*k).unionByName(b.select(*k)).distinct()
    return (keys.join(missing, k, "left")
            .select(*k, F.col("_missing").isNull().alias("is_subset")))


def containment_relation(edges: DataFrame, key_cols: Sequence[str] = ("category",),
                         time_col: str = "year") -> DataFrame:
    """All (t_from, t_to) with E_from contained in E_to, diagonal included.

    Candidates of a graph are the graphs no smaller than it that hold its
    rarest edge; each is confirmed on the smaller graph's edges.
    """
    k = _keys(key_cols)
    e = edges.select(*k, F.col(time_col).alias("_t"), "u", "v").distinct()
    graphs = rarest_edges(e, k)
    a = graphs.select(*k, F.col("_t").alias("t_from"), F.col("_size").alias("_from"), "_rarest.u", "_rarest.v")
    holders = (e.join(graphs.select(*k, "_t", "_size"), k + ["_t"])
               .select(*k, F.col("_t").alias("t_to"), F.col("_size").alias("_to"), "u", "v"))
    candidates = (a.join(holders, k + ["u", "v"]).where(F.col("_from") <= F.col("_to"))
                  .select(*k, "t_from", "t_to", "_from"))
    tests = candidates.join(e.withColumnRenamed("_t", "t_from"), k + ["t_from"])
    held = tests.join(e.withColumnRenamed("_t", "t_to"), k + ["t_to", "u", "v"], "left_semi")
    return (held.groupBy(*k, "t_from", "t_to", "_from").agg(F.count("*").alias("_shared"))
            .where(F.col("_shared") == F.col("_from"))
            .select(*k, "t_from", "t_to"))


def rarest_edges(e: DataFrame, k: Sequence[str]) -> DataFrame:
    """(keys, _t, _size, _rarest): the size of every graph and its edge that the fewest graphs of the key hold.

    ``e`` has distinct rows (keys, _t, u, v); equally rare edges go by (u, v).
    """
    frequency = e.groupBy(*k, "u", "v").agg(F.count("*").alias("_held"))
    return (e.join(frequency, [*k, "u", "v"]).groupBy(*k, "_t")
            .agg(F.count("*").alias("_size"), F.min(F.struct("_held", "u", "v")).alias("_rarest")))


def containment_reduction(rel: DataFrame, key_cols: Sequence[str] = ("category",)) -> DataFrame:
    """T4: cover relation plus the diagonal.

    Keep i -> k (i != k) unless some j has E_i strictly inside E_j strictly
    inside E_k.  On distinct edge sets that grow in time order this is the
    in-place reduction of the reference; equal sets keep both directions.
    """
    k = _keys(key_cols)
    rev = rel.select(*k, F.col("t_to").alias("t_from"), F.col("t_from").alias("t_to"))
    strict = rel.where(F.col("t_from") != F.col("t_to")).join(rev, k + ["t_from", "t_to"], "left_anti")
    first = strict.select(*k, "t_from", F.col("t_to").alias("mid"))
    second = strict.select(*k, F.col("t_from").alias("mid"), "t_to")
    redundant = first.join(second, k + ["mid"]).select(*k, "t_from", "t_to").distinct()
    return rel.join(redundant, k + ["t_from", "t_to"], "left_anti")


def hasse_edges(reduced: DataFrame, key_cols: Sequence[str] = ("category",)) -> DataFrame:
    """T5: reduced relation without the diagonal, with the number of time points."""
    k = _keys(key_cols)
    n_times = reduced.where(F.col("t_from") == F.col("t_to")).groupBy(*k).agg(
        F.count("*").alias("num_years"))
    links = reduced.where(F.col("t_from") != F.col("t_to"))
    if not k:  # one global order: the count is a scalar subquery
        return links.select("t_from", "t_to", n_times.scalar().alias("num_years"))
    return links.join(n_times, k, "left").select(*k, "t_from", "t_to", "num_years")


def partial_order_check(edges: DataFrame, rel: DataFrame, key_cols: Sequence[str] = ("category",),
                        time_col: str = "year") -> DataFrame:
    """Reflexive / antisymmetric / transitive flags per key.

    With no key columns the whole collection is one order and the result is
    one row (all True for an empty collection).

    Antisymmetry compares canonical edge sets, so mutual containment always
    means equality; it is still evaluated on the data.
    """
    k = _keys(key_cols)
    times = edges.select(*k, F.col(time_col).alias("t")).distinct()
    diag = rel.where(F.col("t_from") == F.col("t_to")).select(*k, F.col("t_from").alias("t"))
    refl = times.join(diag, k + ["t"], "left_anti").groupBy(*k).agg(F.count("*").alias("_nr"))
    sizes = edges.select(*k, F.col(time_col).alias("t"), "u", "v").distinct().groupBy(*k, "t").agg(
        F.count("*").alias("_s"))
    mutual = (rel.alias("a").join(rel.alias("b"),
                                  [F.col(f"a.{c}") == F.col(f"b.{c}") for c in k]
                                  + [F.col("a.t_from") == F.col("b.t_to"), F.col("a.t_to") == F.col("b.t_from")])
              .where(F.col("a.t_from") < F.col("a.t_to"))
              .select(*[F.col(f"a.{c}").alias(c) for c in k], F.col("a.t_from").alias("i"), F.col("a.t_to").alias("j")))
    si = sizes.select(*k, F.col("t").alias("i"), F.col("_s").alias("_si"))
    sj = sizes.select(*k, F.col("t").alias("j"), F.col("_s").alias("_sj"))
    anti = (mutual.join(si, k + ["i"]).join(sj, k + ["j"])
            .where(F.col("_si") != F.col("_sj")).groupBy(*k).agg(F.count("*").alias("_na")))
    ij = rel.select(*k, F.col("t_from").alias("i"), F.col("t_to").alias("j"))
    jk = rel.select(*k, F.col("t_from").alias("j"), F.col("t_to").alias("kk"))
    ik = rel.select(*k, F.col("t_from").alias("i"), F.col("t_to").alias("kk"))
    trans = (ij.join(jk, k + ["j"]).select(*k, "i", "kk").distinct()
             .join(ik, k + ["i", "kk"], "left_anti").groupBy(*k).agg(F.count("*").alias("_nt")))
    if not k:
        # One global order: global aggregates always give one row, so an
        # empty collection reports True for every property.
        r = refl.agg(F.coalesce(F.sum("_nr"), F.lit(0)).alias("_nr"))
        out = r.select((F.col("_nr") == 0).alias("reflexive"),
                       (anti.agg(F.coalesce(F.sum("_na"), F.lit(0))).scalar() == 0).alias("antisymmetric"),
                       (trans.agg(F.coalesce(F.sum("_nt"), F.lit(0))).scalar() == 0).alias("transitive"))
        return out.withColumn("is_partial_order",
                              F.col("reflexive") & F.col("antisymmetric") & F.col("transitive"))
    out = (times.select(*k).distinct().join(refl, k, "left").join(anti, k, "left").join(trans, k, "left"))
    r = F.col("_nr").isNull()
    a = F.col("_na").isNull()
    t = F.col("_nt").isNull()
    return out.select(*k, r.alias("reflexive"), a.alias("antisymmetric"), t.alias("transitive"),
                      (r & a & t).alias("is_partial_order"))


def density_by_year(evolution: DataFrame) -> DataFrame:
    """Mean density per year over the evolution table."""
    return evolution.groupBy("year").agg(F.avg("density").alias("mean_density"))
