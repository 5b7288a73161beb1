"""Containment order and evolution."""

import random

from pyspark.sql import functions as F

from pricenet.operators import temporal as T


def _edges(spark, graphs):
    rows = []
    for (cat, year), edges in graphs.items():
        for u, v in edges:
            a, b = sorted([u, v])
            rows.append((year, cat, a, b))
    return spark.createDataFrame(rows, "year int, category string, u string, v string")


CHAIN = {("Food", 2021): [("1", "2")],
         ("Food", 2022): [("1", "2"), ("2", "3")],
         ("Food", 2023): [("1", "2"), ("2", "3"), ("3", "4")]}


def test_subset(spark):
    e = _edges(spark, CHAIN)
    g21 = e.where("year = 2021").drop("year")
    g23 = e.where("year = 2023").drop("year")
    assert T.edge_subset(g21, g23, ["category"]).first().is_subset is True
    assert T.edge_subset(g23, g21, ["category"]).first().is_subset is False


def test_relation_reduction_hasse(spark):
    e = _edges(spark, CHAIN)
    rel = T.containment_relation(e, ["category"], "year")
    pairs = {(r.t_from, r.t_to) for r in rel.collect()}
    assert pairs == {(i, j) for i in (2021, 2022, 2023) for j in (2021, 2022, 2023) if i <= j}
    red = {(r.t_from, r.t_to) for r in T.containment_reduction(rel, ["category"]).collect()}
    assert red == {(2021, 2021), (2022, 2022), (2023, 2023), (2021, 2022), (2022, 2023)}
    h = T.hasse_edges(T.containment_reduction(rel, ["category"]), ["category"]).collect()
    assert {(r.t_from, r.t_to) for r in h} == {(2021, 2022), (2022, 2023)}
    assert {r.num_years for r in h} == {3}


def test_equal_graphs_keep_both_directions(spark):
    g = {("Fuel", 2021): [("a", "b")], ("Fuel", 2022): [("b", "a")]}
    rel = T.containment_relation(_edges(spark, g), ["category"], "year")
    red = {(r.t_from, r.t_to) for r in T.containment_reduction(rel, ["category"]).collect()}
    assert {(2021, 2022), (2022, 2021)} <= red


def test_partial_order(spark):
    e = _edges(spark, CHAIN)
    rel = T.containment_relation(e, ["category"], "year")
    r = T.partial_order_check(e, rel, ["category"], "year").first()
    assert r.reflexive and r.antisymmetric and r.transitive and r.is_partial_order


def test_density_by_year(spark):
    evo = spark.createDataFrame([(2021, "Food", .3), (2022, "Food", .4), (2022, "Energy", .2)],
                                "year int, category string, density double")
    got = {r.year: r.mean_density for r in T.density_by_year(evo).collect()}
    assert got == {2021: .3, 2022: .30000000000000004} or abs(got[2022] - 0.3) < 1e-12


def test_partial_order_global_and_empty(spark):
    e = _edges(spark, CHAIN).drop("category")
    rel = T.containment_relation(e, [], "year")
    r = T.partial_order_check(e, rel, [], "year").collect()
    assert len(r) == 1 and r[0].is_partial_order
    empty = e.where("false")
    r = T.partial_order_check(empty, T.containment_relation(empty, [], "year"), [], "year").collect()
    assert len(r) == 1 and r[0].reflexive and r[0].antisymmetric and r[0].transitive


def test_global_subset_and_hasse(spark):
    e = _edges(spark, CHAIN).drop("category")
    small = e.where("year = 2021").drop("year")
    big = e.where("year = 2023").drop("year")
    assert T.edge_subset(small, big, []).first().is_subset is True
    assert T.edge_subset(big, small, []).first().is_subset is False
    red = T.containment_reduction(T.containment_relation(e, [], "year"), [])
    h = T.hasse_edges(red, []).collect()
    assert {(r.t_from, r.t_to) for r in h} == {(2021, 2022), (2022, 2023)} and {r.num_years for r in h} == {3}


def test_containment_by_rarest_edge_against_sets(spark):
    rng = random.Random(11)
    names = [f"c{i}" for i in range(7)]
    every = [(a, b) for a in names for b in names if a < b]
    graphs = {}
    for cat in ("Food", "Fuel", "Rent"):
        for year in range(2000, 2014):
            earlier = [e for (c, _), e in graphs.items() if c == cat]
            base = rng.choice(earlier) if earlier and rng.random() < 0.6 else []
            graphs[cat, year] = sorted({*base, *rng.sample(every, rng.choice([0, 1, 1, 2, 5])), ("c0", "c1")}
                                       if rng.random() < 0.8 else {*rng.sample(every, 1)})
    edges = _edges(spark, graphs)
    edges = edges.unionByName(edges.where("year < 2003")).withColumn("_size", F.lit(0))  # repeated rows, a clashing column
    got = [(r.category, r.t_from, r.t_to) for r in T.containment_relation(edges, ["category"], "year").collect()]
    want = {(c, i, j) for (c, i), a in graphs.items() for (d, j), b in graphs.items() if c == d and set(a) <= set(b)}
    assert len(got) == len(set(got)) and set(got) == want
    held = {(c, j, e) for (c, j), b in graphs.items() for e in b}
    for r in T.rarest_edges(edges.select("category", F.col("year").alias("_t"), "u", "v").distinct(), ["category"]).collect():
        counts = {e: sum((r.category, j, e) in held for j in range(2000, 2014)) for e in graphs[r.category, r._t]}
        assert r._size == len(counts) and r._rarest._held == min(counts.values()) == counts[r._rarest.u, r._rarest.v]


def test_containment_of_no_edges(spark):
    empty = _edges(spark, CHAIN).where("false")
    assert T.containment_relation(empty, ["category"], "year").count() == 0
