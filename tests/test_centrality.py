"""Closed-form centralities (C0-C10) on small graphs."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricenet.operators import centrality as C
from pricenet.operators import eigen as E
from pricenet.operators import graph as N
from pricenet.operators import paths as P
from tests.conftest import graph_frames

K5 = (["a", "b", "c", "d", "e"], [(x, y) for i, x in enumerate("abcde") for y in "abcde"[i + 1:]])
STAR = (["h", "l1", "l2", "l3", "l4"], [("h", f"l{i}") for i in range(1, 5)])
PATH4 = (["p1", "p2", "p3", "p4"], [("p1", "p2"), ("p2", "p3"), ("p3", "p4")])
TWO_EDGES = (["a", "b", "c", "d"], [("a", "b"), ("c", "d")])


def _table(spark, graphs, n):
    nodes, edges, meta = graph_frames(spark, graphs)
    deg = C.degree_centrality(N.degree_table(nodes, edges), n)
    sp = P.shortest_paths(nodes, edges)
    clo = P.closeness_from_summary(P.reach_summary(nodes, edges), n)
    btw = P.betweenness(nodes, edges, sp, n)
    eig = E.eigenvector(nodes, edges, meta)
    return C.centrality_table(nodes, deg, clo, btw, eig)


def _by_city(df):
    return {r.city: (r.d_i, r.c_i, r.b_i, r.e_i) for r in df.collect()}


def test_k5(spark):
    t = _by_city(_table(spark, {(2023, "Cat1"): K5}, 5))
    for d, c, b, e in t.values():
        assert (d, c, b) == (1.0, 1.0, 0.0)
        assert e == pytest.approx(0.44721, abs=1e-5)


def test_star(spark):
    t = _by_city(_table(spark, {(2024, "Cat2"): STAR}, 5))
    assert t["h"][:3] == (1.0, 1.0, 1.0)
    assert t["h"][3] == pytest.approx(0.70711, abs=1e-5)
    d, c, b, e = t["l1"]
    assert d == 0.25 and c == pytest.approx(4 / 7) and b == 0.0
    assert e == pytest.approx(0.35355, abs=1e-5)


def test_path4(spark):
    t = _by_city(_table(spark, {(2024, "P"): PATH4}, 4))
    d, c, b, e = t["p1"]
    assert (d, c, b) == (pytest.approx(1 / 3), 0.5, 0.0) and e == pytest.approx(0.37175, abs=1e-5)
    d, c, b, e = t["p2"]
    assert (d, c, b) == (pytest.approx(2 / 3), 0.75, pytest.approx(2 / 3)) and e == pytest.approx(0.6015, abs=1e-4)


def test_two_disjoint_edges_scaled_closeness(spark):
    t = _by_city(_table(spark, {(2024, "T"): TWO_EDGES}, 4))
    for d, c, b, e in t.values():
        assert d == pytest.approx(1 / 3) and c == pytest.approx(1 / 3) and b == 0.0
        assert e == pytest.approx(0.5)


def test_batch_two_networks(spark):
    df = _table(spark, {(2023, "Cat1"): K5, (2024, "Cat2"): STAR}, 5)
    assert df.count() == 10


def _power(cities, links, max_iter=1000, tol=1e-6):
    """The power method in NumPy, normalised in every round."""
    at, n = {c: i for i, c in enumerate(cities)}, len(cities)
    m = np.eye(n)
    for u, v in links:
        m[at[u], at[v]] = m[at[v], at[u]] = 1
    x = np.full(n, 1 / n)
    for _ in range(max_iter):
        y = m @ x
        y /= np.linalg.norm(y)
        if np.abs(y - x).sum() < n * tol:
            return dict(zip(cities, y))
        x = y
    return dict.fromkeys(cities, 0.0)


def test_eigen_rounds_match_numpy(spark):
    """Networks that converge after different numbers of rounds."""
    graphs = {(2024, "P"): PATH4, (2024, "T"): TWO_EDGES, (2023, "S"): (list("wxyz"), [("w", "x"), ("w", "y"), ("w", "z"), ("y", "z")])}
    nodes, edges, meta = graph_frames(spark, graphs)
    got = {(r.category, r.city): r.e_i for r in E.eigenvector(nodes, edges, meta).collect()}
    want = {(c, city): x for (_, c), g in graphs.items() for city, x in _power(*g).items()}
    assert got == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("cap", [1, 16, 20])
def test_eigen_nonconvergence_gives_zeros(spark, cap):
    nodes, edges, meta = graph_frames(spark, {(2024, "P"): PATH4, (2024, "T"): TWO_EDGES})
    got = {(r.category, r.city): r.e_i for r in E.eigenvector(nodes, edges, meta, max_iter=cap).collect()}
    want = {(c, city): x for c, g in (("P", PATH4), ("T", TWO_EDGES)) for city, x in _power(*g, max_iter=cap).items()}
    assert got == pytest.approx(want, abs=1e-9)


def test_minmax_top_and_summary(spark):
    cent = _table(spark, {(2024, "Cat2"): STAR}, 5)
    norm = {r.city: r for r in C.minmax_normalize(cent).collect()}
    assert norm["h"].d_i_norm == 1.0 and norm["l1"].d_i_norm == 0.0
    top = C.top_cities(cent, "D_i", 2).collect()
    assert [r.city for r in top] == ["h", "l1"]
    with pytest.raises(ValueError):
        C.top_cities(cent, "X_i")
    summ = {r.metric: r for r in C.centrality_summary(cent).collect()}
    assert summ["b_i"].zeros == 4 and summ["d_i"].median == 0.25
    top3 = C.top_per_metric(cent, 3)
    assert top3.count() == 12


def test_constant_network_minmax_half(spark):
    cent = _table(spark, {(2023, "Cat1"): K5}, 5)
    assert {r.d_i_norm for r in C.minmax_normalize(cent).collect()} == {0.5}


def test_exact_median_matches_pandas(spark):
    import random

    import pandas as pd

    from pricenet.functions.quantiles import exact_median
    rnd = random.Random(5)
    rows = [("a", float(rnd.randint(0, 50))) for _ in range(1001)]
    rows += [("b", rnd.random()) for _ in range(998)] + [("c", 3.0)] + [("d", 1.0), ("d", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.median for r in exact_median(df, "k", "v", partitions=7).collect()}
    exp = pd.DataFrame(rows, columns=["k", "v"]).groupby("k")["v"].median().to_dict()
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k] == pytest.approx(exp[k], abs=1e-12)


def _largest_partition(df):
    """Rows of the fullest partition against the mean of those with rows."""
    counts = [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / (sum(counts) / len(counts))


def test_equal_values_do_not_pile_up(spark, monkeypatch):
    """90% equal values: the tables behind median and rank stay even."""
    from pricenet.functions import quantiles as Q

    written = []
    monkeypatch.setattr(Q, "_ranged", lambda *a, real=Q._ranged: written.append(real(*a)) or written[-1])
    df = spark.range(20_000).select(F.lit("k").alias("k"), F.col("id"),
                                    F.when(F.col("id") % 10 == 0, F.col("id") / 7.0).otherwise(0.0).alias("v"))
    assert Q.exact_median(df, "k", "v", partitions=8).first().median == 0.0
    ranked = Q.distributed_rank(df, ["k"], [F.col("v").desc(), F.col("id").asc()], partitions=8)
    want = [r.id for r in df.orderBy(F.col("v").desc(), "id").collect()]
    assert [r.id for r in ranked.orderBy("rank").collect()] == want
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 20_001))
    assert all(_largest_partition(w) < 2 for w in written) and len(written) == 2


def test_components_without_paths(spark):
    chain = [f"n{i:02d}" for i in range(40)]
    graphs = {(2024, "chain"): (chain, list(zip(chain, chain[1:]))),
              (2024, "parts"): (chain, [("n00", "n39"), ("n01", "n02"), ("n02", "n03"), ("n38", "n01")])}
    from pricenet.operators import components as K
    nodes, edges, _ = graph_frames(spark, graphs)
    comp = K.components(nodes, edges)
    assert {r.component for r in comp.where("category = 'chain'").collect()} == {"n00"}
    got = {r.city: r.component for r in comp.where("category = 'parts'").collect()}
    assert got["n39"] == "n00" and {got[c] for c in ("n01", "n02", "n03", "n38")} == {"n01"} and got["n10"] == "n10"
    counts = {r.category: (r.num_components, r.is_connected) for r in K.component_counts(comp).collect()}
    assert counts == {"chain": (1, True), "parts": (36, False)}


def _random_graphs(seed, n, densities):
    rng = np.random.default_rng(seed)
    names = [f"v{i:03d}" for i in range(n)]
    return {(2020 + k, "R"): (names, [(names[i], names[j]) for i in range(n) for j in range(i + 1, n) if rng.random() < p])
            for k, p in enumerate(densities)}


def test_reach_summary_equals_all_pairs(spark):
    """Bit-parallel search over several words of sources against the paths of all pairs; a chain."""
    graphs = _random_graphs(1, 150, [0.02, 0.2])
    nodes, edges, _ = graph_frames(spark, graphs)
    key = lambda df: sorted((r.year, r.city, r.reached, r.dist_sum, r.eccentricity) for r in df.collect())
    assert key(P.reach_summary(nodes, edges)) == key(P.path_summary(P.shortest_paths(nodes, edges)))
    names = graphs[(2020, "R")][0]
    nodes, edges, _ = graph_frames(spark, {(2030, "chain"): (names, list(zip(names, names[1:11])))})
    got = {r.city: (r.reached, r.dist_sum, r.eccentricity) for r in P.reach_summary(nodes, edges).collect()}
    assert got["v000"] == (10, 55, 10) and got["v005"] == (10, 30, 5) and got["v149"] == (0, 0, 0)


@pytest.mark.parametrize("batch", [3, 12])
def test_betweenness_by_source_batches(spark, batch):
    from pricenet import session

    graphs = {**_random_graphs(2, 12, [0.25]), (2021, "p"): (STAR[0] + [f"x{i}" for i in range(7)], STAR[1])}
    nodes, edges, _ = graph_frames(spark, graphs)
    key = lambda df: {(r.year, r.city): round(r.b_i, 12) for r in df.collect()}
    whole = key(P.betweenness(nodes, edges, P.shortest_paths(nodes, edges), 12))
    assert key(P.betweenness_by_batches(nodes, edges, 12, batch)) == whole and max(whole.values()) > 0
    folder = session._tables_folder(spark).removeprefix("file:")
    assert not [x for x in os.listdir(folder) if x.startswith("scratch-")]
    assert {r.b_i for r in P.betweenness_by_batches(nodes, edges.limit(0), 12, batch).collect()} == {0.0}


def test_components_of_a_long_chain(spark):
    """One pass whatever the diameter; the edges lie in many tasks, most of them many times."""
    from pricenet.operators import components as K

    chain = [f"n{i:05d}" for i in range(10_000)]
    nodes, edges, _ = graph_frames(spark, {(2024, "chain"): (chain, list(zip(chain, chain[1:]))), (2024, "none"): (["a", "b"], [])})
    spread = edges.union(edges.where("u < 'n03000'")).repartition(13)
    comp = K.components(nodes, spread)
    assert {(r.category, r.component) for r in comp.select("category", "component").distinct().collect()} == {
        ("chain", "n00000"), ("none", "a"), ("none", "b")}
    assert comp.count() == 10_002 and set(comp.columns) == {*nodes.columns, "component"}
    assert comp._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 2
