"""Threshold networks and statistics on the 4x4 similarity fixture."""

import pytest
from pyspark.sql import functions as F

from pricenet.operators import graph as N
from pricenet.operators import components as K
from pricenet.operators import paths as P

CITIES = ["Islamabad", "Karachi", "Lahore", "Quetta"]
SIM = {(0, 1): .8, (0, 2): .3, (0, 3): .5, (1, 2): .6, (1, 3): .4, (2, 3): .7}


def _pairs(spark):
    rows = []
    for (i, j), s in SIM.items():
        u, v = sorted([CITIES[i], CITIES[j]])
        rows.append((2024, "Food", u, v, s))
    return spark.createDataFrame(rows, "year int, category string, u string, v string, sim double")


def _groups(spark):
    return spark.createDataFrame([(2024, "Food")], "year int, category string")


def _edge_set(edges):
    return {(r.u, r.v) for r in edges.collect()}


def _names(*idx_pairs):
    return {tuple(sorted([CITIES[i], CITIES[j]])) for i, j in idx_pairs}


@pytest.mark.parametrize("tau,expected,components,connected", [
    (0.5, [(0, 1), (0, 3), (1, 2), (2, 3)], 1, True),
    (0.7, [(0, 1), (2, 3)], 2, False),
    (0.8, [(0, 1)], 3, False),
])
def test_threshold_edges_and_stats(spark, tau, expected, components, connected):
    pairs, groups = _pairs(spark), _groups(spark)
    edges = N.threshold_edges(pairs, tau)
    assert _edge_set(edges) == _names(*expected)
    meta = N.network_metadata(groups, edges, len(CITIES), tau).first()
    assert meta.num_edges == len(expected)
    assert meta.density == pytest.approx(len(expected) / 6)
    nodes = N.network_nodes(groups, CITIES)
    sp = P.shortest_paths(nodes, edges)
    cc = K.component_counts(K.components(nodes, edges)).first()
    assert cc.num_components == components and cc.is_connected == connected
    clus = N.average_clustering(N.local_clustering(nodes, edges)).first()
    assert clus.clustering == 0.0
    pm = P.path_metrics(sp, K.component_counts(K.components(nodes, edges)), len(CITIES)).first()
    if connected:
        assert pm.diameter == 2
        assert pm.avg_path_length == pytest.approx(16 / 12)
    else:
        assert pm.diameter is None and pm.avg_path_length is None


def test_monotone_in_tau(spark):
    pairs = _pairs(spark)
    assert _edge_set(N.threshold_edges(pairs, 0.8)) <= _edge_set(N.threshold_edges(pairs, 0.5))


def test_tau_zero_links_all_roster_pairs(spark):
    pairs, groups = _pairs(spark), _groups(spark)
    roster = CITIES + ["Peshawar"]  # no data: zero vector, similarity 0 >= 0
    edges = N.threshold_edges(pairs, 0.0, groups=groups, cities=roster)
    assert edges.count() == 10


@pytest.mark.parametrize("tau", [-0.1, 1.1])
def test_invalid_tau(spark, tau):
    with pytest.raises(ValueError):
        N.threshold_edges(_pairs(spark), tau)


def test_weighted_edges_carry_similarity(spark):
    e = N.threshold_edges(_pairs(spark), 0.7, weighted=True).collect()
    assert {r.weight for r in e} == {0.8, 0.7}
    e = N.threshold_edges(_pairs(spark), 0.7).collect()
    assert {r.weight for r in e} == {1.0}


def test_node_ids_and_degree(spark):
    groups = _groups(spark)
    nodes = N.network_nodes(groups, CITIES)
    assert [(r.node_id, r.city) for r in nodes.orderBy("node_id").collect()] == list(enumerate(CITIES))
    edges = N.threshold_edges(_pairs(spark), 0.5)
    deg = {r.city: r.degree for r in N.degree_table(nodes, edges).collect()}
    assert deg == {c: 2 for c in CITIES}
    st = N.network_stats(N.network_metadata(groups, edges, 4, 0.5), N.degree_table(nodes, edges)).first()
    assert (st.avg_degree, st.max_degree, st.min_degree) == (2.0, 2, 2)


def test_triangle_clustering(spark):
    groups = _groups(spark)
    rows = [(2024, "Food", "A", "B", 1.0, 1.0), (2024, "Food", "A", "C", 1.0, 1.0),
            (2024, "Food", "B", "C", 1.0, 1.0), (2024, "Food", "C", "D", 1.0, 1.0)]
    edges = spark.createDataFrame(rows, "year int, category string, u string, v string, sim double, weight double")
    nodes = N.network_nodes(groups, ["A", "B", "C", "D"])
    local = {r.city: r.clustering for r in N.local_clustering(nodes, edges).collect()}
    assert local == {"A": 1.0, "B": 1.0, "C": pytest.approx(1 / 3), "D": 0.0}
    avg = N.average_clustering(N.local_clustering(nodes, edges)).first().clustering
    assert avg == pytest.approx((1 + 1 + 1 / 3) / 4)


def test_induced_subgraph(spark):
    groups = _groups(spark)
    nodes = N.network_nodes(groups, CITIES)
    edges = N.threshold_edges(_pairs(spark), 0.5)
    keep, sub = N.induced_subgraph(nodes, edges, 2)
    assert keep.count() == 2 and _edge_set(sub) == _names((0, 1))


def test_summary_and_nonempty(spark):
    groups = spark.createDataFrame([(2024, "Food"), (2024, "Fuel")], "year int, category string")
    edges = N.threshold_edges(_pairs(spark), 0.5)
    meta = N.network_metadata(groups, edges, 4, 0.5)
    assert N.nonempty(meta).count() == 1
    s = N.network_summary(N.nonempty(meta)).first()
    assert s.num_networks == 1 and s.total_edges == 4
