"""Property tests against brute force on small random fixtures."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pricenet.operators import graph as N
from pricenet.operators import vectors as V

matrices = st.lists(st.lists(st.integers(-3, 3), min_size=4, max_size=4), min_size=3, max_size=5)


def _brute_cosine(m):
    a = np.array(m, dtype=float)
    norms = np.linalg.norm(a, axis=1, keepdims=True)
    norms[norms == 0] = 1e-10
    s = (a / norms) @ (a / norms).T
    np.fill_diagonal(s, 1.0)
    return np.clip(s, -1, 1)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(m=matrices, tau=st.sampled_from([0.0, 0.3, 0.8]))
def test_cosine_and_edges_match_brute_force(spark, m, tau):
    cities = [f"C{i}" for i in range(len(m))]
    rows = [(c, 2024, "Food", "2024-01", f"i{j}", float(v)) for c, vec in zip(cities, m) for j, v in enumerate(vec)]
    obs = spark.createDataFrame(rows, "city string, year int, category string, month_year string, "
                                      "item_description string, normalized_price double")
    feats = V.features(obs)
    pairs = V.cosine_pairs(V.roster_features(feats, cities))
    full = {(r.city_i, r.city_j): r.sim for r in V.similarity_matrix(pairs, V.slice_groups(feats), cities).collect()}
    ref = _brute_cosine(m)
    for i, a in enumerate(cities):
        for j, b in enumerate(cities):
            assert abs(full[(a, b)] - ref[i, j]) < 1e-9
            assert full[(a, b)] == full[(b, a)]
    edges = {(r.u, r.v) for r in N.threshold_edges(pairs, tau, groups=V.slice_groups(feats), cities=cities).collect()}
    # Pairs within float noise of tau (e.g. an exact 0 that a normalised
    # brute force computes as -1e-17) may fall on either side.
    for i in range(len(m)):
        for j in range(i + 1, len(m)):
            if ref[i, j] >= tau + 1e-9:
                assert (cities[i], cities[j]) in edges
            elif ref[i, j] <= tau - 1e-9:
                assert (cities[i], cities[j]) not in edges
