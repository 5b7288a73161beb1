"""Cosine similarity and vector building (V1-V9)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricenet.operators import vectors as V


def _obs(spark, rows, ordinal=False):
    schema = "city string, year int, category string, month_year string, item_description string, normalized_price double"
    if ordinal:
        schema += ", ordinal long"
    return spark.createDataFrame(rows, schema)


def _matrix_obs(spark, matrix, cities=None):
    cities = cities or [f"C{i}" for i in range(len(matrix))]
    rows = []
    for city, vec in zip(cities, matrix):
        for j, val in enumerate(vec):
            rows.append((city, 2024, "Food", "2024-01", f"item{j}", float(val)))
    return _obs(spark, rows), cities


def _sims(spark, matrix):
    obs, cities = _matrix_obs(spark, matrix)
    feats = V.features(obs)
    pairs = V.cosine_pairs(V.roster_features(feats, cities))
    full = V.similarity_matrix(pairs, V.slice_groups(feats), cities).collect()
    return {(r.city_i, r.city_j): r.sim for r in full}


def test_one_city_is_like_itself(spark):
    assert _sims(spark, [[-2, 0, 7]]) == {("C0", "C0"): 1.0}


def test_unequal_support_and_negative_cosine(spark):
    s = _sims(spark, [[3, 0, 0, -4], [0, 5, 0, 12], [-6, 0, 2, 8]])
    assert s[("C0", "C1")] == pytest.approx(-48 / (5 * 13), abs=1e-12)
    assert s[("C0", "C2")] == pytest.approx(-50 / (5 * math.sqrt(104)), abs=1e-12)
    assert all(s[(a, b)] == s[(b, a)] for a, b in s)
    assert {s[(f"C{i}", f"C{i}")] for i in range(3)} == {1.0}


def test_scaled_and_disjoint_vectors(spark):
    s = _sims(spark, [[0.5, -1.5, 0], [1, -3, 0], [0, 0, 9], [-1, 3, 0]])
    assert s[("C0", "C1")] == pytest.approx(1.0) and s[("C0", "C3")] == pytest.approx(-1.0)
    assert s[("C0", "C2")] == 0.0


def test_city_without_values(spark):
    s = _sims(spark, [[0, 0], [4, -1], [0, 0]])
    assert s[("C0", "C1")] == s[("C0", "C2")] == 0.0 and s[("C2", "C2")] == 1.0


def test_range_property(spark):
    import random
    rnd = random.Random(7)
    m = [[rnd.uniform(-1, 1) for _ in range(20)] for _ in range(10)]
    s = _sims(spark, m)
    assert all(-1.0 <= v <= 1.0 for v in s.values())
    assert all(s[(a, b)] == s[(b, a)] for (a, b) in s)


def test_roster_completion_and_drop(spark):
    # city X is not in the roster (dropped); roster city Z has no data (zero vector)
    obs, _ = _matrix_obs(spark, [[1, 2], [2, 1], [5, 5]], ["A", "B", "X"])
    roster = ["A", "B", "Z"]
    feats = V.features(obs)
    pairs = V.cosine_pairs(V.roster_features(feats, roster)).collect()
    assert {(r.u, r.v) for r in pairs} == {("A", "B")}
    stats = V.similarity_stats(V.cosine_pairs(V.roster_features(feats, roster)), V.slice_groups(feats), roster).first()
    assert stats.n_pairs == 3 and stats.zero_pairs == 2 and stats.high_zero_share
    assert stats.min_sim == 0.0


def test_dedup_keeps_first_non_null_in_order(spark):
    rows = [("A", 2024, "Food", "2024-01", "rice", None, 0),
            ("A", 2024, "Food", "2024-01", "rice", 2.0, 1),
            ("A", 2024, "Food", "2024-01", "rice", 3.0, 2)]
    f = V.features(_obs(spark, rows, ordinal=True)).collect()
    assert len(f) == 1 and f[0].value == 2.0 and f[0].feature == "2024-01_rice"


def test_feature_key_spells_null(spark):
    rows = [("A", 2024, "Food", None, "rice", 1.0)]
    assert V.features(_obs(spark, rows)).first().feature == "None_rice"


def test_coverage_counts_zero_cells(spark):
    obs, cities = _matrix_obs(spark, [[1, 0, 2], [0, 0, 3]])
    cov = V.coverage(V.features(obs), cities + ["Z"]).first()
    assert cov.n_features == 3 and cov.n_cells == 9
    assert cov.zero_count == 9 - 3
    assert cov.high_missing is False or cov.high_missing == (cov.zero_pct > 70)


def test_slice_filter(spark):
    rows = [("A", 2023, "Food", "2023-01", "rice", 1.0), ("A", 2024, "Food", "2024-01", "rice", 1.0),
            ("A", 2024, "Fuel", "2024-01", "oil", 1.0)]
    assert V.slice_filter(_obs(spark, rows), 2024, "Food").count() == 1


@pytest.mark.parametrize("seed, share, tau", [(1, 1.0, 0.2), (2, 0.3, 0.5), (3, 0.15, 0.75), (4, 0.5, 0.01), (5, 0.05, 0.9), (6, 0.4, 1.0)])
def test_threshold_join_equals_all_pairs(spark, seed, share, tau):
    """Signed sparse vectors, with zero rows, equal rows and single features."""
    rng = np.random.default_rng(seed)
    matrix = rng.normal(size=(40, 30)) * (rng.random((40, 30)) < share) * rng.choice([0.1, 1, 10], size=(1, 30))
    matrix[3] = 0
    matrix[5] = 2 * matrix[4]
    matrix[6] = -matrix[4]
    matrix[7] = np.eye(30)[2]
    obs, cities = _matrix_obs(spark, matrix.tolist())
    rfeats = V.roster_features(V.features(obs), cities)
    # A pair of parallel vectors may miss a threshold of one by rounding.
    limit = tau - 1e-12
    all_pairs = {(r.u, r.v): r.sim for r in V.cosine_pairs(rfeats).collect() if r.sim >= limit}
    found = {(r.u, r.v): r.sim for r in V.similar_pairs(rfeats, limit).collect()}
    assert found.keys() == all_pairs.keys() and all(abs(found[k] - s) < 1e-9 for k, s in all_pairs.items())
    assert ("C4", "C5") in found


def test_candidates_leave_out_what_cannot_reach_tau(spark):
    """Blocks of cities with features of their own and one weak common feature: only pairs in a block are compared."""
    matrix = [[0.05] + [5.0 + (i + j) % 3 if j // 4 == i // 5 else 0.0 for j in range(16)] for i in range(20)]
    obs, cities = _matrix_obs(spark, matrix)
    rfeats = V.roster_features(V.features(obs), cities)
    assert V.cosine_pairs(rfeats).count() == 190
    got = V.candidate_pairs(V.prefix_index(rfeats, 0.5), 0.5).collect()
    assert len(got) == 40 and all(int(r.u[1:]) // 5 == int(r.v[1:]) // 5 for r in got)
    with pytest.raises(ValueError, match="above"):
        V.similar_pairs(rfeats, 0.0)
