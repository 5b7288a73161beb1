"""Weighting schemes, roll-up, rankings."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricenet.operators import scoring as W

CITIES = ["Islamabad", "Karachi", "Lahore", "Quetta", "Peshawar"]


def _panel(spark, seed=42):
    rnd = random.Random(seed)
    rows = []
    for y in (2023, 2024):
        for c in ("1. Food", "2. Meat"):
            for city in CITIES:
                rows.append((y, c, city, rnd.random(), rnd.random(), rnd.random(), rnd.random()))
    return spark.createDataFrame(rows, "year int, category string, city string, d_i double, c_i double, b_i double, e_i double")


def _pandas_reference(pdf):
    """Independent pandas computation of the correlation and entropy schemes."""
    metrics = ["d_i", "c_i", "b_i", "e_i"]
    out = {}
    for key, g in pdf.groupby(["year", "category"]):
        corr = g[metrics].corr().abs()
        w = {m: 1 / (1 + corr.loc[m, [x for x in metrics if x != m]].sum()) for m in metrics}
        t = sum(w.values())
        w = {m: v / t for m, v in w.items()}
        ent = {}
        for m in metrics:
            v = g[m].values
            p = v / v.sum() if v.sum() > 1e-10 else [1 / len(v)] * len(v)
            p = [x + 1e-10 for x in p]
            ent[m] = -sum(x * math.log(x) for x in p)
        te = sum(ent.values())
        we = {m: (ent[m] / te if te > 1e-10 else 0.25) for m in metrics}
        for _, r in g.iterrows():
            out[(r.year, r.category, r.city)] = (
                sum(r[m] * w[m] for m in metrics), sum(r[m] * we[m] for m in metrics))
    return out


def test_all_schemes_match_pandas(spark):
    cent = _panel(spark)
    ref = _pandas_reference(cent.toPandas())
    got = {(r.year, r.category, r.city): r for r in W.scores_all(cent).collect()}
    assert len(got) == 20
    for k, (corr, ent) in ref.items():
        assert got[k].score_correlation == pytest.approx(corr, abs=1e-12)
        assert got[k].score_entropy == pytest.approx(ent, abs=1e-12)
        r = got[k]
        assert r.score_equal == pytest.approx(0.25 * (r.d_i + r.c_i + r.b_i + r.e_i))
        assert 0 <= r.score_equal <= 1


def test_single_scheme_functions_agree_with_all(spark):
    cent = _panel(spark)
    allv = {(r.year, r.category, r.city): r for r in W.scores_all(cent).collect()}
    for r in W.score_correlation(cent).collect():
        assert r.score_correlation == pytest.approx(allv[(r.year, r.category, r.city)].score_correlation)
    for r in W.score_entropy(cent).collect():
        assert r.score_entropy == pytest.approx(allv[(r.year, r.category, r.city)].score_entropy)


def test_constant_metric_counts_zero_correlation(spark):
    rows = [(2024, "Food", c, 0.5, float(i), float(i * i), float(5 - i)) for i, c in enumerate(CITIES)]
    cent = spark.createDataFrame(rows, "year int, category string, city string, d_i double, c_i double, b_i double, e_i double")
    rho = W.metric_correlations(cent).first()
    assert rho.rho_d_i_c_i == 0.0 and rho.rho_d_i_b_i == 0.0
    pdf = cent.toPandas()
    ref = _pandas_reference(pdf)
    for r in W.score_correlation(cent).collect():
        assert r.score_correlation == pytest.approx(ref[(r.year, r.category, r.city)][0])


def test_all_zero_metric_is_uniform_entropy(spark):
    rows = [(2024, "Food", c, 0.0, float(i + 1), 1.0, 2.0) for i, c in enumerate(CITIES)]
    cent = spark.createDataFrame(rows, "year int, category string, city string, d_i double, c_i double, b_i double, e_i double")
    h = W.metric_entropy(cent).first()
    assert h.h_d_i == pytest.approx(math.log(5), rel=1e-6)


def test_category_weights_and_unknown(spark):
    cent = _panel(spark)
    out = W.score_category(cent, {"1. Food": 0.25}).collect()
    for r in out:
        w = 0.25 if r.category == "1. Food" else 0.1
        assert r.score_category_weighted == pytest.approx(r.score_category * w)


def test_unsorted_categories_join_by_key(spark):
    # "10. x" sorts before "2. x": results must follow keys, not row order.
    rows = []
    for c in ("2. x", "10. x"):
        for i, city in enumerate(CITIES):
            base = 1.0 if c == "2. x" else 0.1
            rows.append((2024, c, city, base * (i + 1) / 5, base * ((i * 3) % 5) / 5, base * 0.5 * i, base * (5 - i) / 5))
    cent = spark.createDataFrame(rows, "year int, category string, city string, d_i double, c_i double, b_i double, e_i double")
    shuffled = cent.orderBy(F.rand(3))
    ref = _pandas_reference(cent.toPandas())
    for r in W.scores_all(shuffled).collect():
        assert r.score_correlation == pytest.approx(ref[(r.year, r.category, r.city)][0])


def test_custom_weights_validation(spark):
    cent = _panel(spark)
    W.score_custom(cent, {"D_i": .4, "C_i": .3, "B_i": .2, "E_i": .1})
    with pytest.raises(ValueError):
        W.score_custom(cent, {"D_i": .5, "C_i": .3, "B_i": .2, "E_i": .2})
    with pytest.raises(KeyError):
        W.score_custom(cent, {"D_i": .5, "C_i": .5, "B_i": 0.0})
    with pytest.raises(ValueError):
        W.score_custom(cent, {"D_i": 1.2, "C_i": -.2, "B_i": 0.0, "E_i": 0.0})
    W.score_custom(cent, {"D_i": .25, "C_i": .25, "B_i": .25, "E_i": .250011})
    with pytest.raises(ValueError):
        W.score_custom(cent, {"D_i": .25, "C_i": .25, "B_i": .25, "E_i": .2500111})


def test_rollup_rankings_compare(spark):
    scores = W.scores_all(_panel(spark))
    yearly = W.scores_by_year(scores)
    assert yearly.count() == 10
    pdf = scores.toPandas()
    exp = pdf.groupby(["year", "city"]).agg(e=("score_equal", "mean"), cw=("score_category_weighted", "sum"))
    for r in yearly.collect():
        assert r.score_equal == pytest.approx(exp.loc[(r.year, r.city), "e"])
        assert r.score_category_weighted == pytest.approx(exp.loc[(r.year, r.city), "cw"])
    ranks = W.rankings(yearly, "Score_Equal", 2024).orderBy("rank").collect()
    assert [r.rank for r in ranks] == [1, 2, 3, 4, 5]
    assert all(a.score_equal >= b.score_equal for a, b in zip(ranks, ranks[1:]))
    with pytest.raises(ValueError):
        W.rankings(yearly, "Score_Bogus", 2024)
    assert W.rankings(yearly, "Score_Equal", 1999).count() == 0
    cmp = W.compare_schemes(yearly, 2024, top_n=3)
    assert "score_score_equal" in cmp.columns and "rank_score_entropy" in cmp.columns
    for r in cmp.collect():
        assert any(getattr(r, f"rank_{s}") is not None for s in W.SCHEME_COLS)


def test_scheme_weights_sum_to_one(spark):
    cent = _panel(spark, seed=11)
    wc = W._corr_weights(W.metric_correlations(cent)).collect()
    we = W._entropy_weights(W.metric_entropy(cent)).collect()
    for r in wc + we:
        vals = [v for k, v in r.asDict().items() if k.startswith(("wc_", "we_"))]
        assert len(vals) == 4 and sum(vals) == pytest.approx(1.0) and all(v > 0 for v in vals)
