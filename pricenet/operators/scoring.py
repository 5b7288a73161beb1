"""Weighting schemes, yearly roll-up and rankings.

Per-network statistics (correlations, entropies) are computed once in a
single grouped aggregate and joined back on ``(year, category)`` — by key,
never by row position, so input order cannot move scores between rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricenet.functions.exprs import abs_pearson
from pricenet.functions.quantiles import distributed_rank
from pricenet.functions.validation import (
    DEFAULT_METRIC_WEIGHTS, ENTROPY_EPS, SCHEMES, UNKNOWN_CATEGORY_WEIGHT, check_metric_weights,
    check_scheme)
from pricenet.operators.centrality import METRIC_COLS, RANK_DIGITS
from pricenet.session import GROUP, cut_lineage

SCHEME_COLS = [s.lower() for s in SCHEMES]
_PAIRS = [(a, b) for i, a in enumerate(METRIC_COLS) for b in METRIC_COLS[i + 1:]]


def _weighted_sum(weights: Mapping[str, object]):
    return sum((F.col(m) * (F.lit(w) if isinstance(w, float) else w)) for m, w in weights.items())


def score_equal(cent: DataFrame) -> DataFrame:
    """0.25 * (D + C + B + E)."""
    return cent.withColumn("score_equal", F.lit(0.25) * (F.col("d_i") + F.col("c_i") + F.col("b_i") + F.col("e_i")))


def metric_correlations(cent: DataFrame) -> DataFrame:
    """|Pearson r| for the six metric pairs per network (undefined -> 0)."""
    return cent.groupBy(*GROUP).agg(*[abs_pearson(a, b).alias(f"rho_{a}_{b}") for a, b in _PAIRS])


def _corr_weights(rho: DataFrame) -> DataFrame:
    raw = {}
    for m in METRIC_COLS:
        others = [F.col(f"rho_{a}_{b}") for a, b in _PAIRS if m in (a, b)]
        raw[m] = F.lit(1.0) / (F.lit(1.0) + sum(others))
    total = sum(raw.values())
    cols = [F.when(total > 0, raw[m] / total).otherwise(F.lit(0.25)).alias(f"wc_{m}") for m in METRIC_COLS]
    return rho.select(*GROUP, *cols)


def score_correlation(cent: DataFrame) -> DataFrame:
    """w_k = 1 / (1 + sum_j |r_kj|), normalised to sum 1."""
    w = _corr_weights(metric_correlations(cent))
    out = cent.join(w, GROUP, "left")
    score = _weighted_sum({m: F.col(f"wc_{m}") for m in METRIC_COLS})
    return out.withColumn("score_correlation", score).drop(*[f"wc_{m}" for m in METRIC_COLS])


def score_category(cent: DataFrame, category_weights: Mapping[str, float] | None = None,
                   default: float = UNKNOWN_CATEGORY_WEIGHT) -> DataFrame:
    """Equal score times the category's weight (unknown category -> 0.1).

    The weights are a literal map expression: no join, no shuffle.
    """
    weights = dict(category_weights or {})
    eq = F.lit(0.25) * (F.col("d_i") + F.col("c_i") + F.col("b_i") + F.col("e_i"))
    if weights:
        lookup = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
        w = F.coalesce(lookup[F.col("category")], F.lit(float(default)))
    else:
        w = F.lit(float(default))
    return cent.withColumn("score_category", eq).withColumn("score_category_weighted", F.col("score_category") * w)


def _shares(cent: DataFrame) -> DataFrame:
    """``cent`` with ``p_<metric>``: the share of each value in its network's total, plus 1e-10.

    Uniform shares where the total is <= 1e-10.  Totals are one aggregated row
    per network, joined back.
    """
    totals = cut_lineage(cent.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(m).alias(f"_t_{m}") for m in METRIC_COLS]))
    out = cent.join(totals, GROUP).withColumns({
        f"p_{m}": F.when(F.col(f"_t_{m}") > ENTROPY_EPS, F.col(m) / F.col(f"_t_{m}"))
        .otherwise(F.lit(1.0) / F.col("_n")) + F.lit(ENTROPY_EPS) for m in METRIC_COLS})
    return out.drop("_n", *[f"_t_{m}" for m in METRIC_COLS])


def _entropies() -> list:
    return [(-F.sum(F.col(f"p_{m}") * F.log(F.col(f"p_{m}")))).alias(f"h_{m}") for m in METRIC_COLS]


def metric_entropy(cent: DataFrame) -> DataFrame:
    """Shannon entropy -sum p ln p of each metric within a network.

    The shares are not renormalised after the 1e-10 is added.
    """
    return _shares(cent.select(*GROUP, *METRIC_COLS)).groupBy(*GROUP).agg(*_entropies())


def _entropy_weights(ent: DataFrame) -> DataFrame:
    total = sum(F.col(f"h_{m}") for m in METRIC_COLS)
    cols = [F.when(total > ENTROPY_EPS, F.col(f"h_{m}") / total).otherwise(F.lit(0.25)).alias(f"we_{m}")
            for m in METRIC_COLS]
    return ent.select(*GROUP, *cols)


def score_entropy(cent: DataFrame) -> DataFrame:
    """w_k = H_k / sum H (equal weights when sum H <= 1e-10)."""
    w = _entropy_weights(metric_entropy(cent))
    score = _weighted_sum({m: F.col(f"we_{m}") for m in METRIC_COLS})
    return cent.join(w, GROUP, "left").withColumn("score_entropy", score).drop(
        *[f"we_{m}" for m in METRIC_COLS])


def score_custom(cent: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """User weights (validated on the driver: keys, sign, sum to 1)."""
    w = check_metric_weights(weights)
    return cent.withColumn("score_interactive", _weighted_sum({m.lower(): v for m, v in w.items()}))


def scores_all(cent: DataFrame, category_weights: Mapping[str, float] | None = None,
               interactive: Mapping[str, float] | None = None) -> DataFrame:
    """All schemes in one plan; per-network statistics computed once.

    One grouped aggregate produces both the correlation moments and the
    entropies; it is joined back to the centrality rows on the network key.
    """
    stats = cut_lineage(_shares(cent.select(*GROUP, *METRIC_COLS)).groupBy(*GROUP).agg(
        *[abs_pearson(a, b).alias(f"rho_{a}_{b}") for a, b in _PAIRS], *_entropies()))
    wc = _corr_weights(stats)
    we = _entropy_weights(stats)
    weights = cut_lineage(wc.join(we, GROUP))
    out = score_equal(cent).join(weights, GROUP, "left")
    out = out.withColumn("score_correlation", _weighted_sum({m: F.col(f"wc_{m}") for m in METRIC_COLS}))
    out = score_category(out, category_weights)
    out = out.withColumn("score_entropy", _weighted_sum({m: F.col(f"we_{m}") for m in METRIC_COLS}))
    out = score_custom(out, interactive or DEFAULT_METRIC_WEIGHTS)
    return out.drop(*[f"wc_{m}" for m in METRIC_COLS], *[f"we_{m}" for m in METRIC_COLS])


def scores_by_year(scores: DataFrame, sort: bool = True) -> DataFrame:
    """(year, city) roll-up — mean of four schemes, sum of category-weighted.

    Only scheme columns present are aggregated; averages run over the
    networks that exist for that year.  ``sort`` orders by year, then
    score_equal descending (a global sort: leave it off when the result
    feeds further ranking or aggregation).
    """
    aggs = []
    for s in SCHEME_COLS:
        if s in scores.columns:
            fn = F.sum if s == "score_category_weighted" else F.avg
            aggs.append(fn(s).alias(s))
    out = scores.groupBy("year", "city").agg(*aggs)
    if not sort:
        return out
    order = [F.col("year").asc()] + ([F.col("score_equal").desc()] if "score_equal" in out.columns else [])
    return out.orderBy(*order, F.col("city").asc())


def rankings(year_scores: DataFrame, scheme: str, year: int | None = None) -> DataFrame:
    """Consecutive ranks 1..n by a scheme within a year (ties by city).

    With ``year`` set, one year; otherwise every year, ranked separately.  Ranks
    are distributed: no task sorts a whole year.
    """
    s = check_scheme(scheme).lower()
    df = year_scores if year is None else year_scores.where(F.col("year") == F.lit(year))
    ranked = distributed_rank(df.select("year", "city", s), ["year"],
                              [F.round(s, RANK_DIGITS).desc(), F.col("city").asc()])
    return ranked.select("year", "rank", "city", s)


def compare_schemes(year_scores: DataFrame, year: int | None = None, top_n: int = 10) -> DataFrame:
    """Top-N of every present scheme side by side, outer-merged on city.

    Columns ``rank_<scheme>`` and ``score_<scheme>`` (so ``score_score_equal``);
    null where the city is outside that scheme's top N.  One unpivot, one
    per-scheme top-k and one grouped pivot — a single shuffle on city
    instead of a chain of outer joins.
    """
    present = [s for s in SCHEME_COLS if s in year_scores.columns]
    df = year_scores if year is None else year_scores.where(F.col("year") == F.lit(year))
    long = df.unpivot(["year", "city"], present, "scheme", "score")
    w = Window.partitionBy("year", "scheme").orderBy(F.round("score", RANK_DIGITS).desc(), F.col("city").asc())
    top = long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)
    aggs = []
    for s in present:
        aggs.append(F.max(F.when(F.col("scheme") == s, F.col("rank"))).alias(f"rank_{s}"))
        aggs.append(F.max(F.when(F.col("scheme") == s, F.col("score"))).alias(f"score_{s}"))
    return top.groupBy("year", "city").agg(*aggs)
