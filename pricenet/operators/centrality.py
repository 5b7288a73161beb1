"""Centrality table and its summaries.

C2 and C3 live in :mod:`pricenet.operators.paths`, C4 in
:mod:`pricenet.operators.eigen`.  Metric columns are ``d_i c_i b_i e_i``;
the reference names ``D_i`` ... are accepted wherever a metric is named.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricenet.functions.quantiles import exact_median
from pricenet.functions.validation import METRICS, check_metric
from pricenet.session import GROUP, cut_lineage

METRIC_COLS = [m.lower() for m in METRICS]
# Values equal to 9 decimals are ties: float noise must not reorder.
RANK_DIGITS = 9


def degree_centrality(degrees: DataFrame, n: int) -> DataFrame:
    """Degree / (n - 1); a one-node network gets 1."""
    d = F.col("degree") / F.lit(float(n - 1)) if n > 1 else F.lit(1.0)
    return degrees.select(*GROUP, "city", d.alias("d_i"))


def centrality_table(nodes: DataFrame, deg: DataFrame, clo: DataFrame, btw: DataFrame,
                     eig: DataFrame) -> DataFrame:
    """One row per node of every network; a missing metric is 0."""
    key = GROUP + ["city"]
    out = (nodes.select(*key)
           .join(deg.select(*key, "d_i"), key, "left")
           .join(clo.select(*key, "c_i"), key, "left")
           .join(btw.select(*key, "b_i"), key, "left")
           .join(eig.select(*key, "e_i"), key, "left"))
    return out.select(*key, *[F.coalesce(m, F.lit(0.0)).alias(m) for m in METRIC_COLS])


def minmax_normalize(cent: DataFrame) -> DataFrame:
    """Per-network min-max scaling of each metric, constant network -> 0.5.

    The extremes are one aggregated row per network, joined back.
    """
    ends = cut_lineage(cent.groupBy(*GROUP).agg(
        *[F.min(m).alias(f"_lo_{m}") for m in METRIC_COLS], *[F.max(m).alias(f"_hi_{m}") for m in METRIC_COLS]))
    cols = {}
    for m in METRIC_COLS:
        lo, hi = F.col(f"_lo_{m}"), F.col(f"_hi_{m}")
        cols[f"{m}_norm"] = F.when(hi == lo, F.lit(0.5)).otherwise((F.col(m) - lo) / (hi - lo))
    return cent.join(ends, GROUP).withColumns(cols).drop(*[c for c in ends.columns if c not in GROUP])


def top_cities(cent: DataFrame, metric: str, n: int = 10, year: int | None = None,
               category: str | None = None) -> DataFrame:
    """The n largest rows by a metric, optional year / category filter.

    Values equal to 9 decimals are ties, broken by city, year, category
    (ascending).  Planned as a top-k (TakeOrderedAndProject), never a full sort.
    """
    m = check_metric(metric).lower()
    df = cent
    if year is not None:
        df = df.where(F.col("year") == F.lit(year))
    if category is not None:
        df = df.where(F.col("category") == F.lit(category))
    return df.orderBy(F.round(m, RANK_DIGITS).desc(), "city", "year", "category").limit(n)


def _long_metrics(cent: DataFrame) -> DataFrame:
    return cent.unpivot(GROUP + ["city"], METRIC_COLS, "metric", "value")


def centrality_summary(cent: DataFrame) -> DataFrame:
    """Mean, median, sample std, min, max and zero count per metric.

    Zeros are counted on raw values.  The moments are partial aggregates;
    the median is exact (interpolated) and computed by distributed ranking,
    so no metric's values are gathered into one task.
    """
    long = _long_metrics(cent)
    moments = long.groupBy("metric").agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.count_if(F.col("value") == 0).alias("zeros"))
    med = exact_median(long, "metric", "value")
    return moments.join(med, "metric", "left").select(
        "metric", "mean", "median", "std", "min", "max", "zeros")


def top_per_metric(cent: DataFrame, k: int = 3) -> DataFrame:
    """The k largest rows of each metric (a city may appear twice).

    ``row_number <= k`` over a window is planned as a per-partition top-k
    before the shuffle (WindowGroupLimit), so only k rows per metric and
    partition move.
    """
    w = Window.partitionBy("metric").orderBy(F.round("value", RANK_DIGITS).desc(), "city", "year", "category")
    return (_long_metrics(cent).withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k))
