"""Data feeds behind the plots and the dashboard.

Rendering is out of scope; these return the exact rows each view shows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricenet.functions.validation import check_tau
from pricenet.operators.centrality import METRIC_COLS
from pricenet.operators.scoring import RANK_DIGITS, SCHEME_COLS
from pricenet.session import GROUP


def network_feed(degrees: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """G1: node size 100 * degree + 100; edge width = weight (1 unweighted)."""
    nodes = degrees.select(*GROUP, "city", "degree",
                           (F.col("degree") * 100 + 100).alias("node_size"))
    links = edges.select(*GROUP, "u", "v", F.coalesce("weight", F.lit(1.0)).alias("width"))
    return nodes, links


def radar_feed(cent: DataFrame, city: str, year: int) -> DataFrame:
    """One city and year, every metric of every category."""
    return (cent.where((F.col("city") == F.lit(city)) & (F.col("year") == F.lit(year)))
            .unpivot(GROUP + ["city"], METRIC_COLS, "metric", "value"))


def top_by_scheme_feed(year_scores: DataFrame, top_n: int = 10, year: int | None = None) -> DataFrame:
    """Top-N cities of each available scheme per year (ties by city)."""
    present = [s for s in SCHEME_COLS if s in year_scores.columns]
    df = year_scores if year is None else year_scores.where(F.col("year") == F.lit(year))
    long = df.unpivot(["year", "city"], present, "scheme", "score")
    w = Window.partitionBy("year", "scheme").orderBy(F.round("score", RANK_DIGITS).desc(), F.col("city").asc())
    return long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)


def metric_series_feed(evolution: DataFrame, category: str, metric: str = "density") -> DataFrame:
    """One metric of one category by year, in year order."""
    if metric not in evolution.columns:
        raise ValueError(f"Unknown evolution metric '{metric}'")
    return (evolution.where(F.col("category") == F.lit(category))
            .select("year", F.col(metric).alias("value")).orderBy("year"))


def overview_counts(observations: DataFrame, tau: float) -> DataFrame:
    """Number of cities, categories and years, and the threshold.

    Each count reads its own column, whose values shrink to distinct ones
    before their shuffle, so no row is expanded into one for each count.
    """
    def distinct(column: str) -> DataFrame:
        return observations.select(column).distinct().agg(F.count(column).alias(f"num_{column}"))
    return distinct("city").select(
        F.col("num_city").alias("num_cities"), distinct("category").scalar().alias("num_categories"),
        distinct("year").scalar().alias("num_years"), F.lit(check_tau(tau)).alias("threshold"))
