"""Summary report (S3) and result sink."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricenet.operators.centrality import RANK_DIGITS


def summary_counts(networks: DataFrame, cent: DataFrame, evolution: DataFrame) -> DataFrame:
    """S3 figures as one row: networks, centrality rows, cities, mean density / clustering."""
    # Each figure is a global aggregate; the others enter as scalar subqueries.
    return networks.agg(F.count("*").alias("num_networks")).select(
        "num_networks",
        cent.agg(F.count("*")).scalar().alias("num_centrality_rows"),
        cent.agg(F.countDistinct("city")).scalar().alias("unique_cities"),
        evolution.agg(F.avg("density")).scalar().alias("mean_density"),
        evolution.agg(F.avg("clustering")).scalar().alias("mean_clustering"))


def top5_by_year(year_scores: DataFrame, k: int = 5) -> DataFrame:
    """S3 rankings: the k best cities of every year by the equal-weight score."""
    w = Window.partitionBy("year").orderBy(F.round("score_equal", RANK_DIGITS).desc(), F.col("city").asc())
    return (year_scores.select("year", "city", "score_equal")
            .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k))


def render_markdown(summary: DataFrame, top5: DataFrame, when: _dt.datetime | None = None) -> str:
    """The report as Markdown: one table of figures, one table of leading cities.

    Only the one-row summary and the leading rows (k per year) reach the
    driver; both are bounded by the report's definition.
    """
    figures, leaders = summary.first(), top5.orderBy("year", "rank").collect()
    made = (when or _dt.datetime.now()).isoformat(sep=" ", timespec="minutes")
    parts = ["# Price similarity networks", f"Made {made} from {figures.num_networks} networks.",
             "| figure | value |\n|---|---|\n" + "\n".join(f"| {name} | {value} |" for name, value in (
                 ("networks", figures.num_networks), ("cities", figures.unique_cities),
                 ("city rows over all networks", figures.num_centrality_rows),
                 ("mean density", _decimal(figures.mean_density)),
                 ("mean clustering", _decimal(figures.mean_clustering))))]
    years = sorted({r.year for r in leaders})
    if years:
        places = max(r.rank for r in leaders)
        cells = {(r.year, r.rank): f"{r.city} ({_decimal(r.score_equal)})" for r in leaders}
        head = "| year |" + "".join(f" {k} |" for k in range(1, places + 1)) + "\n|---|" + "---|" * places
        rows = [f"| {y} |" + "".join(f" {cells.get((y, k), '')} |" for k in range(1, places + 1)) for y in years]
        parts += ["## Leading cities by equal weights", "\n".join([head, *rows])]
    return "\n\n".join(parts) + "\n"


def _decimal(value: float | None) -> str:
    return "none" if value is None else f"{value:.4f}"


REPORT_FILE = "analysis_report.md"


def save_report(spark: SparkSession, text: str, output_dir: str) -> str:
    """Write the report beside the tables, through the file system of the output path."""
    path = f"{output_dir.rstrip('/')}/{REPORT_FILE}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return path


# Output names of the four result tables.
RESULT_TABLES = ["centrality_scores", "weighted_scores", "final_rankings", "network_evolution"]


def save_results(results: Mapping[str, DataFrame | None], output_dir: str, fmt: str = "parquet",
                 partition_by_year: bool = True) -> list[str]:
    """Write every present result table under ``output_dir``.

    Tables with a ``year`` column are partitioned by it, so later reads of one
    year prune the others.  A full run replaces whole tables: years that an
    earlier run wrote do not stay among its results.
    """
    written = []
    for name in RESULT_TABLES:
        df = results.get(name)
        if df is None:
            continue
        w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition_by_year and "year" in df.columns:
            w = w.partitionBy("year")
        path = f"{output_dir.rstrip('/')}/{name}"
        if fmt == "csv":
            w.option("header", "true").csv(path)
        else:
            w.format(fmt).save(path)
        written.append(path)
    return written
