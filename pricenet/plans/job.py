"""Batch job surface: ``run_full_analysis`` (J1) and the CLI ``main``.

    spark-submit pricenet/plans/job.py --input obs.parquet --cities A,B,C \\
        --years 2023 2024 --threshold 0.75 --output /shared/results

A failing step is reported and its result left out, later steps run on what
exists; the command then ends with an error that names the failed steps.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricenet.functions.validation import check_metric_weights
from pricenet.operators import scoring as W
from pricenet.plans.analysis import Analysis
from pricenet.plans.publish import publish_results
from pricenet.plans.report import render_markdown, save_report, save_results, summary_counts, top5_by_year
from pricenet.session import GROUP, drop_run_tables
from pricenet.sources.panel import read_observations

log = logging.getLogger("pricenet")


def run_full_analysis(observations: DataFrame, cities: Sequence[str], tau: float = 0.75,
                      years: Sequence[int] | None = None, categories: Sequence[str] | None = None,
                      output_dir: str | None = None, weighted: bool = False,
                      category_weights: Mapping[str, float] | None = None,
                      metric_weights: Mapping[str, float] | None = None, fmt: str = "parquet",
                      publish: bool = False) -> dict[str, Any]:
    """Build networks, centralities, scores, roll-up and evolution; save.

    Returns the result tables (DataFrames; the shared ones are already
    materialised), the markdown report and ``failed``, the names of steps
    that raised.  With ``output_dir`` tables are written in ``fmt`` (parquet
    or csv), the report beside them.  With ``publish`` they are staged and
    appear as a whole (see :mod:`pricenet.plans.publish`), or, where a step
    has failed, not at all.  ``category_weights`` scale the scores of
    categories (unnamed ones by 0.1), ``metric_weights`` make the interactive
    score (equal weights where none are given).
    """
    if metric_weights is not None:
        check_metric_weights(metric_weights)
    a = Analysis(observations, cities, tau=tau, weighted=weighted, years=years, categories=categories,
                 category_weights=category_weights, interactive_weights=metric_weights)
    results: dict[str, Any] = {"analysis": a, "failed": []}

    def step(name: str, needs: Sequence[str], fn) -> None:
        if any(results.get(x) is None for x in needs):
            results[name] = None
            return
        try:
            results[name] = fn()
        except Exception as exc:
            log.error("step %s failed: %s", name, exc)
            results[name] = None
            results["failed"].append(name)

    step("networks", [], lambda: a.networks)
    step("centrality_scores", ["networks"], lambda: a.centrality)
    step("weighted_scores", ["centrality_scores"], lambda: a.scores)
    step("final_rankings", ["weighted_scores"], lambda: W.scores_by_year(a.scores))
    step("network_evolution", ["networks"], lambda: a.evolution.orderBy(*GROUP))
    step("report", ["centrality_scores", "final_rankings", "network_evolution"], lambda: render_markdown(
        summary_counts(a.networks, a.centrality, a.evolution), top5_by_year(a.year_scores)))
    if output_dir and publish:
        if not results["failed"]:
            step("published", [], lambda: publish_results(results, results["report"], observations.sparkSession,
                                                          output_dir, fmt))
    elif output_dir:
        step("saved", [], lambda: save_results(results, output_dir, fmt))
        step("saved_report", ["report"], lambda: save_report(observations.sparkSession, results["report"], output_dir))
    return results


def parsed_weights(text: str) -> dict[str, float]:
    """``name=value,name=value`` or a JSON object as weights by name."""
    if text.lstrip().startswith("{"):
        pairs = json.loads(text).items()
    else:
        pairs = [p.rsplit("=", 1) for p in text.split(",") if p.strip()]
        if any(len(p) != 2 for p in pairs):
            raise ValueError(f"weights are name=value pairs: {text!r}")
    return {name.strip(): float(value) for name, value in pairs}


def main(argv: Sequence[str] | None = None) -> int:
    """Command-line job; 0 only if every step succeeded.

    Bad rows of CSV and JSON input go to ``--rejects`` (by default the table
    ``rejected_rows`` of the output).  ``--quick`` keeps the first of the given years, or the earliest year of the
    input where none is given.
    """
    p = argparse.ArgumentParser(description="Price similarity network analysis")
    p.add_argument("--input", required=True, help="observation table (parquet/csv/json)")
    p.add_argument("--format", default="parquet", help="format of the input")
    p.add_argument("--cities", required=True, help="comma-separated city roster")
    p.add_argument("--years", type=int, nargs="*")
    p.add_argument("--categories", nargs="*")
    p.add_argument("--threshold", type=float, default=0.75)
    p.add_argument("--output", default="data/results")
    p.add_argument("--output-format", choices=["parquet", "csv"], default="parquet")
    p.add_argument("--publish", action="store_true", help="stage the results, let them appear as a whole")
    p.add_argument("--rejects", help="table for bad input rows")
    p.add_argument("--category-weights", type=parsed_weights, help="Food=0.25,Fuel=0.35 or a JSON object")
    p.add_argument("--metric-weights", type=parsed_weights, help="D_i=0.4,C_i=0.3,B_i=0.2,E_i=0.1 or a JSON object")
    p.add_argument("--quick", action="store_true")
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName("pricenet").getOrCreate()
    obs = read_observations(spark, args.input, args.format, rejects=args.rejects or f"{args.output.rstrip('/')}/rejected_rows")
    years = args.years
    if args.quick:
        first = years[0] if years else obs.agg(F.min("year")).first()[0]
        years = [] if first is None else [first]
    res = run_full_analysis(obs, args.cities.split(","), tau=args.threshold, years=years,
                            categories=args.categories, output_dir=args.output, fmt=args.output_format,
                            category_weights=args.category_weights, metric_weights=args.metric_weights,
                            publish=args.publish)
    drop_run_tables(spark)
    if res.get("report"):
        print(res["report"])
    if res["failed"]:
        print("failed steps: " + ", ".join(res["failed"]), file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
