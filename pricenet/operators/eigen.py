"""Eigenvector centrality by power iteration (C4).

The stop rule and start vector follow the usual power method on (A + I):
x0 = 1/n, x <- (A + I) x, divide by the L2 norm, stop when the L1 change
is below n * tol; after ``max_iter`` rounds without convergence every node
of that network gets 0.

One path for every network: a grouped-map task per network runs its (up to a
thousand) rounds as sparse NumPy products.  A network has at most one node per
roster city and one edge per pair of them, so a task's size follows from the
roster, a parameter, and never from the observations.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricenet.functions.validation import EIGEN_MAX_ITER, EIGEN_TOL
from pricenet.operators.graph import adjacency
from pricenet.session import GROUP

# The grouped-map kernel travels to the Python workers by value, so workers
# need numpy and pandas but not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_OUT_SCHEMA = "year int, category string, city string, e_i double"


def _power_iteration(n: int, src: np.ndarray, dst: np.ndarray, max_iter: int, tol: float) -> np.ndarray:
    x = np.full(n, 1.0 / n)
    for _ in range(max_iter):
        last = x
        x = last + np.bincount(dst, weights=last[src], minlength=n)
        norm = float(np.sqrt(np.dot(x, x))) or 1.0
        x = x / norm
        if float(np.abs(x - last).sum()) < n * tol:
            return x
    return np.zeros(n)


def _grouped_kernel(max_iter: int, tol: float):
    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        node_rows = pdf[pdf["node_id"].notna()].sort_values("node_id")
        cities = node_rows["city"].tolist()
        index = {c: i for i, c in enumerate(cities)}
        edge_rows = pdf[pdf["node_id"].isna()]
        src = edge_rows["src"].map(index).to_numpy(dtype=np.int64)
        dst = edge_rows["dst"].map(index).to_numpy(dtype=np.int64)
        x = _power_iteration(len(cities), src, dst, max_iter, tol)
        return pd.DataFrame({
            "year": node_rows["year"].to_numpy(),
            "category": node_rows["category"].to_numpy(),
            "city": cities,
            "e_i": x,
        })
    return kernel


def _grouped(nodes: DataFrame, edges: DataFrame, max_iter: int, tol: float) -> DataFrame:
    node_part = nodes.select(*GROUP, F.col("node_id").cast("long"), "city",
                             F.lit(None).cast("string").alias("src"),
                             F.lit(None).cast("string").alias("dst"))
    adj = adjacency(edges)
    edge_part = adj.select(*GROUP, F.lit(None).cast("long").alias("node_id"),
                           F.lit(None).cast("string").alias("city"), "src", "dst")
    # Up to a thousand rounds per network make this stage CPU-bound for its
    # size: hash-partition by network with the configured partition count
    # (a count-based repartition is not merged by size-based coalescing) so
    # networks spread over tasks; the grouping reuses this partitioning.
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (node_part.unionByName(edge_part).repartition(parts, *GROUP).groupBy(*GROUP)
            .applyInPandas(_grouped_kernel(max_iter, tol), schema=_OUT_SCHEMA))


def eigenvector(nodes: DataFrame, edges: DataFrame, networks: DataFrame,
                max_iter: int = EIGEN_MAX_ITER, tol: float = EIGEN_TOL) -> DataFrame:
    """C4 for every network in ``networks``: ``(year, category, city, e_i)``."""
    keep = networks.select(*GROUP)
    return _grouped(nodes.join(keep, GROUP, "left_semi"), edges.join(keep, GROUP, "left_semi"), max_iter, tol)
