"""Mergeable moments of a value per key: count, mean, sum of squared deviations, smallest and largest value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE = ["n", "mean", "m2", "lo", "hi"]


def moments(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """One row of :data:`STATE` per key; keys without any value are left out."""
    n = F.count(value)
    return (df.groupBy(*by).agg(n.alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * n).alias("m2"),
                                F.min(value).alias("lo"), F.max(value).alias("hi")).where("n > 0"))


def merged(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Moments of both inputs' rows together (at most one row a key in each; keys compare null-safe)."""
    left = a.select(*by, F.struct(*STATE).alias("a"))
    right = b.select(*[F.col(k).alias(f"_{k}") for k in by], F.struct(*STATE).alias("b"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in by]
    both = left.join(right, same, "full")
    x, y = F.col("a"), F.col("b")
    n = x.n + y.n
    delta = y["mean"] - x["mean"]
    joint = F.struct(n.alias("n"), (x["mean"] + delta * y.n / n).alias("mean"),
                     (x.m2 + y.m2 + delta * delta * x.n * y.n / n).alias("m2"),
                     F.least(x.lo, y.lo).alias("lo"), F.greatest(x.hi, y.hi).alias("hi"))
    keys = [F.when(x.isNull(), F.col(f"_{k}")).otherwise(F.col(k)).alias(k) for k in by]
    return both.select(*keys, F.coalesce(F.when(x.isNotNull() & y.isNotNull(), joint), x, y).alias("s")).select(*by, "s.*")


def zscored(df: DataFrame, state: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """Z = (X - mean) / sample deviation from stored moments; 0 where the deviation is null or zero.

    Equal extremes tell a constant key, which rounding in merged means may hide.
    """
    right = state.select(*[F.col(k).alias(f"_{k}") for k in by], *[F.col(c).alias(f"_{c}") for c in STATE])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in by]
    flat = F.col("_n").isNull() | (F.col("_n") < 2) | (F.col("_lo") == F.col("_hi"))
    z = F.when(flat, F.lit(0.0)).otherwise((F.col(value) - F.col("_mean")) / F.sqrt(F.col("_m2") / (F.col("_n") - 1)))
    return df.join(right, same, "left").withColumn(out, z).select(*df.columns, out)
