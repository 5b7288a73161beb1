"""Ranks and medians without gathering a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricenet.session import cut_lineage


def _ranged(df: DataFrame, order: Sequence[Column], partitions: int | None) -> DataFrame:
    """``df`` dealt by range of ``order``, written once, so all readers see the same range ids ``_pid``."""
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(parts, *order).withColumn("_pid", F.spark_partition_id()))


def _held_before(ranged: DataFrame, keys: Sequence[str], held: Column) -> DataFrame:
    """(keys, _pid, _off): how much of the key lies in earlier ranges; a row per key and range."""
    counts = ranged.groupBy(*keys, "_pid").agg(held.alias("_c"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*keys, "_pid", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))


def distributed_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank",
                     partitions: int | None = None) -> DataFrame:
    """Consecutive ranks 1..n within ``keys`` by ``order`` (which must leave no ties).

    Rows are dealt by range of (keys, order); a rank is the row's place in its
    range plus what earlier ranges hold of the key.  A key with a third of all
    rows spreads over as many ranges.
    """
    ranged = _ranged(df, [F.col(k).asc_nulls_first() for k in keys] + list(order), partitions)
    inside = Window.partitionBy(*keys, "_pid").orderBy(*order)
    return (ranged.withColumn("_place", F.row_number().over(inside))
            .join(_held_before(ranged, keys, F.count(F.lit(1))), [*keys, "_pid"])
            .withColumn(name, (F.col("_off") + F.col("_place")).cast("int")).drop("_pid", "_off", "_place"))


def exact_median(df: DataFrame, key: str, value: str, partitions: int | None = None) -> DataFrame:
    """Interpolated median of ``value`` per ``key`` (the mean of the two middle
    values for an even count).

    Equal values are counted first (map-side), so a value that fills most of a
    key is one row.  Distinct values are dealt by range, and running counts
    within a range, after what earlier ranges hold, tell which value covers
    the middle ranks.
    """
    counted = (df.select(F.col(key).alias("_k"), F.col(value).cast("double").alias("_v"))
               .where(F.col("_v").isNotNull()).groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("_c")))
    ranged = _ranged(counted, [F.col("_k"), F.col("_v")], partitions)
    totals = ranged.groupBy("_k").agg(F.sum("_c").alias("_n"))
    inside = Window.partitionBy("_k", "_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    placed = (ranged.withColumn("_seen", F.coalesce(F.sum("_c").over(inside), F.lit(0)))
              .join(_held_before(ranged, ["_k"], F.sum("_c")), ["_k", "_pid"]).join(totals, "_k")
              .withColumn("_first", F.col("_off") + F.col("_seen"))
              .withColumn("_end", F.col("_first") + F.col("_c")))
    covers = lambda rank: (F.col("_first") <= rank) & (rank < F.col("_end"))
    low, high = F.floor((F.col("_n") - 1) / 2), F.ceil((F.col("_n") - 1) / 2)
    return (placed.groupBy("_k").agg(F.max(F.when(covers(low), F.col("_v"))).alias("_low"),
                                     F.max(F.when(covers(high), F.col("_v"))).alias("_high"))
            .select(F.col("_k").alias(key), ((F.col("_low") + F.col("_high")) / 2).alias("median")))
