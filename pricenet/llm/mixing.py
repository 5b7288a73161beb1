"""Mixing sources to target weights: capped water-filling over the sources,
then a seeded choice of whole and fractional repetitions of documents.

All sources share ``share`` times the corpus by weight.  A source may not be
repeated more than ``max_epochs`` times: where its share is larger it is
clamped there and the excess goes to the others by weight, until none is
above.  Raising one common level ``v`` and clamping each source at
``cap = max_epochs * size`` ends where ``sum(min(cap, weight * v))`` equals the
total, so sources clamp in the order of ``cap / weight`` and one running sum
over the source table gives every round of the redistribution at once.

A source's target is ``e`` epochs.  Every document is taken ``floor(e)`` times
whole.  The rest of the target is filled in a seeded order of the source's
documents: each gives all its words once more, the last one only as many as
are missing.  The order is a hash, so reruns agree whatever the partitions.

Running sums are two-level: the hash order is cut into ``BUCKETS`` ranges per
source, so a source with a third of all rows still spreads over the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> the same with ``target`` words.

    Sources rank by code point, null last; weights repeat along that order.
    One row per source, never per document, passes through the window.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = (sizes
                .withColumn("rank", F.row_number().over(order))
                .withColumn("weight", F.element_at(
                    F.array(*[F.lit(float(w)) for w in weights]),
                    ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
                .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
                .withColumn("total", F.sum("source_size").over(Window.partitionBy()) * F.lit(share))
                .withColumn("all_weight", F.sum("weight").over(Window.partitionBy())))
    by_clamp = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_clamp.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    rounds = (weighted.withColumn("level", level)
              .withColumn("open", F.col("weight") * F.col("level") < F.col("cap")))
    # The first open source of the clamp order carries the final level.
    final = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        by_clamp.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rounds.select("source", "source_size",
                         F.coalesce(F.col("weight") * final, F.col("cap")).alias("target"))


# Ranges of the hash order per source: the first three hex digits.
BUCKET_DIGITS = 3


def _planned(docs: DataFrame, carried: list[Column], id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """Every row's part in the mix, with the ``carried`` columns of the row itself."""
    source_id = F.col(id_col).cast("long")
    # The text is part of the place, so rows with one id, or none, spread over the order like others.
    place = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(source_id.cast("string"), F.lit("null")), F.lit(":"),
                           F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    # A null source is a group like any other, so joins compare null-safe through a string key.
    source = F.col(source_col).cast("string")
    key = F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))
    plan = [source_id.alias("doc_id"), source.alias("source"), word_count(F.col(text_col)).alias("size"), place.alias("place"),
            F.substring(place, 1, BUCKET_DIGITS).alias("bucket"), key.alias("skey")]
    # Written without the carried columns: whole rows are read again instead of stored twice.
    sized = cut_lineage(docs.select(*plan))
    targets = cut_lineage(source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_epochs))
    buckets = sized.groupBy("skey", "bucket").agg(F.sum("size").alias("held"))
    earlier = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(buckets.select(
        "skey", "bucket", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("offset")))
    within = (Window.partitionBy("skey", "bucket").orderBy("place", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    # Few sources, measured size: the planner broadcasts this table by itself.
    target_key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("skey")
    per_source = targets.select(target_key, "source_size", "target")
    rows = docs.select(*plan, *carried) if carried else sized
    placed = (rows.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
              .join(offsets, ["skey", "bucket"]).join(per_source, "skey"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.round(F.col("target") - F.col("whole_reps") * F.col("source_size")).cast("long")
    extra = F.greatest(F.lit(0).cast("long"),
                       F.least(F.col("size"), rest - (F.col("offset") + F.col("inner"))))
    return placed.withColumn("whole_reps", whole.cast("long")).withColumn("extra_words", extra)


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, whole_reps, extra_words, source per document.

    Options: id_col, text_col, source_col, weights, share, max_epochs, seed.
    Null text: size 0, nothing taken.  Null source: a source of its own, last in
    order.  Null and repeated ids: every row is a document of its own, decided by
    itself (equal rows are interchangeable).  Very long texts count whole.  An
    empty table gives an empty table.  An all-empty source has target 0.
    """
    return _planned(docs, [], **options).select(
        "doc_id", "size", "source_size", "target",
        (F.col("whole_reps") * F.col("size") + F.col("extra_words")).alias("taken"), "whole_reps", "extra_words", "source")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as the mix repeats them, with their own columns.

    Each row appears ``whole_reps`` times; the fractional repetition adds one
    more where it takes at least half of the document's words.  Rows are
    decided one by one, whatever their ids; nulls, empty and very long texts
    and the empty table as in :func:`mix`.
    """
    # Under positions, so that no column name clashes.
    carried = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)]).alias("row")
    part = (F.col("extra_words") > 0) & (F.col("extra_words") * 2 >= F.col("size"))
    reps = (F.col("whole_reps") + F.when(part, 1).otherwise(0)).cast("int")
    return (_planned(docs, [carried], **options).select("row", reps.alias("reps")).where("reps > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("reps"))))
            .select(*[F.col(f"row.c{k}").alias(c) for k, c in enumerate(docs.columns)]))
