"""Chat formatting with cumulative-snapshot collapse.

Logs often hold a conversation several times, each snapshot with a few more
turns.  Every turn gets the rolling hash of the conversation up to it: the
running sum of position-keyed turn digests.  A conversation whose last hash is
a proper prefix hash of another one is a snapshot of it; an anti-join keeps the
maximal conversations, equal ones once, and only those are rendered.

Everything is DataFrame operations.  Turns are dealt by range of conversation
and order, and a turn's place is that in its range plus what earlier ranges
hold; running sums are two-level (``SPAN`` places to a span).  So a conversation
with a large share of all turns does not sort in one task, whatever its turn
numbers, and hashes are grouped before they are joined, so a first turn that a
third of all conversations share is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

SPAN = 256
# Characters of a text that ranges are told apart by: the driver holds a sample of them.
HEAD = 256
ROLE_OPEN, ROLE_CLOSE, TURN_END = "<|", "|>\n", "<|end|>\n"


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(ROLE_OPEN), F.coalesce(role, F.lit("unknown")), F.lit(ROLE_CLOSE),
                    F.coalesce(text, F.lit("")), F.lit(TURN_END))


def _digest_part(digest: Column, start: int) -> Column:
    """Twelve hex digits as a number below 2^48: sums over a span of up to 2^15 places stay in 64 bits."""
    return F.conv(F.substring(digest, start, 12), 16, 10).cast("long")


def placed_turns(turns: DataFrame) -> DataFrame:
    """(key, conv_id, turn, role, text) -> with pos (from 1) and n (turns of the conversation)."""
    order = [F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last()]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written, so that all readers see the same ranges.
    ranged = cut_lineage(turns.repartitionByRange(parts, F.col("key"), *order, F.substring("text", 1, HEAD).asc_nulls_last())
                         .withColumn("range", F.spark_partition_id()))
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(ranged.groupBy("key", "range").agg(F.count(F.lit(1)).alias("held"))
                          .select("key", "range", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("skip"),
                                  F.sum("held").over(Window.partitionBy("key")).alias("n")))
    within = Window.partitionBy("key", "range").orderBy(*order, F.col("text").asc_nulls_last())
    return (ranged.withColumn("inner", F.row_number().over(within)).join(offsets, ["key", "range"])
            .select("key", "conv_id", "turn", "role", "text", (F.col("skip") + F.col("inner")).alias("pos"), "n"))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(key, conv_id, turn, role, text) -> with pos (from 1), n (turns of the conversation), h1, h2."""
    digest = F.md5(F.concat(
        F.col("pos").cast("string"), F.lit("\x1f"),
        F.coalesce(F.concat(F.lit("r"), F.col("role")), F.lit("n")), F.lit("\x1f"),
        F.coalesce(F.concat(F.lit("t"), F.col("text")), F.lit("n"))))
    hashed = cut_lineage(placed_turns(turns).withColumn("digest", digest)
                         .select("key", "conv_id", F.floor((F.col("pos") - 1) / SPAN).alias("span"), "pos", "n", "role", "text",
                                 _digest_part(F.col("digest"), 1).alias("d1"),
                                 _digest_part(F.col("digest"), 13).alias("d2")))
    # Running sums modulo 2^48, span by span; those over spans as decimals, which no number of spans overflows.
    mod = 1 << 48
    earlier = Window.partitionBy("key").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    sums = hashed.groupBy("key", "span").agg(F.sum("d1").alias("t1"), F.sum("d2").alias("t2"))
    before = sums.select("key", "span", *[
        (F.coalesce(F.sum((F.col(t) % mod).cast("decimal(20,0)")).over(earlier), F.lit(0)) % mod).cast("long").alias(s)
        for t, s in (("t1", "s1"), ("t2", "s2"))])
    running = (Window.partitionBy("key", "span").orderBy("pos")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (hashed.withColumn("r1", F.sum("d1").over(running)).withColumn("r2", F.sum("d2").over(running))
            .join(cut_lineage(before), ["key", "span"])
            .select("key", "conv_id", "pos", "n", "role", "text",
                    ((F.col("r1") + F.col("s1")) % mod).alias("h1"), ((F.col("r2") + F.col("s2")) % mod).alias("h2")))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, n_turns, n_copies, n_chars and text of every maximal conversation.

    Turns are ordered by number, ties by role, then text; a turn logged twice in
    all four columns is one turn.  Conversations with the same turns are one
    (the smallest id stays, n_copies counts them); a proper prefix of another
    one goes.  Null ids form one conversation, null roles read "unknown", null
    texts are empty but differ from empty ones in comparison; null turn numbers
    come last.  Other columns are not read.  An empty table gives an empty table.
    """
    own = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                       F.col(role_col).alias("role"), F.col(text_col).alias("text")).distinct()
    key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n"))
    hashed = cut_lineage(prefix_hashes(own.withColumn("key", key)))

    whole = (hashed.where("pos = n").groupBy("n", "h1", "h2")
             .agg(F.min(F.struct(F.col("conv_id").isNull().alias("no_id"), "conv_id", "key")).alias("first"),
                  F.count(F.lit(1)).alias("n_copies")))
    shorter = hashed.where("pos < n").select(F.col("pos").alias("n"), "h1", "h2").distinct()
    maximal = cut_lineage(whole.join(shorter, ["n", "h1", "h2"], "left_anti")
                          .select(F.col("first.key").alias("key"), "n_copies"))

    # Digits of a number sort as numbers once padded; the array is sorted by position.
    kept = hashed.join(maximal, "key").select(
        "key", "conv_id", "n", "n_copies", F.struct("pos", rendered_turn(F.col("role"), F.col("text")).alias("part")).alias("turn"))
    return (kept.groupBy("key", "conv_id", "n", "n_copies").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
            .withColumn("text", F.array_join(F.col("turns.part"), ""))
            .select("conv_id", F.col("n").alias("n_turns"), "n_copies",
                    F.length("text").cast("long").alias("n_chars"), "text"))
