"""Document fingerprints by a threshold-scaled sketch.

Every hash of a five-word shingle below a fixed fraction of the hash range is
kept (and the smallest hash in any case, so that short texts have one).  The
sketch grows with its document, so sketches of very unequal documents estimate
containment, and the sketch of a union is the union of sketches.

The registered use also edits each text with the start of the next document.
Neighbours meet in one shuffle: ids are cut into ranges at their own
quantiles, the first document of each range is also sent to the range before,
and a window takes the following row.  Only texts are shuffled: sketches are
made where a range has met.  All of it is DataFrame operations.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
# One shingle in so many is kept.
FRACTION = 2
SPACE = " \t\n\x0b\x0c\r"
# Ranges of ids: about so many documents at least, and so many ranges at most.
RANGE_ROWS = 64
FEW_RANGES, MOST_RANGES, LARGE_RANGE = 1024, 65_536, 20_000

_LOWEST = -(1 << 63)


def word_hashes(text: Column) -> Column:
    """Hashes of the words (runs without ASCII white space, lower-cased) in order."""
    trimmed = F.btrim(F.lower(text), F.lit(SPACE))
    words = F.split(trimmed, r"[\x20\x09-\x0D]+")
    return F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(F.transform(words, lambda w: F.xxhash64(w)))


def shingle_hashes(words: Column, k: int = SHINGLE) -> Column:
    """Hashes of all ``k``-word shingles; fewer words are one shingle, none are none.

    ``words`` has to be a column, not an expression: a lambda would evaluate it
    again for each element.
    """
    n = F.size(words)
    return (F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k),
                                       lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)])))
            .when(n > 0, F.array(F.xxhash64(words)))
            .otherwise(F.array().cast("array<bigint>")))


def sketch(shingles: Column, fraction: int = FRACTION) -> Column:
    """Distinct hashes in the lowest 1/``fraction`` of the range, and the smallest one."""
    limit = _LOWEST + (1 << 64) // fraction
    kept = F.filter(shingles, lambda h: h < F.lit(limit))
    least = F.filter(F.array(F.array_min(shingles)), lambda h: h.isNotNull())
    return F.array_sort(F.array_distinct(F.concat(least, kept)))


def with_sketch(df: DataFrame, text: Column, name: str) -> DataFrame:
    """``df`` with the sketch of ``text``; each step is a column of its own, read once per element."""
    return (df.withColumn(f"{name}_words", word_hashes(text))
            .withColumn(f"{name}_shingles", shingle_hashes(F.col(f"{name}_words")))
            .withColumn(name, sketch(F.col(f"{name}_shingles")))
            .drop(f"{name}_words", f"{name}_shingles"))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two sketches; two empty ones are alike."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b holds; an empty one is held by all."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def as_text(s: Column) -> Column:
    """Sixteen hex digits a hash, in order: equal texts have equal fingerprints."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def merged(sketches: DataFrame, key: str, column: str) -> DataFrame:
    """(key, sketch) of the union of the documents of each key, from their sketches alone.

    Hashes are made distinct before they meet.  The smallest hash of a document
    above the fraction stays only if it is the smallest of the union.
    """
    limit = _LOWEST + (1 << 64) // FRACTION
    hashes = sketches.select(key, F.explode(column).alias("h")).distinct()
    least = hashes.groupBy(key).agg(F.min("h").alias("least"))
    return (hashes.join(least, key).where((F.col("h") < limit) | (F.col("h") == F.col("least")))
            .groupBy(key).agg(F.array_sort(F.collect_list("h")).alias(column)))


def with_next(docs: DataFrame, carried: list[str], made: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Rows of (id, text, ...) with ``next_<c>`` of the row that follows by id.

    The last row is followed by the first.  Equal ids are ordered by text, null
    ids come last.  ``made`` adds columns to the rows after their shuffle.
    """
    rows, lowest = docs.agg(F.count(F.lit(1)), F.min("id")).first()
    ranges = max(1, min(MOST_RANGES, rows // RANGE_ROWS, max(FEW_RANGES, rows // LARGE_RANGE)))
    shares = [i / ranges for i in range(1, ranges)]
    found = docs.agg(F.percentile_approx("id", shares, max(10_000, 4 * ranges))).first()[0] if shares else None
    splits = sorted(set(found or []))
    # One literal array, searched by halving: at most MOST_RANGES numbers, whatever the table.
    cuts = F.from_json(F.lit(json.dumps(splits)), "array<bigint>")
    steps = [1 << i for i in reversed(range(len(splits).bit_length()))] or [1]

    def at(id_: Column) -> Column:
        return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda held, step: F.when(
            F.get(cuts, held + step - 1) <= id_, held + step).otherwise(held))

    own = F.when(F.col("id").isNull(), F.lit(len(splits))).otherwise(at(F.col("id")))
    ranged = docs.withColumn("own", own)
    starts = F.col("id").eqNullSafe(F.get(cuts, F.col("own") - 1)) & (F.col("own") > 0)
    wraps = F.col("id").eqNullSafe(F.lit(lowest).cast("long"))
    copies = F.filter(F.array(
        F.struct(F.col("own").alias("range"), F.lit(0).alias("copy")),
        F.when(starts, F.struct((F.col("own") - 1).alias("range"), F.lit(1).alias("copy"))),
        F.when(wraps, F.struct(F.lit(len(splits)).alias("range"), F.lit(2).alias("copy")))), lambda x: x.isNotNull())
    dealt = ranged.withColumn("to", F.explode(copies)).select(*docs.columns, "to.range", "to.copy")
    order = (Window.partitionBy("range")
             .orderBy("copy", F.col("id").asc_nulls_last(), F.xxhash64("text"), "text"))
    return (made(dealt.repartition("range")).withColumns({f"next_{c}": F.lead(c).over(order) for c in carried})
            .where("copy = 0").drop("range", "copy"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text's last floor(n_chars / 2) code points are the first as many
    (or all) of the next document by id.  Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and
    contained_next (share of the shingles that the next document holds).

    Null texts are empty; empty texts have an empty fingerprint, alike to other
    empty ones only.  A single document follows itself.  Equal ids are ordered
    by text, null ids come last.  Other columns are not read.  A text of any
    length is read whole; an empty table gives an empty table.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    paired = with_next(base, ["text", "sketch"], lambda df: with_sketch(df, F.col("text"), "sketch"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half),
                      F.substring(F.col("next_text"), F.lit(1), half))
    full = with_sketch(paired.withColumn("edited", edited), F.col("edited"), "edited_sketch")
    return full.select(
        F.col("id").alias("doc_id"), n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("contained_next"))
