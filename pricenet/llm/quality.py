"""Quality classifier by compression: a text that a dictionary of good documents
compresses better than one of bad documents reads like the good ones.

Two zstandard dictionaries are built, of labelled good and labelled bad text.
Each holds an even share of all its documents, in pieces from all over each
text, so rare kinds of text and what stands late in them are in it as well.  A text is compressed in independent blocks with each, so long texts
cannot outgrow their dictionary.  The difference of the two sizes per byte is
calibrated into a probability by logistic regression.  A term for shortness and
its product with the difference let the calibration trust the coarse
differences of short texts less.

The calibration learns from every labelled row of the sample: the rows are cut
into ``FOLDS`` parts, and each part is compressed with dictionaries of the
other parts only.  The dictionaries that score hold all parts.

Labels are learned from a bounded sample (``PER_CLASS`` rows of each class, in
the order of a hash of their id; of a text over ``FIT_CHARS`` characters, as many
from twenty places in it).  Scores read whole texts of any length, and nothing
but the text.  An empty table of documents gives an empty table.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import id_and_text

# Bounds of the labelled sample: rows of each class, characters of each row.
PER_CLASS = 2500
FIT_CHARS = 20_000
# Parts of the sample that are calibrated on dictionaries of the others.
FOLDS = 5
DICTIONARY_BYTES = 2_097_152
BLOCK = 1024
# Pieces of a text that stand for it in a dictionary.
PIECE = 256
LEVEL = 7
THRESHOLD = 0.7
SHORT_BYTES = 64.0


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document are kept from learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def blocks(text: bytes) -> list[bytes]:
    return [text[i:i + BLOCK] for i in range(0, len(text), BLOCK)]


def spread(text: bytes, share: int) -> bytes:
    """``share`` bytes of a text, in pieces at even distances over all of it."""
    if share >= len(text):
        return text
    n = max(1, share // PIECE)
    size = share // n
    return b"".join(text[at:at + size] for at in (k * (len(text) - size) // max(1, n - 1) for k in range(n)))


def build_dictionary(texts: list[bytes]) -> bytes:
    """An even share of every text, up to one length that lets them fill the dictionary."""
    left, share = DICTIONARY_BYTES, 0
    for waiting, length in zip(range(len(texts), 0, -1), sorted(map(len, texts))):
        share = min(length, left // waiting)
        left -= share
    return b"".join(spread(t, share) for t in texts)


@dataclass
class Model:
    """Dictionaries and calibration: plain values of bounded size, safe to broadcast."""
    good: bytes
    bad: bytes
    weights: tuple[float, ...]

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        made = []
        for content in (self.good, self.bad):
            options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
            if content:
                shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                shared.precompute_compress(level=LEVEL)
                options["dict_data"] = shared
            made.append(zstandard.ZstdCompressor(**options))
        return made[0], made[1]


def dictionaries(by: dict[int, list[bytes]]) -> Model:
    """Dictionaries of the texts of each label, not calibrated yet."""
    return Model(build_dictionary(by[1]), build_dictionary(by[0]), ())


def features(text: bytes, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> tuple[float, ...]:
    """Compressed-size difference in bytes of a hundred, shortness (1: empty), their product."""
    parts = blocks(text)
    difference = sum(map(len, map(bad.compress, parts))) - sum(map(len, map(good.compress, parts)))
    share, short = 100 * difference / max(1, len(text)), SHORT_BYTES / (SHORT_BYTES + len(text))
    return share, short, share * short


def calibrate(rows: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Weighted ridge logistic regression by Newton steps; the intercept comes last."""
    x = np.column_stack([rows, np.ones(len(rows))])
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-2] * rows.shape[1] + [1e-3])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + ridge,
                               x.T @ (weight * (labels - p)) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(map(float, w))


def logistic(row: tuple[float, ...], weights: tuple[float, ...]) -> float:
    z = sum(a * b for a, b in zip(row, weights)) + weights[-1]
    return 1 / (1 + math.exp(-min(30.0, max(-30.0, z))))


def usable_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(doc_id, label) to learn from; contradictory labels of a document teach nothing."""
    return (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
           .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
           .where("label = other").select("doc_id", "label"))


def labelled_sample(docs: DataFrame, one: DataFrame, id_col: str, text_col: str) -> list:
    """(doc_id, text, label) of the learning rows in a fixed mixed order; bounded, so it may be collected."""
    place = F.xxhash64("doc_id")
    # A longer text is learned from by twenty pieces at even distances.
    size = FIT_CHARS // 20
    pieces = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda k: F.substring(
        "text", (1 + F.floor(k * (F.length("text") - size) / 19)).cast("int"), F.lit(size)))
    whole = F.when(F.length("text") <= FIT_CHARS, F.col("text")).otherwise(F.array_join(pieces, ""))
    texts = id_and_text(docs, id_col, text_col).where(F.length("text") > 0).withColumn("text", whole)
    # Twice the rows, as some labels have no document.
    chosen = [one.where(F.col("label") == k).orderBy(place, "doc_id").limit(2 * PER_CLASS) for k in (0, 1)]
    found = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), F.col("id") == F.col("doc_id"))
    rows = [found.where(F.col("label") == k).groupBy("doc_id", "label").agg(F.min("text").alias("text"))
            .orderBy(place, "doc_id").limit(PER_CLASS) for k in (0, 1)]
    return sorted(rows[0].unionByName(rows[1]).select("doc_id", "text", "label").collect(),
                  key=lambda r: (zlib.crc32(b"fit %d" % r.doc_id), r.doc_id))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> Model:
    """Learn from the labels that are not held out.

    With labels of one class or none, the dictionaries are equal or empty and
    every score is the smoothed share of good labels.
    """
    usable = usable_labels(labels, id_col, label_col)
    total = {r.label: r.n for r in usable.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = labelled_sample(docs, usable, id_col, text_col)
    by = {k: [r.text.encode() for r in sample if r.label == k] for k in (0, 1)}
    if not by[0] or not by[1]:
        share = (len(by[1]) + 1) / (len(sample) + 2)
        return Model(b"", b"", (0.0, 0.0, 0.0, math.log(share / (1 - share))))
    rows, y = [], []
    for part in range(FOLDS):
        # A class too small to spare a part stays whole.
        model = dictionaries({k: [t for i, t in enumerate(by[k]) if i % FOLDS != part] or by[k] for k in by})
        good, bad = model.compressors()
        for k in by:
            rows += [features(t, good, bad) for t in by[k][part::FOLDS]]
            y += [k] * len(by[k][part::FOLDS])
    model = dictionaries(by)
    share = {k: total[k] / sum(total.values()) * len(y) / len(by[k]) for k in by}
    model.weights = calibrate(np.array(rows), np.array(y, dtype=float), np.array([share[k] for k in y]))
    return model


_READY: dict[int, tuple] = {}


def _scorer(shared: Broadcast):
    """Scores of a column of texts; compressors are built once per Python worker."""
    def score(texts: pa.Array) -> list[float]:
        model = shared.value
        key = hash((model.good, model.bad))
        if key not in _READY:
            _READY[key] = model.compressors()
        good, bad = _READY[key]
        return [logistic(features(t or b"", good, bad), model.weights) for t in texts.cast(pa.binary()).to_pylist()]
    return score


RESULT = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted of every document.

    Null and empty texts have no difference and get the score of the shortest
    text.  A null id is held out by no label (held_out false).  Repeated rows
    give repeated results; other columns are not read.
    """
    score = _scorer(docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score(batch.column(1)), pa.float64())], schema=RESULT)

    scored = id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, with all their columns."""
    score = _scorer(docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col)))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([s >= threshold for s in score(batch.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
