"""MinHash near-duplicates by an LSH forest.

Each text is the set of its distinct word shingles; equal sets are one node.
A node's MinHash signature is read in several orders (the trees: rotations of
it).  Nodes are sorted by each order, and those that share the first ``DEPTH``
values are a region.  In a small region all members are candidates of each
other.  A larger region is descended further: there a node's candidate is its
neighbour in the sort, with which it shares the longest prefix.

Candidates whose sizes or signatures rule the similarity out are dropped, the
rest is confirmed on the full sets, and links are joined to components.
Larger regions (and those cut by a partition's edge) are then finished
exactly: members outside the component that holds most of the region are
compared with all its members, block by block.  A block pair is one matrix
product over the shingles that occur twice in it, and returns a spanning set
of its links, never the pairs.  So within a region every two nodes have been
compared or were already connected, whatever its size.

The number of trees and the signature filter follow from the similarity: a pair
at the threshold shares no region, or is dropped by its signatures, with a
probability of at most ``MISS``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ..session import cut_lineage
from .columns import id_and_text, runs_of
from .components import connected_components

DEPTH = 4
MISS = 2e-6
# Members of a region that are all compared at once.
SMALL = 8
# Members of a block of a larger region, and shingles of a matrix product at a time.
BLOCK = 256
COLUMNS = 8192
# Words whose hashes a worker holds, their longest in bytes, and shingles that are hashed at a time.
HELD = 200_000
HELD_BYTES = 64
STEP = 4096

_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def trees_for(similarity: float) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - similarity ** DEPTH))


def agreements_for(percent: int, size: int) -> int:
    """Fewest equal values of two signatures that let a pair pass.

    A pair at the threshold agrees in a binomial number of ``size`` values; it
    has fewer with a probability of at most what the trees leave of ``MISS``.
    """
    t = percent / 100
    spare = MISS - (1 - t ** DEPTH) ** trees_for(t)
    below = 0.0
    for least in range(size + 1):
        below += math.comb(size, least) * t ** least * (1 - t) ** (size - least)
        if below > spare:
            return least
    return size


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of distinct ``k``-word shingles, as sorted 64-bit hashes."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.held: dict[bytes, int] = {}

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        distinct = set(words)
        long = {w: xxhash.xxh64_intdigest(w) for w in distinct if len(w) > HELD_BYTES}
        missing = distinct - self.held.keys() - long.keys()
        if len(self.held) + len(missing) > HELD:
            self.held = {w: self.held[w] for w in distinct & self.held.keys()}
        self.held.update((w, xxhash.xxh64_intdigest(w)) for w in missing)
        known = {w: self.held[w] for w in distinct - long.keys()} | long if long else self.held
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))

    def combined(self, h: np.ndarray, k: int) -> np.ndarray:
        n = len(h) - k + 1
        total = np.full(n, np.uint64(k), dtype=np.uint64)
        for j in range(k):
            total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n])
        return total

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """One sorted array a text; a text of fewer than ``k`` words is one shingle, an empty one none."""
        cut = [t.translate(_LOWER).split() for t in texts]
        h = self.word_hashes([w for c in cut for w in c])
        out, at = [], 0
        for c in cut:
            n = len(c)
            out.append(np.unique(self.combined(h[at:at + n], min(self.k, n))) if n else np.empty(0, dtype=np.uint64))
            at += n
        return out


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


class MinHash:
    """Signatures of ``size`` 32-bit values."""

    def __init__(self, size: int) -> None:
        seeds = np.arange(1, size + 1, dtype=np.uint64)
        self.factors = _mixed(seeds * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
        self.shifts = _mixed(seeds * np.uint64(0xA0761D6478BD642F))

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        best = np.full(len(self.factors), np.iinfo(np.uint64).max, dtype=np.uint64)
        for i in range(0, len(shingles), STEP):
            part = shingles[i:i + STEP, None] * self.factors
            part += self.shifts
            np.minimum(best, part.min(axis=0), out=best)
        return (best >> np.uint64(32)).astype(">u4")


def _texts(batches: Iterator[pa.RecordBatch], shingler: Shingler) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(ids, sets) in parts of bounded size."""
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
        for start, end in runs_of(texts):
            yield ids[start:end], shingler.sets(texts[start:end])


def _signed(batches: Iterator[pa.RecordBatch], k: int, size: int) -> Iterator[pa.RecordBatch]:
    shingler, minhash = Shingler(k), MinHash(size)
    for ids, sets in _texts(batches, shingler):
        yield pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
            pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
            pa.array([minhash(s).tobytes() if len(s) else None for s in sets], pa.binary())],
            ["id", "n", "node", "sig"])


def signatures(docs: DataFrame, k: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """(id, n, node, sig) of every row: set size, digest of the set, signature (null: no words)."""
    return id_and_text(docs, id_col, text_col).mapInArrow(
        partial(_signed, k=k, size=DEPTH * trees_for(similarity)), "id long, n long, node binary, sig binary")


def _planted(batches: Iterator[pa.RecordBatch], trees: int) -> Iterator[pa.RecordBatch]:
    """A row a tree: the first ``DEPTH`` values of its order, four bytes each, and the next ones shortened."""
    for batch in batches:
        nodes, sigs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        if not nodes:
            continue
        values = np.frombuffer(b"".join(sigs), dtype=">u4").reshape(len(nodes), -1)
        for t in range(trees):
            turned = np.roll(values, -DEPTH * t, axis=1)
            head = np.ascontiguousarray(turned[:, :DEPTH]).view(np.uint8).reshape(len(nodes), -1)
            tail = (turned[:, DEPTH:3 * DEPTH] >> 24).astype(np.uint8)
            heads, tails = head.tobytes(), tail.tobytes()
            w, v = 4 * DEPTH, tail.shape[1]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(nodes), t, dtype=np.int32)),
                pa.array([heads[i * w:(i + 1) * w] for i in range(len(nodes))], pa.binary()),
                pa.array([tails[i * v:(i + 1) * v] for i in range(len(nodes))], pa.binary()),
                pa.array(nodes, pa.binary())], ["tree", "region", "rest", "node"])


def forest(nodes: DataFrame, trees: int) -> DataFrame:
    return nodes.select("node", "sig").mapInArrow(
        partial(_planted, trees=trees), "tree int, region binary, rest binary, node binary")


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates from sorted rows: (a, b, null, null), and (null, null, tree, region) of regions to finish."""
    here, members, first_region = None, 0, True
    held: list[bytes] = []
    a: list[bytes | None] = []
    b: list[bytes | None] = []
    tree: list[int | None] = []
    region: list[bytes | None] = []

    def unfinished() -> None:
        a.append(None)
        b.append(None)
        tree.append(here[0])
        region.append(here[1])

    def batch() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()),
                                          pa.array(tree, pa.int32()), pa.array(region, pa.binary())],
                                         ["a", "b", "tree", "region"])
        for column in (a, b, tree, region):
            column.clear()
        return out

    for rows in batches:
        for t, r, node in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), rows.column(3).to_pylist()):
            if (t, r) != here:
                if here and (members > SMALL or first_region):
                    unfinished()
                first_region = here is None
                here, members, held = (t, r), 0, []
            for other in held if members < SMALL else held[-1:]:
                a.append(min(node, other))
                b.append(max(node, other))
                tree.append(None)
                region.append(None)
            members += 1
            held = [*held[-SMALL:], node]
        yield batch()
    if here:
        unfinished()
    yield batch()


def _likely(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose sizes and signatures allow the similarity."""
    for batch in batches:
        if not batch.num_rows:
            continue
        na, nb = batch.column(2).to_numpy(), batch.column(4).to_numpy()
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u4").reshape(len(na), -1) for c in (3, 5))
        keep = ((x == y).sum(axis=1) >= agreements_for(percent, x.shape[1])) \
            & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
        yield batch.select([0, 1]).filter(pa.array(keep))


def likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    sized = nodes.select("node", "n", "sig")
    joined = (pairs.join(sized.toDF("a", "na", "sa"), "a").join(sized.toDF("b", "nb", "sb"), "b")
              .select("a", "b", "na", "sa", "nb", "sb"))
    return joined.mapInArrow(partial(_likely, percent=percent), "a binary, b binary")


def _digested(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    shingler = Shingler(k)
    for batch in batches:
        texts = batch.column(0).cast(pa.binary()).to_pylist()
        for start, end in runs_of(texts):
            part = texts[start:end]
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest(s) for s in shingler.sets(part)], pa.binary()), pa.array(part, pa.binary())],
                ["node", "text"])


def _confirmed(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs that reach the similarity on their full sets."""
    shingler = Shingler(k)
    for batch in batches:
        xs, ys = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        keep = []
        for start, end in runs_of(xs, 500_000):
            for x, y in zip(shingler.sets(xs[start:end]), shingler.sets(ys[start:end]), strict=True):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def texts_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(node, text) of the wanted nodes, written; a node's text is that of its smallest id, or of a row without one."""
    known = cut_lineage(wanted.distinct().join(nodes.select("node", "id"), "node"))
    rows = docs.join(known.where("id is not null").select("id").distinct(), "id").select("text")
    if known.where("id is null").limit(1).count():
        rows = rows.unionByName(docs.where("id is null").select("text"))
    found = rows.mapInArrow(partial(_digested, k=k), "node binary, text binary")
    # An id that repeats with other texts brings nodes nobody asked for; a repeated row, one twice.
    return cut_lineage(found.join(known.select("node"), "node", "left_semi").dropDuplicates(["node"]))


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs that are links on their full sets."""
    pairs = cut_lineage(pairs)
    texts = texts_of(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))),
                     nodes, docs, k)
    joined = (pairs.join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b").select("a", "b", "x", "y"))
    return cut_lineage(joined.mapInArrow(partial(_confirmed, k=k, percent=percent), "a binary, b binary"))


def overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Shared shingles of every set of ``x`` with every set of ``y``: products of 0/1 matrices.

    Only shingles that occur in two of the sets have a column; sums below 2^24
    are exact in single precision.
    """
    sets = [*x, *y]
    every = np.concatenate(sets)
    names, at, times = np.unique(every, return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    keep = times[at] > 1
    rows, columns = rows[keep], column[at[keep]]
    total = np.zeros((len(x), len(y)), dtype=np.float32)
    for start in range(0, int((times > 1).sum()), COLUMNS):
        here = (columns >= start) & (columns < start + COLUMNS)
        m = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        m[rows[here], columns[here] - start] = 1
        total += m[:len(x)] @ m[len(x):].T
    return total.astype(np.int64)


def roots(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest index that links (i, j) reach from each of ``n`` nodes."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _tile(k: int, percent: int):
    """(node, root) of the links between two blocks of a region, or within one."""
    def run(table: pa.Table) -> pa.Table:
        t = table.sort_by("node")
        own = np.array(t["block"].to_pylist()) == t["a"][0].as_py()
        nodes = t["node"].to_pylist()
        sets = Shingler(k).sets(t["text"].to_pylist())
        left = np.flatnonzero(own)
        right = left if t["a"][0].as_py() == t["b"][0].as_py() else np.flatnonzero(~own)
        shared = overlaps([sets[q] for q in left], [sets[q] for q in right]) if len(left) and len(right) else np.zeros((0, 0))
        size = np.array([len(s) for s in sets], dtype=np.int64)
        if shared.size:
            i, j = np.nonzero(100 * shared >= percent * (size[left][:, None] + size[right][None, :] - shared))
            root = roots(left[i], right[j], len(nodes))
        else:
            root = np.arange(len(nodes))
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.table({"a": pa.array([nodes[q] for q in moved], pa.binary()),
                         "b": pa.array([nodes[q] for q in root[moved]], pa.binary())})
    return run


def finished(regions: DataFrame, planted: DataFrame, components: DataFrame, nodes: DataFrame, docs: DataFrame,
             k: int, percent: int) -> DataFrame:
    """Links that connect all that is linked within the regions the sort did not finish.

    In each region with several components, members outside the component with
    most members (its blocks come first) meet all members; two members of that
    component do not meet again.
    """
    key = ["tree", "region"]
    members = cut_lineage(planted.select(*key, "node").join(regions, key)
                          .join(components.withColumnRenamed("component", "known"), "node", "left")
                          .select(*key, "node", F.coalesce("known", "node").alias("component")))
    shares = members.groupBy(*key, "component").agg(F.count(F.lit(1)).alias("held"))
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    mixed = cut_lineage(
        shares.groupBy(*key).agg(F.max(F.struct("held", "component")).alias("most"), F.sum("held").alias("all"),
                                 F.count(F.lit(1)).alias("components"))
        .where("components > 1")
        .select(*key, F.col("most.component").alias("main"), blocks(F.col("all") - F.col("most.held")).alias("others"),
                blocks(F.col("most.held")).alias("mains")))
    marked = cut_lineage(members.join(mixed, key).withColumn("is_main", F.col("component") == F.col("main")))
    place = F.xxhash64("node", "tree")
    dealt = (marked.withColumn("block", F.when(F.col("is_main"), F.col("others") + F.pmod(place, "mains"))
                               .otherwise(F.pmod(place, "others")).cast("int"))
             .withColumn("with", F.explode(F.sequence(
                 F.lit(0), F.col("others") - 1 + F.when(F.col("is_main"), 0).otherwise(F.col("mains")))))
             .select(*key, F.least("block", "with").alias("a"), F.greatest("block", "with").alias("b"), "block", "node"))
    texts = texts_of(marked.select("node"), nodes, docs, k)
    return cut_lineage(dealt.join(texts, "node").groupBy(*key, "a", "b")
                       .applyInArrow(_tile(k, percent), "a binary, b binary").distinct())


def _grouped(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, n, node, sig), and (node, id, component_id, first) of every node.

    ``first`` marks one node of each component: one that has the component's id.
    """
    trees = trees_for(percent / 100)
    rows = cut_lineage(signatures(docs, k, percent / 100, id_col, text_col))
    some = rows.where("n > 0")
    nodes = cut_lineage(some.groupBy("node").agg(F.min("id").alias("id"), F.min("n").alias("n"), F.first("sig").alias("sig")))
    planted = forest(nodes, trees)
    found = cut_lineage(planted.repartitionByRange("tree", "region", "rest", "node")
                        .sortWithinPartitions("tree", "region", "rest", "node")
                        .mapInArrow(_neighbours, "a binary, b binary, tree int, region binary"))
    texts = id_and_text(docs, id_col, text_col)
    links = confirmed(likely(found.where("a is not null").select("a", "b").distinct(), nodes, percent),
                      nodes, texts, k, percent)
    components = cut_lineage(connected_components(links))
    regions = found.where("a is null").select("tree", "region").distinct()
    more = finished(regions, planted, components, nodes, texts, k, percent)
    if more.limit(1).count():
        components = cut_lineage(connected_components(links.unionByName(more)))

    smallest = cut_lineage(components.join(nodes.select("node", "id"), "node").groupBy("component")
                           .agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "node")).alias("least"))
                           .select("component", "least.id", "least.node").toDF("component", "linked_id", "least"))
    linked = components.join(smallest, "component").select("node", "linked_id", "least")
    assigned = cut_lineage(nodes.select("node", "id").join(linked, "node", "left")
                           .select("node", "id", F.when(F.col("least").isNull(), F.col("id"))
                                   .otherwise(F.col("linked_id")).alias("component_id"),
                                   F.coalesce(F.col("least") == F.col("node"), F.lit(True)).alias("first")))
    return rows, assigned


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id that links reach) and kept, a row per document.

    Two documents are linked when ``100 * |A & B| >= percent * |A | B|`` on their
    sets of distinct ``k``-word shingles (A-Z lower-cased, words split at ASCII
    white space, fewer than ``k`` words: one shingle).

    Null, empty and blank texts have no shingles and are linked with nothing:
    their component is their own id.  Equal sets are linked.  Repeated rows give
    repeated results; rows with one id and other texts count as documents of
    their own.  A null id joins its group and is kept only in a group without
    other ids.  Other columns are not read.  Texts of any length are read whole;
    an empty table gives an empty table.
    """
    rows, assigned = _grouped(docs, k, percent, id_col, text_col)
    return (rows.where("n > 0").join(assigned.select("node", "component_id"), "node").select("id", "n", "component_id")
            .unionByName(rows.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
                    F.col("id").eqNullSafe(F.col("component_id")).alias("kept")))


def _tagged(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, text, row) with the digest of the text's set (null: no words)."""
    shingler = Shingler(k)
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        found = [digest(s) if len(s) else None for start, end in runs_of(texts) for s in shingler.sets(texts[start:end])]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], ["id", "text", "row", "node"])


def keep_one(docs: DataFrame, id_col: str = "doc_id", k: int = 5, percent: int = 80,
             text_col: str = "text") -> DataFrame:
    """One row of ``docs``, with its own columns, of each group that :func:`near_duplicates` finds.

    It is a row of the group's smallest id; of several (a repeated row, or equal
    sets under one id or without one) the one with the smallest text.  A row
    whose id repeats with other texts is judged by its own text.  Rows without
    words are linked with nothing, so all of them stay.
    """
    rows, assigned = _grouped(docs, k, percent, id_col, text_col)
    own = F.col(id_col).cast("long")
    first = assigned.where("first").select(F.col("component_id").alias("id"), "node")
    repeated = cut_lineage(rows.where("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("times"))
                           .where("times > 1").select(F.col("id").alias("__id")))

    # Ids of a single row name it.
    single = cut_lineage(first.select("id").unionByName(rows.where("n = 0").select("id")).where("id is not null")
                         .distinct().select(F.col("id").alias("__id"))
                         .join(repeated, "__id", "left_anti"))
    kept = docs.join(single, own == F.col("__id"), "left_semi")

    # Other rows are found by id and set; equal ones are reduced to one before they meet the first of their group.
    others = docs.where(own.isNull()).unionByName(docs.join(repeated, own == F.col("__id"), "left_semi"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    tagged = cut_lineage(others.select(own.alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), row.alias("row"))
                         .mapInArrow(partial(_tagged, k=k), StructType([
                             StructField("id", LongType()), StructField("text", StringType()),
                             StructField("row", docs.schema), StructField("node", BinaryType())])))
    one = (tagged.where("node is not null").groupBy("id", "node")
           .agg(F.min_by("row", F.struct("text", F.xxhash64(F.to_json("row")))).alias("row")))
    chosen = first.toDF("first_id", "first_node")
    found = one.join(chosen, F.col("id").eqNullSafe(F.col("first_id")) & (F.col("node") == F.col("first_node")), "left_semi")
    return kept.unionByName(tagged.where("node is null").select("row.*")).unionByName(found.select("row.*"))
