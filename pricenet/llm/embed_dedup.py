"""Embedding near-duplicates by int8 tile products with rigorous error bounds.

Equal vectors are one node.  Each node's unit vector ``u`` is quantised to
``s * q`` with int8 codes ``q``; the norm ``e`` of what that leaves over is
known, so for two nodes

    |u . v  -  s_u s_v (q_u . q_v)|  <=  e_u + e_v + 3 e_u e_v.

Nodes are packed into blocks of bounded size, which hold codes, scales and
errors only, and every two blocks are one tile: code products (whole numbers,
exact in single precision up to ``EXACT_DIM`` components at a time) decide all
pairs that the bound decides.  Pairs whose bound straddles the threshold leave
the tile as one bit each; the full vectors of their nodes alone are fetched and
decide them in double precision.

A tile returns counts and a spanning set of its links, at most one row a node,
never the pairs: a group of near copies of any size costs its nodes, not its
square.  Vectors are compared with all others, so the work is quadratic in the
number of distinct vectors; it spreads evenly over the tiles.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .components import connected_components

THRESHOLD = 0.9
# Nodes of a block, rows of a product at a time, components whose products sum exactly in float32.
BLOCK = 4096
ROWS = 512
EXACT_DIM = 1040
MOST_PARTITIONS = 20_000
# A node's key: its place in the low bits (a block is some 4,096 nodes, dealt by hash), its block, its lane.
PLACE, LANE = 13, 45


def unit(full: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so no square overflows."""
    x = full.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def quantised(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales and norms of the error (rounded up)."""
    scale = np.abs(u).max(axis=1) / 127.0
    codes = np.rint(u / scale[:, None])
    error = np.sqrt(np.square(u - codes * scale[:, None]).sum(axis=1)) * (1 + 1e-9) + 1e-12
    return codes.astype(np.int8), scale, error


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """q_u . q_v of all rows, exact: float32 sums of whole numbers below 2^24, added in double beyond."""
    if a.shape[1] <= EXACT_DIM:
        return a.astype(np.float32) @ b.astype(np.float32).T
    parts = range(0, a.shape[1], EXACT_DIM)
    return sum((a[:, i:i + EXACT_DIM].astype(np.float32) @ b[:, i:i + EXACT_DIM].astype(np.float32).T).astype(np.float64)
               for i in parts)


class Block:
    """Nodes of one block in the order of their places, unpacked."""

    def __init__(self, table: pa.Table, row: int) -> None:
        packed = {c: table[c][row].as_py() for c in ("dim", "block", "codes", "scale", "error", "copies")}
        self.block = packed["block"]
        self.codes = np.frombuffer(packed["codes"], dtype=np.int8).reshape(-1, packed["dim"])
        self.scale, self.error = (np.frombuffer(packed[c], dtype="<f8") for c in ("scale", "error"))
        self.copies = np.frombuffer(packed["copies"], dtype="<i8")


def compared(a: Block, b: Block, rows: slice, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b, sure) of a slice of a's rows with all of b: sure links, and those in doubt."""
    g = code_products(a.codes[rows], b.codes)
    scale, error = a.scale[rows], a.error[rows]
    # The loosest bound any column could have: leaves few pairs to look at one by one.
    most = b.error.max()
    least = threshold - error - most - 3 * error * most - 1e-9
    least /= scale * np.where(least > 0, b.scale.max(), b.scale.min())
    i, j = np.nonzero(g >= (least - 1e-6 * np.abs(least))[:, None].astype(g.dtype))
    near = g[i, j].astype(np.float64) * scale[i] * b.scale[j]
    bound = error[i] + b.error[j] + 3 * error[i] * b.error[j] + 1e-12
    sure, possible = near - bound >= threshold, near + bound >= threshold
    return i[possible] + rows.start, j[possible], sure[possible]


def spanning(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes over links (i, j)."""
    label = np.arange(n)
    ends, others = np.concatenate([i, j]), np.concatenate([j, i])
    order = np.argsort(ends, kind="stable")
    ends, others = ends[order], others[order]
    starts = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]])
    heads = ends[starts]
    while True:
        least = np.minimum.reduceat(label[others], starts)
        new = label.copy()
        new[heads] = np.minimum(new[heads], least)
        # Follow pointers, so chains shorten by halves.
        new = np.minimum(new, new[new])
        if np.array_equal(new, label):
            return label
        label = new


class Links:
    """Links of a tile: their number at each of its nodes and a spanning set of them."""

    def __init__(self, at: np.ndarray, copies: np.ndarray) -> None:
        self.at, self.copies = at, copies
        self.count, self.root = np.zeros(len(at), dtype=np.int64), np.arange(len(at))

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        if not len(i):
            return
        for x, y in ((i, j), (j, i)):
            self.count += np.bincount(x, weights=self.copies[y], minlength=len(self.at)).astype(np.int64)
        old = np.flatnonzero(self.root != np.arange(len(self.at)))
        self.root = spanning(np.concatenate([i, old]), np.concatenate([j, self.root[old]]), len(self.at))

    def columns(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(node, links, root) of the nodes that have any."""
        some = np.flatnonzero(self.count)
        return self.at[some], self.count[some], self.at[self.root[some]]


def _tile(threshold: float):
    """Rows (node, links, root) of the sure links of a tile; (node, tile) of every node with a doubtful pair; and the
    tile's doubtful pairs, one bit a pair."""
    def run(table: pa.Table) -> pa.Table:
        both = sorted((Block(table, k) for k in range(table.num_rows)), key=lambda x: x.block)
        a, b = both[0], both[-1]
        base = table["lane"][0].as_py() << LANE
        places = [base + (x.block << PLACE) + np.arange(len(x.copies)) for x in both]
        found = Links(np.concatenate(places), np.concatenate([x.copies for x in both]))
        shift = 0 if a is b else len(a.copies)
        doubt = np.zeros((len(a.copies), len(b.copies)), dtype=bool)
        for start in range(0, len(a.copies), ROWS):
            i, j, sure = compared(a, b, slice(start, min(start + ROWS, len(a.copies))), threshold)
            if a is b:
                once = i < j
                i, j, sure = i[once], j[once], sure[once]
            found.add(i[sure], j[sure] + shift)
            doubt[i[~sure], j[~sure]] = True
        at, links, root = found.columns()
        open_ = np.concatenate([doubt.any(axis=1), doubt.any(axis=0)]) if shift else doubt.any(axis=1) | doubt.any(axis=0)
        wanted = found.at[open_]
        n, m = len(at), len(wanted)
        bits = [zlib.compress(np.packbits(doubt, axis=1).tobytes(), 1)] if m else []
        tile = {c: pa.array([None] * n + [table[c][0].as_py()] * (m + len(bits)), kind)
                for c, kind in (("lane", pa.int32()), ("i", pa.int32()), ("j", pa.int32()))}
        return pa.table({
            "at": pa.concat_arrays([pa.array(at, pa.int64()), pa.array(wanted, pa.int64()), pa.nulls(len(bits), pa.int64())]),
            "links": pa.concat_arrays([pa.array(links, pa.int64()), pa.nulls(m + len(bits), pa.int64())]),
            "root": pa.concat_arrays([pa.array(root, pa.int64()), pa.nulls(m + len(bits), pa.int64())]), **tile,
            "wide": pa.array([None] * (n + m) + [len(b.copies)] * len(bits), pa.int32()),
            "doubt": pa.array([None] * (n + m) + bits, pa.binary())})
    return run


def _again(kind: str, threshold: float):
    """(node, links, root) of the links among a tile's doubtful pairs, from the full vectors."""
    def run(doubts: pa.Table, vectors: pa.Table) -> pa.Table:
        wide, (i_block, j_block) = doubts["wide"][0].as_py(), (doubts[c][0].as_py() for c in "ij")
        packed = np.frombuffer(zlib.decompress(doubts["doubt"][0].as_py()), dtype=np.uint8).reshape(-1, -(-wide // 8))
        at = vectors["at"].to_numpy()
        block, place = at >> PLACE & (1 << LANE - PLACE) - 1, at & (1 << PLACE) - 1
        full = np.frombuffer(b"".join(vectors["full"].to_pylist()), dtype=kind).reshape(len(at), -1)
        units, found = unit(full), Links(at, vectors["copies"].to_numpy())
        # Where a place of either block is among the vectors.
        rows, columns = np.full(len(packed), -1), np.full(wide, -1)
        rows[place[block == i_block]] = np.flatnonzero(block == i_block)
        columns[place[block == j_block]] = np.flatnonzero(block == j_block)
        for start in range(0, len(packed), ROWS):
            i, j = np.nonzero(np.unpackbits(packed[start:start + ROWS], axis=1, count=wide))
            i, j = rows[i + start], columns[j]
            links = np.zeros(len(i), dtype=bool)
            for first in range(0, len(i), 50_000):
                part = slice(first, first + 50_000)
                links[part] = np.einsum("ij,ij->i", units[i[part]], units[j[part]]) >= threshold
            found.add(i[links], j[links])
        return pa.table(dict(zip(("at", "links", "root"), (pa.array(c, pa.int64()) for c in found.columns()), strict=True)))
    return run


def _keyed(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """(id, dim, node, full): the vector's bytes and their digest; null for vectors without direction."""
    for batch in batches:
        dims, nodes, fulls = [], [], []
        for v in batch.column(1).to_pylist():
            x = None
            if v and None not in v:
                x = np.array(v, dtype=kind) + 0  # no negative zero
                x = x if np.isfinite(x).all() and x.any() else None
            content = None if x is None else x.tobytes()
            dims.append(0 if x is None else len(x))
            nodes.append(content and hashlib.blake2b(content, digest_size=16).digest())
            fulls.append(content)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims, pa.int32()), pa.array(nodes, pa.binary()),
                                          pa.array(fulls, pa.binary())], ["id", "dim", "node", "full"])


def _packer(kind: str):
    """One row from the nodes of a block: codes, scales and errors, made once."""
    def pack(table: pa.Table) -> pa.Table:
        t = table.sort_by("place")
        dim = t["dim"][0].as_py()
        codes, scale, error = quantised(unit(np.frombuffer(b"".join(t["full"].to_pylist()), dtype=kind).reshape(-1, dim)))
        return pa.table({
            "lane": t["lane"][:1].cast(pa.int32()), "block": t["block"][:1].cast(pa.int32()), "dim": pa.array([dim], pa.int32()),
            "codes": pa.array([codes.tobytes()], pa.binary()), "scale": pa.array([scale.astype("<f8").tobytes()], pa.binary()),
            "error": pa.array([error.astype("<f8").tobytes()], pa.binary()),
            "copies": pa.array([t["copies"].to_numpy().astype("<i8").tobytes()], pa.binary())})
    return pack


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept, a row per vector.

    ``n_links`` counts the other rows with cosine >= ``threshold``;
    ``component_id`` is the smallest id that links reach, itself included.

    Null and empty vectors, zero vectors and those with a null or non-finite
    component link with nothing: 0 links, their own id.  Vectors of different
    length never link.  Repeated rows count as vectors of their own and link
    with each other; a null id joins its group and is kept only in one without
    other ids.  Other columns are not read.  An empty table gives an empty table.
    """
    element = vectors.schema[vector_col].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    typed = vectors.select(F.col(id_col).cast("long").alias("id"),
                           F.col(vector_col).cast("array<float>" if kind == "<f4" else "array<double>").alias("v"))
    rows = cut_lineage(typed.mapInArrow(partial(_keyed, kind=kind), "id long, dim int, node binary, full binary"))
    some = rows.where("node is not null")
    nodes = cut_lineage(some.groupBy("node", "dim").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"),
                                                        F.first("full").alias("full")))
    # Blocks of even size: a hash of the digest deals the nodes of each length, which is a lane of its own.
    counts = sorted((r.dim, -(-r.n // BLOCK)) for r in nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect())
    if not counts:
        return _finished(rows, rows.select("node", F.col("id").alias("component_id"), F.lit(0).alias("links"),
                                           F.lit(1).alias("copies")).limit(0))
    lanes = nodes.sparkSession.createDataFrame([(k, *c) for k, c in enumerate(counts)], "lane int, dim int, many int")
    inside = Window.partitionBy("lane", "block").orderBy("node")
    placed = cut_lineage(
        nodes.join(lanes, "dim").withColumn("block", F.pmod(F.xxhash64("node"), "many").cast("int"))
        .withColumn("place", F.row_number().over(inside) - 1)
        .withColumn("at", F.shiftleft(F.col("lane").cast("long"), LANE) + F.shiftleft(F.col("block").cast("long"), PLACE)
                    + F.col("place")))
    blocks = cut_lineage(
        placed.select("lane", "block", "place", "dim", "copies", "full").groupBy("lane", "block").applyInArrow(
            _packer(kind), "lane int, block int, dim int, codes binary, scale binary, error binary, copies binary"))

    # Each block goes to the tiles it is part of, which hold its codes and one other's.
    tile = ["lane", "i", "j"]
    n_tiles = min(sum(m * (m + 1) // 2 for _, m in counts), MOST_PARTITIONS)
    dealt = (blocks.join(lanes.select("lane", "many"), "lane")
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("many") - 1))).drop("many")
             .withColumns({"i": F.least("block", "with"), "j": F.greatest("block", "with")}).drop("with"))
    met = cut_lineage(dealt.repartition(n_tiles, *tile).groupBy(*tile).applyInArrow(
        _tile(threshold), "at long, links long, root long, lane int, i int, j int, wide int, doubt binary"))
    own = [f"of_{c}" for c in tile]
    wanted = (met.where("at is not null and links is null").select(*[F.col(c).alias(o) for c, o in zip(tile, own)], "at")
              .join(placed.select("at", "copies", "full"), "at"))
    doubts = met.where("doubt is not null").select(*tile, "wide", "doubt")
    again = cut_lineage(doubts.groupBy(*tile).cogroup(wanted.groupBy(*own)).applyInArrow(
        _again(kind, threshold), "at long, links long, root long"))
    met = met.where("links is not null").select("at", "links", "root").unionByName(again)

    links = met.groupBy("at").agg(F.sum("links").alias("links"))
    components = cut_lineage(connected_components(met.where("at != root"), "at", "root").withColumnRenamed("node", "at"))
    smallest = cut_lineage(components.join(placed.select("at", "id"), "at")
                           .groupBy("component").agg(F.min("id").alias("component_id")))
    joined = components.join(smallest, "component").select("at", "component_id")
    known = cut_lineage(placed.select("node", "at", "id", "copies").join(joined, "at", "left").join(links, "at", "left")
                        .select("node", F.coalesce("component_id", "id").alias("component_id"),
                                F.coalesce("links", F.lit(0)).alias("links"), "copies"))
    return _finished(rows, known)


def _finished(rows: DataFrame, known: DataFrame) -> DataFrame:
    told = (rows.where("node is not null").join(known, "node")
            .select("id", (F.col("links") + F.col("copies") - 1).cast("long").alias("n_links"), "component_id"))
    alone = rows.where("node is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return told.unionByName(alone).select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
