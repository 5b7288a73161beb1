"""Periodic runs in word sequences by branching tandem repeats over an enhanced suffix array.

A run is a stretch of words with a period that cannot be extended.  Its last
square (two equal halves) is branching: one word further on, the halves differ.
In the suffix array, the halves of a branching square of period d start in two
different children of one LCP interval of depth d.  So for every interval the
suffixes of all children but the largest are tested: does the suffix d words
further on, or d words before, lie in the interval too (a lookup in the inverse
array)?  That is O(n log n) tests and needs no tree nodes: an interval is its
bounds and depth.  Each square found is rotated to the left as far as its
period holds, which gives the run; runs of one stretch are merged to the
smallest period.

The texts of a batch share one suffix array.  Words of different texts are
different symbols, so no common prefix reaches over a border, and prefix
doubling stops as soon as all suffixes differ.  Ranks of all doublings are
kept: they tell in a few steps how far two places agree, forwards (LCP) or
backwards (rotation).  A batch holds about ``PIECE_WORDS`` words, or one text;
memory is about 4 bytes x words x log2(longest repeat) beside the text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import id_and_text

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
PIECE_WORDS = 200_000

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def suffix_ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... symbols, until all differ.

    Equal ranks mean equal blocks.  A rank is the number of smaller suffixes; each
    array has one more entry, -1, for the place after the end.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ranks, groups = np.full(n + 1, -1, dtype=np.int64), symbols[order]
    levels, reach = [], 1
    while True:
        # ``order``: suffixes whose group has several members, by group; ``groups``: what tells groups apart.
        new = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(order) else np.empty(0, dtype=np.int64)
        sizes = np.diff(np.r_[new, len(order)])
        if levels:
            old = ranks[order]
            first = np.flatnonzero(np.r_[True, old[1:] != old[:-1]])
            slots = old + np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
        else:
            slots = np.arange(n)
        ranks = ranks.copy()
        ranks[order] = np.repeat(slots[new], sizes)
        levels.append(ranks.astype(np.int32))
        order = order[np.repeat(sizes > 1, sizes)]
        if not len(order):
            return levels
        keys = ranks[order] * (n + 1) + ranks[np.minimum(order + reach, n)] + 1
        sort = np.argsort(keys, kind="stable")
        order, groups = order[sort], keys[sort]
        reach *= 2


def common(levels: list[np.ndarray], x: np.ndarray, y: np.ndarray, backwards: bool = False) -> np.ndarray:
    """How many symbols agree from x and y on (before x and y, if backwards; x < y)."""
    n, same = len(levels[0]) - 1, np.zeros(len(x), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        block, ranks = 1 << k, levels[k]
        if backwards:
            left = x - same - block
            equal = (left >= 0) & (ranks[np.maximum(left, 0)] == ranks[np.maximum(y - same - block, 0)])
        else:
            equal = ranks[np.minimum(x + same, n)] == ranks[np.minimum(y + same, n)]
        same += np.where(equal, block, 0)
    return same


def small_children(lcp: list[int], deepest: int) -> list[tuple[int, int, int, int, int]]:
    """(depth, interval bounds, child bounds) of all children but the largest, bounds with the end excluded.

    ``lcp[p]`` is the common prefix of the suffixes p - 1 and p; intervals of a
    depth over ``deepest`` are left out.
    """
    found: list[tuple[int, int, int, int, int]] = []
    # Open intervals: depth, starts of their children.
    depths, starts = [0], [[0]]
    for p in range(1, len(lcp) + 1):
        depth = lcp[p] if p < len(lcp) else 0
        left = p - 1
        while depths[-1] > depth:
            d, children = depths.pop(), starts.pop()
            left = children[0]
            if d <= deepest:
                children.append(p)
                widths = [b - a for a, b in zip(children, children[1:])]  # noqa: B905
                largest = widths.index(max(widths))
                found += [(d, left, p, children[k], children[k + 1]) for k in range(len(widths)) if k != largest]
        if depths[-1] < depth:
            depths.append(depth)
            starts.append([left])
        if depth:
            starts[-1].append(p)
    return found


def branching_squares(levels: list[np.ndarray], deepest: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the branching squares with a period up to ``deepest``."""
    inverse = levels[-1][:-1].astype(np.int64)
    n = len(inverse)
    suffixes = np.empty(n, dtype=np.int64)
    suffixes[inverse] = np.arange(n)
    lcp = np.r_[0, common(levels, suffixes[:-1], suffixes[1:])] if n else np.empty(0, dtype=np.int64)
    children = np.array(small_children(lcp.tolist(), deepest), dtype=np.int64).reshape(-1, 5)
    widths = children[:, 4] - children[:, 3]
    starts, periods = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    # Some children at a time, so that the tests fit into memory.
    cuts = np.searchsorted(np.cumsum(widths), np.arange(0, int(widths.sum()) + 1, 4_000_000), side="right")
    for a, b in zip(cuts, [*cuts[1:], len(children)], strict=True):
        width = widths[a:b]
        depth, low, high, own_low, own_high = (np.repeat(c, width) for c in children[a:b].T)
        place = own_low + np.arange(len(depth)) - np.repeat(np.cumsum(width) - width, width)
        i = suffixes[place]
        for shift in (depth, -depth):
            j = i + shift
            r = inverse[np.clip(j, 0, n - 1)]
            square = (j >= 0) & (j < n) & (r >= low) & (r < high) & ((r < own_low) | (r >= own_high))
            starts.append(np.minimum(i, j)[square])
            periods.append(depth[square])
    return np.concatenate(starts), np.concatenate(periods)


def runs(symbols: np.ndarray, longest: int) -> Runs:
    """(start, length, period) of all runs, by start, then period.

    ``longest`` is the greatest number of symbols of one text: longer periods
    than its fourth part cannot be repeated four times.
    """
    if not len(symbols):
        return (np.empty(0, dtype=np.int64),) * 3
    levels = suffix_ranks(symbols)
    start, period = branching_squares(levels, longest // LEAST_EXPONENT)
    back = common(levels, start, start + period, backwards=True)
    start, length = start - back, 2 * period + back
    long_enough = length >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period)
    start, length, period = start[long_enough], length[long_enough], period[long_enough]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    # Multiples of a period cover the same stretch: the smallest stays.
    new = np.r_[True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])][:len(start)]
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """Which word of the text each place shows, where crc32 of the id asks for a planted repeat."""
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + np.arange(n - a) % p
    return places


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])


def _piece(ids: list[int | None], texts: list[list[bytes]], plant: bool) -> pa.RecordBatch:
    all_words, symbols, ends, base = [], [], [0], 0
    for doc_id, words in zip(ids, texts, strict=True):
        places = planted(len(words), doc_id) if plant else None
        if places is not None:
            words = [words[i] for i in places.tolist()]
        known: dict[bytes, int] = {}
        symbols += [known.setdefault(w, base + len(known)) for w in words]
        base += len(known)
        all_words.append(words)
        ends.append(ends[-1] + len(words))
    start, length, period = runs(np.array(symbols, dtype=np.int64), max(map(len, all_words), default=0))
    cuts = np.searchsorted(start, ends)
    found, collapsed = [], []
    for k, words in enumerate(all_words):
        own = slice(cuts[k], cuts[k + 1])
        triples = list(zip((start[own] - ends[k]).tolist(), length[own].tolist(), period[own].tolist(), strict=True))
        found.append([{"start": s, "length": n, "period": q} for s, n, q in triples])
        if triples:
            kept = np.ones(len(words), dtype=bool)
            for s, n, q in triples:
                kept[s + q:s + n] = False
            words = [words[i] for i in np.flatnonzero(kept).tolist()]
        collapsed.append(b" ".join(words).decode())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(found, pa.list_(RUN)), pa.array(collapsed, pa.string())], schema=FOUND)


def _finder(plant: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = text.as_py().encode().split()
                ids.append(doc_id)
                texts.append(words)
                held += len(words)
                if held >= PIECE_WORDS:
                    yield _piece(ids, texts, plant)
                    ids, texts, held = [], [], 0
            if ids:
                yield _piece(ids, texts, plant)
    return run


def find_runs(docs: DataFrame, plant: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, runs (start, length, period; by start, then period) and collapsed text of every document.

    Words are stretches without ASCII white space, numbered from 0; a run has at
    least six words and four periods.  ``collapsed`` joins by single spaces the
    words that no run holds after its first period.  With ``plant``, documents
    whose id asks for it are repeated first (:func:`planted`); a null id never
    does.  Null, empty and blank texts have no runs and an empty collapsed text.
    Texts of any length are read whole, a long one by itself.  Repeated rows and
    ids give repeated results, other columns are not read, and an empty table
    gives an empty table.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(
        _finder(plant), "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def run_digests(found: DataFrame) -> DataFrame:
    """The longest run of each document (ties: smallest start, then period) and digests of :func:`find_runs`."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
                    F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
                    F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
                    F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))
