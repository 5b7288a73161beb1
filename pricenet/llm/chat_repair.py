"""Conversation structure repair by generalised LR parsing.

The roles of a conversation should read ``(s?(ua)+)?``.  A generalised LR
parser reads them with weighted actions (delete, rerole, insert) on a
graph-structured stack: stacks share their lower parts, and equal stacks are
merged, keeping the smallest (cost, audit).  Audits are not compared letter by
letter: after each row the living audits are ranked, and a new one is its
predecessor's rank and the few letters added.  That is exact, because two
different audits over the same rows differ before either ends.

A conversation may be any share of the table, so no task holds one.  Rows are
dealt by range of (conversation, order) and cut into spans of bounded size.
Every span is parsed from each stack that may precede it (the grammar has
eight) into a small table of costs and audit ranks; a pass over these tables
alone picks the stacks at the borders; then every span is repaired by itself.
Only the digest of the repaired conversation reads its spans one after another,
as SHA-256 asks for, and holds one batch of them at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}

# LR(0) tables of the grammar  Talk -> empty | Body | s Body;  Body -> u a | Body u a.
SHIFTS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 5, (3, "u"): 6, (4, "u"): 6, (6, "a"): 7}
POPPED = {5: 2, 7: 3}
GOTO_BODY = {0: 3, 1: 4}
ACCEPTING = {0, 3, 4}

# Bounds of a span: rows and characters (one longer text is a span of its own).
SPAN_ROWS = 256
SPAN_CHARS = 65_536
# Characters of a text that ranges are told apart by: the driver holds a sample of them.
HEAD = 256

SOUND, BLANK, DUPLICATE, CUT_OFF = 0, 1, 2, 3


class Stack:
    """A top of the graph-structured stack; equal stacks are one object."""

    def __init__(self, state: int, below: Stack | None = None) -> None:
        self.state, self.below = state, below
        self._above: dict[int, Stack] = {}
        self._read: dict[str, Stack | None] = {}

    def _with(self, state: int) -> Stack:
        return self._above.setdefault(state, Stack(state, self))

    def read(self, symbol: str) -> Stack | None:
        """The stack after a role initial and the reductions it allows; None if the grammar forbids it."""
        if symbol not in self._read:
            state = SHIFTS.get((self.state, symbol))
            top = None if state is None else self._with(state)
            while top is not None and top.state in POPPED:
                base = top
                for _ in range(POPPED[top.state]):
                    base = base.below
                top = base._with(GOTO_BODY[base.state])
            if len(self._read) > 64:  # initials of unknown roles
                self._read.clear()
            self._read[symbol] = top
        return self._read[symbol]


ROOT = Stack(0)


def _all_stacks() -> list[Stack]:
    found = [ROOT]
    for stack in found:
        for symbol in "sua":
            top = stack.read(symbol)
            if top is not None and top not in found:
                found.append(top)
    return found


STACKS = _all_stacks()
NUMBER = {stack: k for k, stack in enumerate(STACKS)}

# A stack top: (cost, rank of its audit among the tops).
Tops = dict[Stack, tuple[int, int]]
# How a top came about: the top before the row, letters of the audit, initials read.
Steps = dict[Stack, tuple[Stack, str, str]]


def _inserted(tops: Tops) -> dict[Stack, tuple[int, int, int, str, Stack]]:
    """Every top reachable by insertions: (cost, rank, insertions, their initials, origin)."""
    best = {top: (cost, rank, 0, "", top) for top, (cost, rank) in tops.items()}
    todo = list(best)
    while todo:
        top = todo.pop()
        cost, rank, n, initials, origin = best[top]
        for symbol in ROLES:
            new = top.read(symbol)
            if new is not None:
                way = (cost + INSERT, rank, n + 1, initials + symbol, origin)
                if new not in best or way[:3] < best[new][:3]:
                    best[new] = way
                    todo.append(new)
    return best


def _advance(tops: Tops, initial: str, fault: int) -> tuple[Tops, Steps]:
    """Read one row with every action; equal tops are merged by the smallest (cost, audit)."""
    best: dict[Stack, tuple[int, int, str, str, Stack]] = {}

    def offer(top: Stack | None, way: tuple[int, int, str, str, Stack]) -> None:
        if top is not None and (top not in best or way[:3] < best[top][:3]):
            best[top] = way

    late = TRUNCATED if fault == CUT_OFF else 0
    for top, (cost, rank, n, initials, origin) in _inserted(tops).items():
        made = "I" * n
        offer(top, (cost + DELETE, rank, made + "D", initials, origin))
        if fault not in (BLANK, DUPLICATE):
            offer(top.read(initial), (cost + KEEP + late, rank, made + "K", initials + initial, origin))
            for symbol in ROLES:
                offer(top.read(symbol), (cost + REROLE + late, rank, made + "R", initials + symbol, origin))
    places = {audit: k for k, audit in enumerate(sorted({way[1:3] for way in best.values()}))}
    return ({top: (way[0], places[way[1:3]]) for top, way in best.items()},
            {top: (way[4], way[2], way[3]) for top, way in best.items()})


def _close(tops: Tops) -> tuple[int, Stack, str]:
    """Cost, last top before the end, and initials inserted there, of the best accepted stack."""
    cost, _, _, initials, origin = min(
        (way for top, way in _inserted(tops).items() if top.state in ACCEPTING), key=lambda way: way[:3])
    return cost, origin, initials


def parse(rows: list[tuple[str, int]], start: Stack) -> tuple[Tops, list[Steps]]:
    """Tops after (initial, fault) rows read from one stack, and every step."""
    tops: Tops = {start: (0, 0)}
    steps = []
    for initial, fault in rows:
        tops, step = _advance(tops, initial, fault)
        steps.append(step)
    return tops, steps


def trace(steps: list[Steps], end: Stack) -> list[tuple[str, str]]:
    """(letters, initials) of every row on the way to a top."""
    way = []
    for step in reversed(steps):
        end, letters, initials = step[end]
        way.append((letters, initials))
    return way[::-1]


def rendered(way: list[tuple[str, str]], rows: list[tuple[str, str | None]]) -> list[str]:
    """`role:text` lines of the repaired rows."""
    lines = []
    for (letters, initials), (role, text) in zip(way, rows, strict=True):
        lines += [f"{ROLES[symbol]}:" for symbol in initials[:len(letters) - 1]]
        if letters[-1] == "K":
            lines.append(f"{role}:{text}")
        elif letters[-1] == "R":
            lines.append(f"{ROLES[initials[-1]]}:{text}")
    return lines


# Spans -------------------------------------------------------------------------------------------

SPANS = pa.schema([
    ("key", pa.string()), ("part", pa.int32()), ("place", pa.int64()),
    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("faults", pa.list_(pa.int8())),
    ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32())), ("illegal", pa.int64())])
SPANS_DDL = ("key string, part int, place long, roles array<string>, texts array<string>, faults array<byte>, "
             "costs array<long>, ranks array<int>, illegal long")


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in pairwise(initials))


def span_table(rows: list[tuple[str, int]], starts: list[Stack]) -> tuple[list[int], list[int]]:
    """Costs (-1: no way) and audit ranks from every start (rows of the table) to every stack."""
    size = len(STACKS)
    costs, audits = [-1] * size * size, {}
    for start in starts:
        tops, steps = parse(rows, start)
        for top, (cost, _) in tops.items():
            at = NUMBER[start] * size + NUMBER[top]
            costs[at] = cost
            audits[at] = "".join(letters for letters, _ in trace(steps, top))
    places = {audit: k for k, audit in enumerate(sorted(set(audits.values())))}
    return costs, [places[audits[at]] if at in audits else -1 for at in range(size * size)]


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (key, part, role, text, fault of the first copy, copies) -> spans of each conversation."""
    key = part = None
    place, chars, begun = 0, 0, 0
    held: list[tuple[str, str | None, int]] = []
    out: list[tuple] = []

    def finish() -> None:
        nonlocal place, chars, held
        if held:
            rows = [(role[:1], fault) for role, _, fault in held]
            # A conversation that does not open its partition is read from its beginning.
            starts = [ROOT] if begun > 1 and place == 0 else STACKS
            costs, ranks = span_table(rows, starts)
            out.append((key, part, place, [r for r, _, _ in held], [t for _, t, _ in held], [f for _, _, f in held],
                        costs, ranks, _illegal([initial for initial, _ in rows])))
            place, chars, held = place + 1, 0, []

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), SPANS, strict=True)], schema=SPANS)
        out.clear()
        return made

    for rows in batches:
        for new_key, new_part, role, text, fault, copies in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            if new_key != key:
                finish()
                key, part, place, begun = new_key, new_part, 0, begun + 1
            for copy in range(copies):
                f = DUPLICATE if copy and fault != BLANK else fault
                # Rows that must go are never rendered.
                kept = None if f in (BLANK, DUPLICATE) else text
                held.append((role, kept, f))
                chars += len(kept or "")
                if len(held) >= SPAN_ROWS or chars >= SPAN_CHARS:
                    finish()
                    if len(out) >= 64:
                        yield batch()
        if out:
            yield batch()
    finish()
    if out:
        yield batch()


# Borders -----------------------------------------------------------------------------------------

BORDERS = pa.schema([
    ("key", pa.string()), ("part", pa.int32()), ("place", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
    ("tail", pa.string()), ("cost", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64())])
BORDERS_DDL = ("key string, part int, place long, start int, end int, tail string, cost long, blank long, "
               "duplicate long, truncated long, illegal long")


class _Talk:
    """The tops of one conversation over its spans: 1 + number of stacks bytes, and a place, a span."""

    def __init__(self, key: str) -> None:
        self.key, self.tops = key, {ROOT: (0, 0)}
        self.spans: list[tuple[int, int, bytes]] = []
        self.counts, self.illegal, self.last = [0, 0, 0], 0, None

    def add(self, part: int, place: int, costs: list[int], ranks: list[int], illegal: int, counts: list[int],
            first: str, last: str) -> None:
        size = len(STACKS)
        best: dict[Stack, tuple[int, int, int, int]] = {}
        for top, (cost, rank) in self.tops.items():
            row = NUMBER[top] * size
            for k, stack in enumerate(STACKS):
                if costs[row + k] >= 0:
                    way = (cost + costs[row + k], rank, ranks[row + k], NUMBER[top])
                    if stack not in best or way < best[stack]:
                        best[stack] = way
        places = {audit: k for k, audit in enumerate(sorted({way[1:3] for way in best.values()}))}
        self.tops = {stack: (way[0], places[way[1:3]]) for stack, way in best.items()}
        self.spans.append((part, place, bytes(best[s][3] if s in best else 255 for s in STACKS)))
        self.illegal += illegal + (0 if self.last is None else _illegal([self.last, first]))
        self.last = last
        self.counts = [a + b for a, b in zip(self.counts, counts, strict=True)]

    def borders(self) -> Iterator[tuple]:
        cost, end, tail = _close(self.tops)
        at, totals = NUMBER[end], (cost, *self.counts, self.illegal)
        for part, place, before in reversed(self.spans):
            yield (self.key, part, place, before[at], at, tail, *totals)
            at, tail, totals = before[at], "", (0, 0, 0, 0, 0)


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Span tables in order of (key, part, place) -> the stacks before and after every span."""
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), BORDERS, strict=True)], schema=BORDERS)

    talk, out = None, []
    for rows in batches:
        for key, part, place, costs, ranks, illegal, *rest in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            if talk is None or talk.key != key:
                for border in talk.borders() if talk else ():
                    out.append(border)
                    if len(out) >= 10_000:
                        yield batch(out)
                        out = []
                talk = _Talk(key)
            talk.add(part, place, costs, ranks, illegal, rest[:3], rest[3], rest[4])
    for border in talk.borders() if talk else ():
        out.append(border)
    for at in range(0, len(out), 10_000):
        yield batch(out[at:at + 10_000])


# Repair ------------------------------------------------------------------------------------------

PIECES = pa.schema([("key", pa.string()), ("part", pa.int32()), ("place", pa.int64()),
                    ("audit", pa.string()), ("lines", pa.int64()), ("repaired", pa.string())])
PIECES_DDL = "key string, part int, place long, audit string, lines long, repaired string"


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans with their borders -> audit and repaired lines of each."""
    for rows in batches:
        audits, counts, texts = [], [], []
        for roles, span_texts, faults, start, end, tail in zip(*(c.to_pylist() for c in rows.columns[3:]), strict=True):
            _, steps = parse([(r[:1], f) for r, f in zip(roles, faults, strict=True)], STACKS[start])
            way = trace(steps, STACKS[end])
            lines = rendered(way, list(zip(roles, span_texts, strict=True))) + [f"{ROLES[s]}:" for s in tail]
            audits.append("".join(letters for letters, _ in way) + "I" * len(tail))
            counts.append(len(lines))
            texts.append("\n".join(lines))
        yield pa.RecordBatch.from_arrays([*rows.columns[:3], pa.array(audits, pa.string()), pa.array(counts, pa.int64()),
                                          pa.array(texts, pa.string())], schema=PIECES)


DIGESTS = pa.schema([("key", pa.string()), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired spans in order -> audit and digest of every conversation."""
    key, audits, begun, digest = None, [], False, hashlib.sha256()
    out: list[tuple[str, str, str]] = []
    for rows in batches:
        for new_key, audit, n, text in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            if new_key != key:
                if key is not None:
                    out.append((key, "".join(audits), digest.hexdigest()))
                key, audits, begun, digest = new_key, [], False, hashlib.sha256()
            audits.append(audit)
            if n:
                digest.update((b"\n" if begun else b"") + text.encode())
                begun = True
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)], schema=DIGESTS)
            out = []
    if key is not None:
        out.append((key, "".join(audits), digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)], schema=DIGESTS)


# Tables ------------------------------------------------------------------------------------------

def damaged(turns: DataFrame) -> DataFrame:
    """(key, conv_id, turn, role, text) -> (key, turn, role, text, copies), by crc32 of the row's name."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return (turns.withColumn("harm", F.crc32(F.encode(name, "UTF-8")) % 20).where("harm <> 0")
            .select("key", "turn",
                    F.when(F.col("harm") == 4, "user").otherwise(role).alias("role"),
                    F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                    F.when(F.col("harm") == 3, 2).otherwise(1).alias("copies")))


def with_faults(rows: DataFrame) -> DataFrame:
    """Equal rows of one turn as one with their number, and the first fault of its first copy."""
    seen = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    own = cut_lineage(rows.groupBy("key", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
                      .withColumn("seen", seen).withColumn("at", F.struct(F.col("turn").isNotNull().alias("late"), "turn")))
    # Only what a conversation says in several turns is looked up.
    firsts = (own.groupBy("key", "seen").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("turns"))
              .where("turns > 1").drop("turns"))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = (F.when(last == "", BLANK).when(F.col("first").isNotNull() & (F.col("at") != F.col("first")), DUPLICATE)
             .when(~last.isin(".", "!", "?"), CUT_OFF).otherwise(SOUND))
    return own.join(firsts, ["key", "seen"], "left").select("key", "turn", "role", "text", fault.cast("int").alias("fault"), "copies")


def _streamed(df: DataFrame, run: Callable, ddl: str, *columns: str) -> DataFrame:
    """``run`` over ``columns`` of df in order of (key, part, place), a conversation in one task."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (df.repartition(parts, "key").sortWithinPartitions("key", "part", "place")
            .select(*columns).mapInArrow(run, ddl))


def repair_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of every conversation.

    Rows are damaged by name first (see :func:`damaged`).  They are read by turn,
    nulls first, ties by role, then text, both as damaged; equal rows of a turn
    follow each other and all but the first are duplicates.  A null role or text
    counts as one space, so a null text is blank and a null role fits nowhere.
    Null ids form one conversation.  A conversation without rows after the
    damage has zeros, an empty audit and the digest of the empty text; gaps is
    null where the turns are too far apart for a long.  Texts of any length are
    read whole; a long one is a span of its own.  Other columns are not read.
    An empty table gives an empty table.
    """
    key = F.coalesce(F.concat(F.lit("c"), F.col(conv_col).cast("long").cast("string")), F.lit("n"))
    own = turns.select(key.alias("key"), F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                       F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    names = own.select("key", "conv_id").distinct()
    rows = cut_lineage(with_faults(damaged(own)))
    distance = F.try_subtract(F.max("turn"), F.min("turn"))
    gaps = (rows.select("key", "turn").distinct().groupBy("key")
            .agg(F.count(F.lit(1)).alias("rows"), F.count("turn").alias("numbered"), distance.alias("distance"))
            .select("key", F.when(F.col("numbered") == 0, F.lit(0).cast("long"))
                    .otherwise(F.try_add(F.col("distance"), 1 - F.col("numbered"))).alias("gaps")))

    order = [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role")]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = cut_lineage(
        rows.repartitionByRange(parts, *order, F.substring("text", 1, HEAD)).sortWithinPartitions(*order, "text")
        .withColumn("part", F.spark_partition_id()).select("key", "part", "role", "text", "fault", "copies")
        .mapInArrow(_spans, SPANS_DDL))

    def faults(kind: int):
        return F.size(F.filter("faults", lambda f: f == kind)).cast("long")

    borders = cut_lineage(_streamed(
        spans.select("key", "part", "place", "costs", "ranks", "illegal", faults(BLANK).alias("blank"),
                     faults(DUPLICATE).alias("duplicate"), faults(CUT_OFF).alias("truncated"),
                     F.substring(F.element_at("roles", 1), 1, 1).alias("first"),
                     F.substring(F.element_at("roles", -1), 1, 1).alias("last")),
        _borders, BORDERS_DDL, "key", "part", "place", "costs", "ranks", "illegal", "blank", "duplicate", "truncated", "first", "last"))
    pieces = (spans.join(borders, ["key", "part", "place"])
              .select("key", "part", "place", "roles", "texts", "faults", "start", "end", "tail").mapInArrow(_repair, PIECES_DDL))
    digests = _streamed(pieces, _digests, "key string, audit string, repaired_sha256 string", "key", "audit", "lines", "repaired")
    counts = borders.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")])

    found = names.join(gaps, "key", "left").join(counts, "key", "left").join(digests, "key", "left")
    zero = F.lit(0).cast("long")
    return found.select(
        "conv_id", F.when(F.col("audit").isNull(), zero).otherwise(F.col("gaps")).alias("gaps"),
        *[F.coalesce(c, zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
