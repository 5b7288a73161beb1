"""Secret scan: rules for known forms, and formats inferred from the secrets they find.

Three rules give the base spans.  The values they find are labelled credentials;
a bounded sample of each kind, and of ordinary strings of the same alphabet,
is generalised into probabilistic automata by state merging (automata.py).
Then every string of the texts that could be a credential is scored: its
log-likelihood in the best credential format less that among ordinary strings.
High scores are added as spans of kind ``format``, unless a base span touches
them.  So secrets without a keyword, or shorter than the rules ask for, are
found when they look like the ones with it.

Texts are scanned where they lie: one pass samples, one scores.  Each task
sends at most ``LEARNED`` strings a kind, those of the smallest hashes, so the
sample does not depend on how the table is split; the driver gets as many in
all.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .automata import Automata, infer
from .columns import id_and_text, runs_of

# The rules, in the order of their kinds.
KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6

FORMAT = "format"
# Ordinary strings are learned apart, as those with digits are rare.
WORD, NUMBER = "word", "number"
DIGIT = re.compile("[0-9]")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
LEAST_CANDIDATE = 12
# Parameters: strings a kind to learn from and their greatest length, the fewest that make a format, the least score.
LEARNED, LEARNED_CHARS, FEWEST, LEAST_SCORE = 400, 128, 8, 12.0

Span = tuple[int, int, int, int, float | None]


def base_spans(text: str) -> list[Span]:
    """(start, order of the kind, end, start of the value, no score) of the rules' matches, by start, then kind."""
    found = [(m.start(), 0, m.end(), m.start(1), None) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start(), None) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.start(), None) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[Span]) -> Iterator[tuple[int, str]]:
    """(start, string) of the possible credentials that no base span touches."""
    ends = 0
    at = 0
    for m in CANDIDATE.finditer(text):
        string = m[0].rstrip(".")
        end = m.start() + len(string)
        while at < len(base) and base[at][0] < end:
            ends = max(ends, base[at][2])
            at += 1
        if len(string) >= LEAST_CANDIDATE and ends <= m.start():
            yield m.start(), string


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=7).digest())


class _Smallest:
    """The distinct strings of the smallest hashes."""

    def __init__(self) -> None:
        self.held: dict[str, int] = {}
        self.limit = 1 << 60

    def add(self, value: str) -> None:
        if len(value) <= LEARNED_CHARS and value not in self.held:
            h = _hash(value)
            if h < self.limit:
                self.held[value] = h
                if len(self.held) >= 2 * LEARNED:
                    self.cut()

    def cut(self) -> list[tuple[int, str]]:
        smallest = sorted((h, v) for v, h in self.held.items())[:LEARNED]
        self.held = {v: h for h, v in smallest}
        if len(smallest) == LEARNED:
            self.limit = smallest[-1][0]
        return smallest


EXAMPLES = pa.schema([("kind", pa.string()), ("hash", pa.int64()), ("value", pa.string())])


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept = {kind: _Smallest() for kind in [*KINDS, WORD, NUMBER]}
    for batch in batches:
        for value in batch.column(0):
            text = value.as_py()
            base = base_spans(text)
            for _, kind, end, start, _ in base:
                kept[KINDS[kind]].add(text[start:end])
            for _, string in candidates(text, base):
                kept[NUMBER if DIGIT.search(string) else WORD].add(string)
    rows = [(kind, h, v) for kind, smallest in kept.items() for h, v in smallest.cut()]
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), EXAMPLES, strict=True)], schema=EXAMPLES)


class Formats:
    """Automata of the credential kinds that have enough examples, and of ordinary strings."""

    def __init__(self, examples: dict[str, list[str]]) -> None:
        enough = {kind: strings for kind, strings in examples.items() if len(strings) >= FEWEST}
        secret = [infer(enough[kind]) for kind in KINDS if kind in enough]
        self.kinds = len(secret)
        # Without examples all strings of a length are alike: a few would only be learned by heart.
        self.automata = Automata(secret + [infer(enough.get(kind, [])) for kind in (WORD, NUMBER)])

    def scores(self, strings: list[str]) -> list[float]:
        """How much likelier each string is as a credential than as an ordinary one, in natural logarithms."""
        likelihoods = self.automata.likelihoods(strings)
        return (likelihoods[:, :self.kinds].max(axis=1) - likelihoods[:, self.kinds:].max(axis=1)).tolist()


def learn_formats(docs: DataFrame) -> Formats:
    """Formats of the labelled values that the rules find in a table (column text).

    Learns from the ``LEARNED`` distinct values a kind of the smallest hashes, of
    up to ``LEARNED_CHARS`` characters.
    """
    sampled = docs.select("text").mapInArrow(_sample, "kind string, hash long, value string").distinct()
    # In two rounds, so that no task takes the samples of all tasks.
    for keys in (["kind", F.col("hash") % 64], ["kind"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("hash", "value"))
        sampled = sampled.withColumn("rank", rank).where(F.col("rank") <= LEARNED).drop("rank")
    examples: dict[str, list[str]] = {}
    for row in sorted(sampled.collect()):
        examples.setdefault(row.kind, []).append(row.value)
    return Formats(examples)


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
FOUND = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(SPAN))])


def scan(texts: list[str], formats: Formats) -> list[list[Span]]:
    """Spans of every text, by start, then kind: the rules' ones and those of likely formats."""
    spans = [base_spans(t) for t in texts]
    found = [(k, at, string) for k, t in enumerate(texts) for at, string in candidates(t, spans[k])] if formats.kinds else []
    if found:
        for (k, at, string), score in zip(found, formats.scores([string for _, _, string in found]), strict=True):
            if score >= LEAST_SCORE:
                spans[k].append((at, len(KINDS), at + len(string), at, score))
    return [sorted(s, key=lambda x: x[:3]) for s in spans]


def _scanner(shared: Broadcast):
    names = [*KINDS, FORMAT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(1).to_pylist(), []
            for start, end in runs_of(texts):
                spans += [[{"kind": names[k], "start": s, "end": e, "score": score} for s, k, e, _, score in found]
                          for found in scan(texts[start:end], shared.value)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(SPAN))], schema=FOUND)
    return run


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (kind, start, end, score) of every document, by start, then kind.

    Places are code points, ends excluded; base kinds have no score.  Null and
    empty texts have no spans.  Texts of any length are scanned whole.  Repeated
    rows and ids give repeated results; other columns are not read.  An empty
    table gives an empty table; a table with fewer than ``FEWEST`` labelled
    values of every kind has base spans only.
    """
    read = id_and_text(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(learn_formats(read))
    return read.mapInArrow(_scanner(shared), "doc_id long, spans array<struct<kind: string, start: long, end: long, score: double>>")


def span_digests(found: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and list of all spans of :func:`find_secrets`."""
    def of(kind: str):
        return F.filter("spans", lambda s: s.kind == kind)

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    return found.select(
        "doc_id", *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(listed(F.filter("spans", lambda s: s.kind != FORMAT)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), F.size(of(FORMAT)).cast("long").alias("n_format"))
