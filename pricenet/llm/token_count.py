"""Token counts by a map-side two-tier lookup.

A text is cut into pre-tokens that the tokenizer never merges across: a run
up to the next single space, and what lies between longer white space.  Most of them are frequent ones.  Their token
counts sit in a compact table of bounded size that is broadcast (tier one);
the others go through a bounded cache in each Python worker, whose misses the
tokenizer encodes (tier two).  No pre-token is shuffled: a first pass keeps a
bounded list of frequent pre-tokens per partition, and only those lists meet.

The table only decides which tier answers.  Counts are the tokenizer's own.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import id_and_text, runs_of
from .tokenizer_files import broadcast_file, per_worker, special_tokens

# Size bounds: pre-tokens in the broadcast table, its longest one in characters,
# candidates per partition, pre-tokens held by a worker, and their longest.
TABLE_ENTRIES = 32_768
TABLE_CHARS = 32
PER_PARTITION = 8_192
HELD = 300_000
HELD_CHARS = 64
# Texts above this are counted piece by piece.
PIECE = 1_000_000
TOKEN_LIMIT = 512

# A space whose both neighbours are white space (or the end) is not a place to cut.
_RUN = re.compile(r"\s (?:\s|\Z)")
# What the tokenizer's pattern takes for white space (Unicode's White_Space).
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# A stretch of white space but its last character, which goes with the word after it.
_UNIT = re.compile(f"[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]?[^{_SPACE}]+")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def pre_tokens(text: str) -> list[str]:
    """Parts that tokenize apart as they do together.

    A text is cut before every space; one with a ``_RUN`` also round its
    stretches of white space, each of which but its last character is a part.
    """
    if _RUN.search(text):
        return _UNIT.findall(text)
    first, *rest = text.split(" ")
    return [first, *[" " + x for x in rest]] if first else [" " + x for x in rest]


def pieces(text: str) -> Iterator[str]:
    """The text in parts of about ``PIECE`` characters that tokenize apart as they do together."""
    at = 0
    while len(text) - at > PIECE and (m := _CUT.search(text, at + PIECE)):
        yield text[at:m.start()]
        at = m.start()
    yield text[at:] if at else text


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for start, end in runs_of(texts):
            here: Counter = Counter()
            for t in texts[start:end]:
                here.update(t.split(" "))
            seen.update({w: n for w, n in here.items() if 0 < len(w) < TABLE_CHARS})
            if len(seen) > HELD:
                seen = Counter(dict(seen.most_common(HELD // 3)))
    top = [(" " + w, n) for w, n in seen.most_common(PER_PARTITION)]
    yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()),
                                      pa.array([n for _, n in top], pa.int64())], ["piece", "n"])


def frequent_pre_tokens(texts: DataFrame) -> list[str]:
    """The most frequent pre-tokens of the corpus, at most ``TABLE_ENTRIES``."""
    counted = texts.select("text").mapInArrow(_frequent, "piece string, n long")
    rows = (counted.groupBy("piece").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "piece").limit(TABLE_ENTRIES).collect())
    return [r.piece for r in rows]


class Counts:
    """Token counts of texts by one tokenizer; one instance per Python worker."""

    def __init__(self, content: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        specials = special_tokens(content)
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self.held: dict[str, int] = {}

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def plain(self, text: str) -> bool:
        return not (self.special and self.special.search(text))

    def learn(self, units: set[str], table: dict[str, int]) -> dict[str, int]:
        """Put the counts of short units that neither tier knows into the cache; return those of long ones."""
        missing = list(units - self.held.keys() - table.keys())
        if len(self.held) + len(missing) > HELD:
            held = self.held
            self.held = {u: held[u] for u in units & held.keys()}
        codes = self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)
        long = {}
        for unit, code in zip(missing, codes, strict=True):
            (self.held if len(unit) <= HELD_CHARS else long)[unit] = len(code)
        return long

    def count(self, texts: list[str], table: dict[str, int]) -> list[int]:
        cut = [pre_tokens(t) if self.plain(t) else None for t in texts]
        units: set[str] = set()
        for c in cut:
            if c:
                units.update(c)
        known = self.learn(units, table)
        known.update((u, n) for u in units if (n := table.get(u)) is not None)
        known.update((u, self.held[u]) for u in units - known.keys())
        get = known.__getitem__
        return [self.whole(t) if c is None else sum(map(get, c)) for t, c in zip(texts, cut, strict=True)]

    def counts(self, texts: list[str], table: dict[str, int]) -> list[int]:
        out: list[int] = []
        for start, end in runs_of(texts):
            part = texts[start:end]
            if any(len(t) > PIECE for t in part):
                # A special string must not be cut, so such a text is taken whole between cuts.
                for t in part:
                    parts = list(pieces(t)) if not (self.special and self.special.search(t)) else [t]
                    out.append(sum(sum(self.count([p], table)) for p in parts))
            else:
                out.extend(self.count(part, table))
        return out


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                    ("over_limit", pa.bool_())])


def _counter(shared: Broadcast, table: Broadcast, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, known = per_worker(Counts, shared), table.value
        for batch in batches:
            texts = batch.column(1)
            n_bytes = [len(t) for t in texts.cast(pa.binary()).to_pylist()]
            n_tokens = counts.counts(texts.to_pylist(), known)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array([n > limit for n in n_tokens], pa.bool_())], schema=RESULT)
    return run


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit``) of every text.

    The tokenizer is a byte-level BPE file whose pattern lets a pre-token start
    with one space.  Special strings in a text count as the library's default
    treats them.  Null and empty texts: 0 bytes, 0 tokens.  Repeated rows give
    repeated results; other columns are not read.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col)
    shared = broadcast_file(spark, tokenizer_path)
    frequent = frequent_pre_tokens(texts)
    with open(tokenizer_path, encoding="utf-8") as f:
        own = Counts(f.read())
    own.learn(set(frequent), {})
    table = spark.sparkContext.broadcast(own.held)
    return texts.mapInArrow(_counter(shared, table, limit),
                            "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
