"""License scans: one Aho-Corasick pass finds notice phrases and identifier
tags; a shunting-yard parser evaluates the and/or/with expression of a tag.

Phrases are matched on words, so line breaks, punctuation and case between the
words of a notice do not hide it.  Each document is one row in, one row out;
nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .columns import id_and_text

# The base phrases and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Further notice phrases (words), their labels and how strongly they speak for a licence.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge": ("mit", 0.9),
    "licensed under the apache license": ("apache", 0.9),
    "released under the mit license": ("mit", 0.9),
    "licensed under the gnu general public license": ("gpl", 0.9),
    "lesser general public license": ("lgpl", 0.8),
    "affero general public license": ("agpl", 0.8),
    "mozilla public license": ("mpl", 0.8),
    "eclipse public license": ("epl", 0.8),
    "bsd license": ("bsd", 0.7),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "isc license": ("isc", 0.7),
    "boost software license": ("bsl", 0.8),
    "creative commons attribution": ("cc-by", 0.7),
    "cc by": ("cc-by", 0.5),
    "cc by sa": ("cc-by-sa", 0.7),
    "cc by nc": ("cc-by-nc", 0.7),
    "cc by nd": ("cc-by-nd", 0.7),
    "cc0 1 0": ("cc0", 0.7),
    "dedicated to the public domain": ("public-domain", 0.7),
    "all rights reserved": ("proprietary", 0.5),
}

TAG_WORDS = ("spdx license identifier", "license expression")
TAGS = ("spdx-license-identifier", "license-expression")
BASE_STRENGTH, TAG_STRENGTH = 0.7, 0.95

# Identifier stems, their label and how freely the text may be used (1: freely).
FAMILIES = {
    "mit": ("mit", 1.0), "x11": ("mit", 1.0), "apache": ("apache", 0.95), "bsd": ("bsd", 1.0),
    "isc": ("isc", 1.0), "0bsd": ("bsd", 1.0), "bsl": ("bsl", 0.95), "unlicense": ("public-domain", 1.0),
    "cc0": ("cc0", 1.0), "cc-by": ("cc-by", 0.8), "cc-by-sa": ("cc-by-sa", 0.5),
    "cc-by-nc": ("cc-by-nc", 0.1), "cc-by-nd": ("cc-by-nd", 0.1), "mpl": ("mpl", 0.6),
    "epl": ("epl", 0.5), "lgpl": ("lgpl", 0.5), "gpl": ("gpl", 0.2), "agpl": ("agpl", 0.1),
    "proprietary": ("proprietary", 0.0), "public-domain": ("public-domain", 1.0),
}
UNKNOWN_FREEDOM = 0.3
EXCEPTION_GAIN = 0.1

# Word characters are 0-9, a-z after lower-casing, and everything beyond ASCII.
_TO_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256))


@lru_cache(maxsize=4096)
def family(identifier: str) -> tuple[str, float]:
    """Label and freedom of an identifier: its longest known stem, else itself."""
    stem = identifier
    while stem:
        if stem in FAMILIES:
            return FAMILIES[stem]
        stem = stem.rpartition("-")[0]
    return re.sub(r"[^0-9a-z.-]", "", identifier) or "unknown", UNKNOWN_FREEDOM


_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_LINE = re.compile(r"[^\n\r]*")
# Between a tag and its expression, either of them in quotes or not.
_START = re.compile(r"""["']?[\x20\t]*[:=][\x20\t]*["']?""")
_TOKEN = re.compile(r"[()]|[0-9a-z][0-9a-z.+:-]*")


@dataclass
class Terms:
    """What an expression says: the labels it names and how freely it lets one use the text."""
    freedom: float
    labels: set[str] = field(default_factory=set)


def to_postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard: infix licence tokens to postfix, None where they do not parse."""
    output: list[str] = []
    waiting: list[str] = []
    operand_next = True
    for t in tokens:
        if t == "(":
            if not operand_next:
                return None
            waiting.append(t)
        elif t == ")":
            if operand_next:
                return None
            while waiting and waiting[-1] != "(":
                output.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif t in _PRECEDENCE:
            if operand_next:
                return None
            while waiting and waiting[-1] != "(" and _PRECEDENCE[waiting[-1]] >= _PRECEDENCE[t]:
                output.append(waiting.pop())
            waiting.append(t)
            operand_next = True
        else:
            if not operand_next:
                return None
            output.append(t)
            operand_next = False
    if operand_next:
        return None
    while waiting:
        t = waiting.pop()
        if t == "(":
            return None
        output.append(t)
    return output


def evaluate(expression: str) -> Terms:
    """Terms of a lower-case licence expression.

    ``or`` leaves the freer choice, ``and`` binds to the stricter side, ``with``
    loosens its licence a little and names no licence of its own.  Where the
    expression does not parse, all licences it names bind together.
    """
    tokens = _TOKEN.findall(expression)
    postfix = to_postfix(tokens)
    if postfix is None:
        names = [family(t) for t in tokens if t not in _PRECEDENCE and t not in "()"]
        return Terms(min((f for _, f in names), default=UNKNOWN_FREEDOM), {label for label, _ in names})
    stack: list[Terms] = []
    for t in postfix:
        if t not in _PRECEDENCE:
            label, freedom = family(t)
            stack.append(Terms(freedom, {label}))
            continue
        right, left = stack.pop(), stack.pop()
        if t == "with":
            stack.append(Terms(min(1.0, left.freedom + EXCEPTION_GAIN), left.labels))
        else:
            pick = max if t == "or" else min
            stack.append(Terms(pick(left.freedom, right.freedom), left.labels | right.labels))
    return stack[0]


class Scanner:
    """The automata and the per-document scan; one instance per Python worker."""

    def __init__(self) -> None:
        self.phrases = ahocorasick.Automaton()
        for kind, group in (("base", BASE_PHRASES), ("notice", NOTICE_PHRASES), ("tag", dict.fromkeys(TAG_WORDS))):
            for phrase, value in group.items():
                key = f" {phrase} "
                self.phrases.add_word(key, [*self.phrases.get(key, []), (kind, value, len(key))])
        self.phrases.make_automaton()
        self.tags = ahocorasick.Automaton()
        for tag in TAGS:
            self.tags.add_word(tag, len(tag))
        self.tags.make_automaton()

    def tagged(self, text: bytes) -> Iterator[Terms]:
        """Terms of each expression that follows an identifier tag on its line."""
        lowered = text.lower().decode("utf-8", "replace")
        for end, _ in self.tags.iter(lowered):
            start = _START.match(lowered, end + 1)
            if start is None:
                continue
            line = _LINE.match(lowered, start.end())[0]
            line = re.sub(r"(\*/|-->|[\"';#,]).*", "", line)
            # The expression ends where two operands meet without an operator.
            kept: list[str] = []
            for t in _TOKEN.findall(line):
                if kept and t != ")" and t not in _PRECEDENCE and kept[-1] != "(" and kept[-1] not in _PRECEDENCE:
                    break
                kept.append(t)
            if kept:
                yield evaluate(" ".join(kept))

    def scan(self, text: bytes) -> tuple:
        words = text.translate(_TO_WORDS).split()
        line = (b" " + b" ".join(words) + b" ").decode("utf-8", "replace")
        n_base, starts, base, labels, doubt, freedom, tag = 0, [], set(), set(), 1.0, [], False
        for end, found in self.phrases.iter(line):
            for kind, value, length in found:
                if kind == "base":
                    n_base += 1
                    starts.append(end - length + 1)
                    base.add(value)
                    doubt *= 1 - BASE_STRENGTH
                    freedom.append(family(value)[1])
                elif kind == "notice":
                    labels.add(value[0])
                    doubt *= 1 - value[1]
                    freedom.append(family(value[0])[1])
                else:
                    tag = True
        for terms in self.tagged(text) if tag else ():
            labels |= terms.labels
            doubt *= 1 - TAG_STRENGTH
            freedom.append(terms.freedom)
        first = line.count(" ", 0, min(starts)) if starts else None
        last = line.count(" ", 0, max(starts)) if starts else None
        return (len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(base | labels)),
                1.0 - doubt, min(freedom, default=None))


_SCANNER: list[Scanner] = []

RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
    ("score", pa.float64()), ("freedom", pa.float64())])


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if not _SCANNER:
        _SCANNER.append(Scanner())
    scan = _SCANNER[0].scan
    for batch in batches:
        rows = [scan(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
        columns = list(zip(*rows, strict=True)) or [()] * (len(RESULT) - 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(RESULT)[1:], strict=True))],
            schema=RESULT)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence evidence of every document.

    doc_id, n_words, n_base (all places of base phrases), first_word and
    last_word (their smallest and largest start, null without one), base_labels,
    labels, score (how surely the text carries a licence notice) and freedom
    (how freely its strictest notice lets one use it, null without notice).

    Null and empty texts: 0 words, no labels, score 0.  Texts of any length are
    scanned whole.  Repeated rows give repeated results; other columns are not
    read; an empty table gives an empty table.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(
        _scan_batches, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                       "base_labels string, labels string, score double, freedom double")
