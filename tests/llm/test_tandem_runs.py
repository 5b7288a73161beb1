"""Periodic runs against the definition, period by period."""

import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from pricenet.llm.tandem_runs import PIECE_WORDS, find_runs, run_digests, runs
from tests.llm.helpers import awkward_docs, empty_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, length, q) for (s, length), q in found.items())


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
            sha("".join("%d,%d,%d\n" % r for r in found)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def of_symbols(words):
    known = {}
    return [tuple(r) for r in zip(*(c.tolist() for c in runs(np.array([known.setdefault(w, len(known)) for w in words]), len(words))),
                                  strict=True)]


def test_random_sequences():
    rng = random.Random(1)
    for _ in range(400):
        words = []
        while len(words) < rng.randrange(1, 90):
            part = [rng.choice("abc") for _ in range(rng.randrange(1, 7))]
            words += part * rng.randrange(1, 8)
        assert of_symbols(words) == sorted(plain_runs(words), key=lambda r: (r[0], r[2]))


def test_periodic_and_fibonacci_words():
    for words in ("a" * 5, "a" * 6, "a" * 500, "ab" * 4, "ab" * 3, "aab" * 30 + "a", "abaab" * 4 + "abaab"[:3]):
        assert of_symbols(words) == sorted(plain_runs(words), key=lambda r: (r[0], r[2])), words
    fib = ["a", "ab"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    assert of_symbols(fib[-1] * 4) == sorted(plain_runs(fib[-1] * 4), key=lambda r: (r[0], r[2]))


def digests(df):
    return sorted((tuple(r) for r in run_digests(find_runs(df, plant=True)).collect()), key=repr)


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    short = [(i, t) for i, t in rows if len(WORD.findall(t or "")) <= 3000]
    found = {r[0]: r for r in digests(df)}
    assert len(found) == len(rows) and len(short) > 0.9 * len(rows)
    assert all(found[i] == plain_row(i, t) for i, t in short)
    assert sum(1 for r in found.values() if r[1]) > 10


def test_awkward_rows(spark):
    df = awkward_docs(spark).withColumn("runs", F.lit(1)).withColumn("start", F.lit("clash"))
    assert digests(df) == sorted((plain_row(r.doc_id, r.text) for r in df.collect()), key=repr)
    assert digests(empty_docs(spark)) == []
    assert find_runs(empty_docs(spark)).columns == ["doc_id", "runs", "collapsed"]


def test_very_long_text(spark):
    rng = random.Random(3)
    words = [str(rng.randrange(2000)) for _ in range(PIECE_WORDS)] + ["x", "y", "z"] * (PIECE_WORDS // 2)
    df = spark.createDataFrame([(1, " ".join(words)), (2, "a " * 7)], "doc_id long, text string")
    got = {r.doc_id: r.runs for r in find_runs(df).collect()}
    assert [tuple(r) for r in got[1]] == [(PIECE_WORDS, 3 * (PIECE_WORDS // 2), 3)] and [tuple(r) for r in got[2]] == [(0, 7, 1)]
