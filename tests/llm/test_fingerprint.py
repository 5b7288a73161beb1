"""Fingerprints against a reading of the texts in Python."""

import hashlib
from functools import reduce

import pytest
import xxhash

from pricenet.llm import fingerprint, queries
from tests.conftest import SF_CHECK
from tests.llm.helpers import awkward_docs, empty_docs


def brute_order(rows):
    return sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0))


def edits(rows):
    """(id, text, next text, edited text) by id, for distinct ids."""
    out = []
    for i, r in enumerate(rows):
        text, after = r.text or "", rows[(i + 1) % len(rows)].text or ""
        k = len(text) // 2
        out.append((r.doc_id, text, after, text[:len(text) - k] + after[:k]))
    return out


def shingles(text):
    words = [w for w in text.lower().replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if w]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def brute_sketch(text):
    """The kept shingle hashes, by plain loops."""
    chained = lambda hashes: reduce(
        lambda seed, h: xxhash.xxh64_intdigest(h.to_bytes(8, "little"), seed=seed), hashes, 42)
    words = [xxhash.xxh64_intdigest(w, seed=42) for w in text.lower().encode().split()]
    every = {signed(chained(words[i:i + 5])) for i in range(max(1, len(words) - 4))} if words else set()
    return {h for h in every if h < -(1 << 63) + (1 << 64) // fingerprint.FRACTION or h == min(every)}


def brute_text(text):
    return "".join(f"{h & (1 << 64) - 1:016X}" for h in sorted(brute_sketch(text)))


def test_sketches_by_plain_loops(spark):
    rows = {r.doc_id: r for r in queries.op9_fingerprints(spark, SF_CHECK).collect()}
    for i, text, after, edited in edits(brute_order(spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect())):
        r, own, changed, following = rows[i], *map(brute_sketch, (text, edited, after))
        assert (r.fingerprint, r.edited_fingerprint) == (brute_text(text), brute_text(edited))
        assert r.near_edited == pytest.approx(jaccard(own, changed)) and r.near_next == pytest.approx(jaccard(own, following))
        assert r.contained_next == pytest.approx(len(own & following) / len(own) if own else 1.0)


def test_error_by_length(spark):
    """Mean error of the likeness to the edited text, for texts of 20 words and more."""
    rows = {r.doc_id: r.near_edited for r in queries.op9_fingerprints(spark, SF_CHECK).collect()}
    off = {20: [], 50: [], 200: []}
    for i, text, _, edited in edits(brute_order(spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect())):
        for least in [n for n in off if len(text.split()) >= n][-1:]:
            off[least].append(abs(rows[i] - jaccard(shingles(text), shingles(edited))))
    for least, most in ((20, 0.12), (50, 0.08), (200, 0.04)):
        assert sum(off[least]) / len(off[least]) < most


def test_whole_table(spark):
    rows = {r.doc_id: r for r in queries.op9_fingerprints(spark, SF_CHECK).collect()}
    want = edits(brute_order(spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()))
    assert len(rows) == len(want)
    off = []
    for i, text, after, edited in want:
        r = rows[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for value, other in ((r.near_edited, edited), (r.near_next, after)):
            assert 0 <= value <= 1
            if len(text.split()) > 200:
                off.append(abs(value - jaccard(shingles(text), shingles(other))))
    assert sum(off) / len(off) < 0.05 and max(off) < 0.5
    # Each range is 64 documents at least, so this table has many of them.
    assert len({r.fingerprint for r in rows.values()}) > 900


def test_equal_texts_and_containment(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    part = " ".join(f"w{i}" for i in range(600))
    docs = spark.createDataFrame([(1, long), (2, part), (3, long), (4, part.upper()), (5, "Other text entirely here now")],
                                 "doc_id long, text string")
    r = {x.doc_id: x for x in fingerprint.fingerprint_edits(docs).collect()}
    assert r[1].fingerprint == r[3].fingerprint and r[2].fingerprint == r[4].fingerprint
    assert r[2].contained_next == 1.0 and r[2].near_next == pytest.approx(0.2, abs=0.07)
    assert r[1].contained_next == pytest.approx(0.2, abs=0.07)
    assert r[4].near_next == 0.0


def test_ranges_join_seamlessly(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "RANGE_ROWS", 3)
    ids = [i * i * 7 - 500 for i in range(100)]
    docs = spark.createDataFrame([(i, f"text of {i} " * 3) for i in ids], "doc_id long, text string").repartition(9)
    got = {r.doc_id: r.edited_sha256 for r in fingerprint.fingerprint_edits(docs).collect()}
    want = {i: hashlib.sha256(e.encode()).hexdigest() for i, _, _, e in edits(brute_order(docs.collect()))}
    assert got == want


def test_awkward_rows(spark):
    docs = awkward_docs(spark).where("doc_id is not null and doc_id not in (1, 3)")
    got = {r.doc_id: r for r in fingerprint.fingerprint_edits(docs).collect()}
    for i, text, _, edited in edits(brute_order(docs.collect())):
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert bool(got[i].fingerprint) == bool(shingles(text))
    assert got[20].fingerprint == got[21].fingerprint
    everything = awkward_docs(spark)
    first = sorted(map(str, fingerprint.fingerprint_edits(everything).collect()))
    assert len(first) == everything.count()
    assert first == sorted(map(str, fingerprint.fingerprint_edits(everything.repartition(5)).collect()))
    assert fingerprint.fingerprint_edits(empty_docs(spark)).count() == 0
    one = fingerprint.fingerprint_edits(docs.where("doc_id = 6")).first()
    assert one.near_next == 1.0
    nulls = spark.createDataFrame([(None, "a b"), (None, "c d")], "doc_id long, text string")
    assert fingerprint.fingerprint_edits(nulls).count() == 2


def test_merged_sketches(spark):
    texts = [" ".join(f"{p}{i}" for i in range(400)) for p in "ab"]
    docs = spark.createDataFrame([("k", t) for t in texts] + [("both", texts[0] + " " + texts[1])], "k string, text string")
    merged = {r.k: set(r.s) for r in fingerprint.merged(fingerprint.with_sketch(docs, docs.text, "s"), "k", "s").collect()}
    # The joined text has four more shingles, across the seam.
    assert len(merged["k"] ^ merged["both"]) <= 4


def test_native_plan(spark):
    plan = queries.op9_fingerprints(spark, SF_CHECK)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "from_json" not in plan
    assert plan.count("Exchange") == 1
