"""Secret scan: base spans against the rules read one by one, automata against plain walks and held-out formats."""

import hashlib
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from pricenet.llm import automata, secret_scan
from pricenet.llm.secret_scan import Formats, base_spans, candidates, find_secrets, learn_formats, scan, span_digests
from tests.llm.helpers import awkward_docs, empty_docs

RULES = [
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
               r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
]
HEX, UPPER = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def plain_base(text):
    return sorted((m.start(), k, m.end()) for k, (_, rule, good) in enumerate(RULES) for m in re.finditer(rule, text or "") if good(m))


def plain_row(text):
    base = plain_base(text)
    line = ",".join(f"{RULES[k][0]}:{s}:{e}" for s, k, e in base)
    return (*[sum(1 for b in base if b[1] == k) for k in range(3)], hashlib.sha256(line.encode()).hexdigest())


def token(rng, n, letters=HEX):
    return "".join(rng.choice(letters) for _ in range(n))


def credential_docs(spark, n=300, seed=1):
    rng = random.Random(seed)
    words = ["the", "anonymous", "considerations", "interchangeable", "notwithstanding", "2024-01-01T00:00", "192.168.100.23",
             "mail.example.com"]
    rows = []
    for k in range(n):
        parts = [rng.choice(words) for _ in range(20)]
        parts.insert(5, rng.choice([f'token = "{token(rng, 40)}"', f"AKIA{token(rng, 16, UPPER)}", f"password: {token(rng, 12)}", "é"]))
        rows.append((k, " ".join(parts)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_base_rules_on_random_text():
    rng = random.Random(2)
    parts = ["token", "TOKEN", "api_key", "apikey", "passwd", "ſecret", "toKen", "=", ":", " ", '"', "'", "AKIA", "abcdef0123",
             "ABCDEF0123456789", "é", "日", "\n", ".", "_", "secret"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(16)))
        assert [s[:3] for s in base_spans(text)] == plain_base(text), text


def test_candidates_keep_off_base_spans():
    text = "abcdefghijklmnop token=abcdefghijkl.mnop qrstuvwxyzab. short " + "f" * 30
    assert [c for _, c in candidates(text, base_spans(text))] == ["abcdefghijklmnop", "qrstuvwxyzab"]


def test_likelihoods_like_a_walk():
    rng = random.Random(3)
    models = [automata.infer([token(rng, 20) for _ in range(100)]), automata.infer(["AKIA" + token(rng, 16, UPPER) for _ in range(100)]),
              automata.infer([])]
    table = automata.Automata(models)
    texts = [token(rng, rng.randrange(1, 60), automata.ALPHABET) for _ in range(60)] + ["AKIA" + token(rng, 16, UPPER), "a" * 30_000]
    size, share = len(automata.ALPHABET) + 1, automata.UNSEEN / (len(automata.ALPHABET) + 1)
    for text, row in zip(texts, table.likelihoods(texts).tolist(), strict=True):
        for states, found in zip(models, row, strict=True):
            state, total = states[0], 0.0
            for c in text:
                total += math.log((state.counts.get(c, 0) + share) / (state.passes + share * size))
                state = state.moves.get(c, state)
            total += math.log((state.ends + share) / (state.passes + share * size))
            assert math.isclose(total, found, rel_tol=1e-9)


def test_inference_merges_and_keeps_counts():
    rng = random.Random(4)
    fixed = automata.infer(["AKIA" + token(rng, 16, UPPER) for _ in range(300)])
    assert 5 <= len(fixed) < 40 and sum(s.ends for s in fixed) == 300
    assert all(s.passes == s.ends + sum(s.counts.values()) for s in fixed)
    assert all(id(t) in {id(x) for x in fixed} for s in fixed for t in s.moves.values())
    assert len(automata.infer([token(rng, 32) for _ in range(300)])) <= 4


def test_held_out_formats():
    """Unseen credentials of learned formats are found, unseen ordinary strings are not."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["con", "sider", "ation", "ly", "inter", "change", "able", "ment"]) for _ in range(4))
    number = lambda: rng.choice([token(rng, 16, "0123456789"), f"10.0.{rng.randrange(256)}.{rng.randrange(256)}/8080"])
    formats = Formats({"assign": [token(rng, 40) for _ in range(200)], "access": ["AKIA" + token(rng, 16, UPPER) for _ in range(200)],
                       "word": [word() for _ in range(200)], "number": [number() for _ in range(200)]})
    secret = np.array(formats.scores([token(rng, 22) for _ in range(300)] + ["AKIA" + token(rng, 15, UPPER) for _ in range(300)]))
    plain = np.array(formats.scores([word() for _ in range(300)] + [number() for _ in range(300)]))
    assert (secret >= secret_scan.LEAST_SCORE).mean() > 0.95 and (plain >= secret_scan.LEAST_SCORE).mean() < 0.01


def test_unlabelled_secrets_are_added(spark):
    rng = random.Random(6)
    bare = token(rng, 22)
    df = credential_docs(spark).union(spark.createDataFrame([(999, f"see {bare}, consideration")], "doc_id long, text string"))
    found = {r.doc_id: r.spans for r in find_secrets(df).collect()}
    assert [(s.kind, s.start, s.end) for s in found[999]] == [("format", 4, 26)] and found[999][0].score >= secret_scan.LEAST_SCORE
    assert sum(s.kind == "format" for spans in found.values() for s in spans) <= 3


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    formats = learn_formats(df.select("text"))
    rows = {r.doc_id: r.text for r in df.collect()}
    found = span_digests(find_secrets(df)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == plain_row(rows[r.doc_id])
        spans = scan([rows[r.doc_id] or ""], formats)[0]
        assert r.spans == ",".join(f"{[*secret_scan.KINDS, 'format'][k]}:{s}:{e}" for s, k, e, _, _ in spans)
        assert r.n_format == sum(k == 3 for _, k, _, _, _ in spans)


def test_sample_does_not_depend_on_the_split(spark):
    df = credential_docs(spark).select("text")
    a, b = learn_formats(df.repartition(1)), learn_formats(df.repartition(7))
    assert a.kinds == 3 and np.array_equal(a.automata.logs, b.automata.logs) and np.array_equal(a.automata.moves, b.automata.moves)


def test_awkward_rows(spark):
    df = awkward_docs(spark).withColumn("spans", F.lit(1)).withColumn("kind", F.lit("clash"))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in span_digests(find_secrets(df)).collect())
    assert got == sorted((r.doc_id is None, r.doc_id or 0, *plain_row(r.text)) for r in df.collect())
    assert find_secrets(empty_docs(spark)).collect() == []
    long = spark.createDataFrame([(1, "a1" * 500_000), (2, "token=" + "é" * 9)], "doc_id long, text string")
    assert [r.n_hex for r in span_digests(find_secrets(long)).orderBy("doc_id").collect()] == [1, 0]
