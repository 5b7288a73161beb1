"""Token counts and BPE coding against the tokenizers library itself."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from pricenet.llm import bpe, minhash_forest, token_count
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm.helpers import AWKWARD, awkward_docs, empty_docs

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")


def digests(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    decoded = tokenizer.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


def fuzz(seed, n=400):
    rng = random.Random(seed)
    alphabet = list("ab zZ'st  \n\t.,-12½²ÀéßİΣσǅŉ́​\xa0\x85\x1c　日한👩ªº") + ["<|endoftext|>", " the", " and", "n't"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_whole_table_token_counts(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    t = Tokenizer.from_file(BYTE)
    got = {r.doc_id: r for r in token_count.count_tokens(docs, BYTE).collect()}
    want = pq.read_table(f"{SF_CHECK}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert len(got) == len(want)
    for w in want:
        n = len(t.encode(w["text"], add_special_tokens=False).ids)
        r = got[w["doc_id"]]
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(w["text"].encode()), n > 512)


def test_whole_table_codes(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    t = Tokenizer.from_file(WORD)
    got = {r.doc_id: tuple(r)[1:] for r in bpe.encode_digests(docs, WORD).collect()}
    for w in pq.read_table(f"{SF_CHECK}/documents.parquet", columns=["doc_id", "text"]).to_pylist():
        assert got[w["doc_id"]] == digests(t, w["text"])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fuzzed_texts(seed):
    with open(WORD) as f:
        codec = bpe.Codec(f.read())
    with open(BYTE) as f:
        counts = token_count.Counts(f.read())
    t, b = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    texts = fuzz(seed) + [x or "" for x in AWKWARD]
    for text, ids in zip(texts, codec.encode(texts)):
        want = t.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, dtype="<u4").tolist() == want, text
        assert codec.decode(ids) == t.decode(want, skip_special_tokens=False)
    assert counts.counts(texts, {}) == [len(b.encode(x, add_special_tokens=False).ids) for x in texts]


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 50)
    monkeypatch.setattr(token_count, "PIECE", 50)
    with open(WORD) as f:
        codec = bpe.Codec(f.read())
    with open(BYTE) as f:
        counts = token_count.Counts(f.read())
    t, b = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    for text in ["ab cd. " * 100, " " * 300, "x" * 400, "a \n b  c " * 60, "a <|endoftext|> b " * 40]:
        assert codec.digests(text) == digests(t, text)
        assert counts.counts([text], {}) == [len(b.encode(text, add_special_tokens=False).ids)]


def test_long_words_match_rows():
    with open(WORD) as f:
        merges = bpe.Codec(f.read()).merges
    rng = random.Random(5)
    words = {bytes(rng.choice(b"abethinors") for _ in range(rng.randrange(1, 90))) for _ in range(300)}
    rows = merges.encode(words)
    assert all(merges.encode_long(w) == rows[w] for w in words)


def test_caches_stay_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "HELD", 50)
    monkeypatch.setattr(token_count, "HELD", 50)
    with open(WORD) as f:
        codec = bpe.Codec(f.read())
    t = Tokenizer.from_file(WORD)
    for k in range(6):
        texts = [f"w{k}{i} the word" for i in range(40)]
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in codec.encode(texts)] == \
            [t.encode(x, add_special_tokens=False).ids for x in texts]
        assert len(codec.held) <= 50 + 42


def test_long_words_are_not_held():
    with open(WORD) as f:
        codec = bpe.Codec(f.read())
    with open(BYTE) as f:
        counts = token_count.Counts(f.read())
    shingler = minhash_forest.Shingler(3)
    t, b = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    rng = random.Random(4)
    for _ in range(60):
        text = "one " + "".join(rng.choice("abcdefgh") for _ in range(9000)) + " two"
        assert np.frombuffer(codec.encode([text])[0], dtype="<u4").tolist() == t.encode(text, add_special_tokens=False).ids
        assert counts.counts([text], {}) == [len(b.encode(text, add_special_tokens=False).ids)]
        assert len(shingler.sets([text.encode()])[0]) == 1
    for held in (codec.held, counts.held, shingler.held):
        assert 2 <= len(held) <= 3 and max(map(len, held)) <= 64


def test_indented_code_goes_through_the_tiers(monkeypatch):
    with open(BYTE) as f:
        counts = token_count.Counts(f.read())
    b = Tokenizer.from_file(BYTE)
    monkeypatch.setattr(counts, "whole", None)
    code = "def f(x):\n    if x:\n        return  x\n\n\n    \treturn 0  \n\u3000 y\x1c  \x1c z   "
    rng = random.Random(8)
    mixed = ["".join(rng.choice(["a", "b1", " ", " ", "\n", "\t", "\xa0", "\x1c", "\x85", "\u2003", "'s", "."])
                     for _ in range(60)) for _ in range(400)]
    for texts in ([code], [code * 30], mixed):
        assert counts.counts(texts, {}) == [len(b.encode(x, add_special_tokens=False).ids) for x in texts]


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    t, b = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    want = sorted((str(r.doc_id), digests(t, r.text)) for r in docs.collect())
    assert sorted((str(r.doc_id), tuple(r)[1:]) for r in bpe.encode_digests(docs, WORD).collect()) == want
    counted = token_count.count_tokens(docs, BYTE)
    assert counted.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted((str(r.doc_id), r.n_tokens) for r in counted.collect()) == sorted(
        (str(r.doc_id), len(b.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    full = bpe.encode(docs, WORD).where("doc_id = 6").first()
    assert full.decoded == t.decode(full.ids, skip_special_tokens=False)


def test_empty_table(spark):
    assert bpe.encode_digests(empty_docs(spark), WORD).count() == 0
    assert bpe.encode(empty_docs(spark), WORD).count() == 0
    assert token_count.count_tokens(empty_docs(spark), BYTE).count() == 0


def test_over_limit_edge(spark):
    docs = spark.createDataFrame([(1, "a" + " a" * 511), (2, "a" + " a" * 512)], "doc_id long, text string")
    got = {r.doc_id: (r.n_tokens, r.over_limit) for r in token_count.count_tokens(docs, BYTE).collect()}
    assert got == {1: (512, False), 2: (513, True)}


def test_reads_the_small_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert token_count.count_tokens(docs, BYTE).count() == docs.count()
