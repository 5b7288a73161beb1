"""License scans against a brute-force reading of the words."""

import re

import pytest

from pricenet.llm import licenses
from tests.conftest import SF_CHECK
from tests.llm.helpers import awkward_docs, empty_docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def brute(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lowered)
    hits = [(i, label) for i in range(len(words)) for p, label in PHRASES.items() if tuple(words[i:i + len(p)]) == p]
    return (len(words), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None),
            ",".join(sorted({label for _, label in hits})))


def compare(docs):
    got = sorted((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                 for r in licenses.scan_licenses(docs).collect())
    want = sorted((str(r.doc_id), *brute(r.text)) for r in docs.collect())
    key = lambda rows: sorted(map(repr, rows))
    assert key(got) == key(want)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    compare(docs)
    rows = licenses.scan_licenses(docs).collect()
    assert any(r.n_base for r in rows)
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_awkward_rows(spark):
    compare(awkward_docs(spark))
    assert licenses.scan_licenses(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("expression, labels, freedom", [
    ("mit", {"mit"}, 1.0),
    ("mit or gpl-2.0-only", {"mit", "gpl"}, 1.0),
    ("mit and gpl-2.0-only", {"mit", "gpl"}, 0.2),
    ("gpl-2.0-only or mit and mpl-2.0", {"mit", "gpl", "mpl"}, 0.6),
    ("(gpl-2.0-only or mit) and mpl-2.0", {"mit", "gpl", "mpl"}, 0.6),
    ("(gpl-3.0 or cc-by-nc-4.0) and apache-2.0", {"gpl", "cc-by-nc", "apache"}, 0.2),
    ("gpl-2.0-or-later with classpath-exception-2.0", {"gpl"}, pytest.approx(0.3)),
    ("((mit)", {"mit"}, 1.0),
    ("or or", set(), licenses.UNKNOWN_FREEDOM),
])
def test_expressions(expression, labels, freedom):
    terms = licenses.evaluate(expression)
    assert (terms.labels, terms.freedom) == (labels, freedom)


def test_postfix_order():
    assert licenses.to_postfix("a or b and c with d".split()) == ["a", "b", "c", "d", "with", "and", "or"]
    assert licenses.to_postfix(["(", "a", "or", "b", ")", "and", "c"]) == ["a", "b", "or", "c", "and"]
    assert licenses.to_postfix(["a", "b"]) is None and licenses.to_postfix([")"]) is None


def test_tags_and_notices():
    scan = licenses.Scanner().scan
    row = scan(b"# SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND CC-BY-4.0\ncode")
    assert row[4:6] == ("", "cc-by,gpl,mit") and row[7] == 0.8
    assert scan(b"// SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception */ int x;")[5] == "apache"
    assert scan("Licensed under CC BY-NC 4.0.".encode())[5] == "cc-by,cc-by-nc"
    row = scan(b"MIT license. Apache License! GENERAL (public) license mit\nlicense")
    assert row[:6] == (9, 4, 0, 7, "apache,gpl,mit", "apache,gpl,mit")
    assert scan(b"mitlicense mit licenses commit license")[1] == 0
    assert scan(("x " * 100_000 + "mit license").encode())[:4] == (100_002, 1, 100_000, 100_000)


@pytest.mark.parametrize("tag", [
    b'license-expression = "MIT OR Apache-2.0"', b"license-expression='MIT OR Apache-2.0'", b'"license-expression": "MIT OR Apache-2.0", "x": 1',
    b"SPDX-License-Identifier: 'MIT OR Apache-2.0'", b"spdx-license-identifier:MIT OR Apache-2.0", b"License-Expression=MIT or Apache-2.0 # why",
])
def test_quoted_tags(tag):
    row = licenses.Scanner().scan(b"first line\n" + tag + b"\nGPL-2.0 is on the next line")
    assert row[5] == "apache,mit" and row[6] >= 0.95


def test_tags_without_an_expression():
    for text in (b"SPDX-License-Identifier", b"license-expression is a key", b'license-expression = ""', b"license-expression:"):
        assert licenses.Scanner().scan(text)[5:7] == ("", 0.0)
