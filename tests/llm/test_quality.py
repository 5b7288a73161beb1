"""Quality classifier: held-out accuracy, determinism and edge rows."""

import math
import zlib

import pytest
import zstandard

from pricenet.llm import quality, queries
from tests.llm.helpers import awkward_docs, empty_docs

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in queries.op1_compression_quality(spark, SF).collect()}


@pytest.fixture(scope="module")
def truth(spark):
    return {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_held_out_split(scored):
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in scored.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in scored.values())


def test_held_out_ranking_and_accuracy(scored, truth):
    rows = [(scored[i].score, y, scored[i].predicted) for i, y in truth.items() if scored[i].held_out]
    good, bad = [s for s, y, _ in rows if y == 1], [s for s, y, _ in rows if y == 0]
    above = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert above > 0.99
    assert sum(p == y for _, y, p in rows) / len(rows) > 0.98
    assert sum(p for _, y, p in rows if y == 1) / len(good) > 0.98


def test_scores_are_calibrated(scored, truth):
    rows = [(scored[i].score, y) for i, y in truth.items() if scored[i].held_out]
    assert abs(sum(s for s, _ in rows) / len(rows) - sum(y for _, y in rows) / len(rows)) < 0.08


def small(spark, labelled):
    docs = spark.createDataFrame([(i, ("good words here. " if i % 2 else "### !!! $$$ ") * 20) for i in range(60)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60) if labelled(i)], "doc_id long, quality int")
    return docs, labels


def test_held_out_labels_change_nothing(spark):
    docs, labels = small(spark, lambda i: True)
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - quality, quality) as quality")
    one = sorted(map(tuple, quality.score_quality(docs, labels).collect()))
    assert one == sorted(map(tuple, quality.score_quality(docs.repartition(5), flipped).collect()))
    assert {r[3] for r in one if r[0] % 2} == {1} and {r[3] for r in one if not r[0] % 2} == {0}


@pytest.mark.parametrize("labelled", [lambda i: False, lambda i: i % 2 == 1, lambda i: i % 2 == 0])
def test_missing_classes(spark, labelled):
    docs, labels = small(spark, labelled)
    scores = {r.score for r in quality.score_quality(docs, labels).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 1


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (6, 1), (18, 0), (9, 1), (4, 1), (999, 1)],
                                   "doc_id long, quality int")
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    same = {r.score for r in rows if r.doc_id in (20, 21)}
    assert len(same) == 1
    assert quality.score_quality(empty_docs(spark), labels).count() == 0
    assert quality.score_quality(docs, labels.limit(0)).count() == docs.count()
    kept = quality.keep_good(docs, labels, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))


def test_keep_good_follows_the_scores(spark):
    docs, labels = small(spark, lambda i: True)
    want = {r.doc_id for r in quality.score_quality(docs, labels).collect() if r.predicted}
    assert {r.doc_id for r in quality.keep_good(docs, labels).collect()} == want


def test_scores_by_plain_compression(spark):
    """Every score from the fitted dictionaries and weights, block by block, without the operator's code."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 400"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels)
    sizes = {}
    for name, content in (("good", model.good), ("bad", model.bad)):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        c = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
        sizes[name] = lambda text, c=c: sum(len(c.compress(text[i:i + 1024])) for i in range(0, len(text), 1024))
    scores = {r.doc_id: r.score for r in quality.score_quality(docs, labels).collect()}
    assert len(scores) == docs.count()
    for r in docs.collect():
        text = (r.text or "").encode()
        x = 100 * (sizes["bad"](text) - sizes["good"](text)) / max(1, len(text))
        short = 64 / (64 + len(text))
        z = x * model.weights[0] + short * model.weights[1] + x * short * model.weights[2] + model.weights[3]
        assert abs(scores[r.doc_id] - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-9


def test_dictionaries_hold_all_parts_of_texts():
    text = b"".join(b"%06d" % k for k in range(4000))
    kept = quality.spread(text, 2048)
    assert len(kept) == 2048 and kept[:6] == text[:6] and kept[-6:] == text[-6:]
    places = [text.index(kept[at:at + 250]) for at in range(0, 2048, 256)]
    assert all(a < b for a, b in zip(places, places[1:])) and max(b - a for a, b in zip(places, places[1:])) < len(text) / 6
    assert quality.spread(b"short", 100) == b"short" and quality.spread(text, 10) == text[:10] and quality.spread(text, 0) == b""


def test_long_texts_teach(spark):
    docs = spark.createDataFrame([(i, ("good words here. " if i % 2 else "### !!! $$$ ") * 4000) for i in range(40)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    assert {(r.doc_id % 2, r.predicted) for r in quality.score_quality(docs, labels).collect()} == {(0, 0), (1, 1)}
