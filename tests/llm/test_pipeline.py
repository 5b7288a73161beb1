"""The corpus pipeline: its stages against the operators, edge tables, and the registration guard."""

import subprocess
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from pricenet.llm import mixing, queries
from tests.conftest import SF_CHECK
from tests.llm.helpers import awkward_docs, empty_docs
from tests.llm.test_minhash import brute
from tests.llm.test_tokenizers import digests


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage over the whole table."""
    docs, out = spark.read.parquet(f"{SF_CHECK}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, SF_CHECK))
    return [*out, docs]


def test_registered():
    queries_now = E.queries()
    assert queries_now["pipeline"] is corpus_pipeline.run
    assert [sum(name.startswith(f"op{n}_") for name in queries_now) for n in range(1, 11)] == [1] * 10
    assert "pipeline" not in E.oracle_sql() and set(queries.ORACLES) <= set(E.oracle_sql())


def test_stages_keep_the_columns(stages):
    assert len({tuple(s.columns) for s in stages[:-1]}) == 1


def test_quality_stage_is_the_classifier(spark, stages):
    good = {r.doc_id for r in queries.op1_compression_quality(spark, SF_CHECK).collect() if r.predicted}
    assert {r.doc_id for r in stages[1].collect()} == good and 0 < len(good) < stages[0].count()


def test_dedup_stage_keeps_one_of_each_group(stages):
    groups = brute([(r.doc_id, r.text) for r in stages[1].collect()], 5, 80)
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(i for i, (_, c) in groups.items() if i == c)


def test_mix_and_codes(stages):
    plan = {r.doc_id: r for r in mixing.mix(stages[2]).collect()}
    mixed = stages[3].collect()
    times = {}
    for r in mixed:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    for i, r in plan.items():
        assert times.get(i, 0) == r.whole_reps + (r.extra_words > 0 and 2 * r.extra_words >= r.size)
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {r.doc_id: digests(t, r.text) for r in mixed}
    coded = [tuple(r) for r in stages[4].collect()]
    assert len(coded) == len(mixed) and all(want[i] == tuple(rest) for i, *rest in coded)


def test_stages_on_awkward_and_empty_tables(spark):
    for _, stage in corpus_pipeline.STAGES:
        docs = awkward_docs(spark)
        out = stage(spark, docs, SF_CHECK)
        assert out.count() <= 2 * docs.count()
        assert stage(spark, empty_docs(spark), SF_CHECK).count() == 0


def test_the_rest_works_without_this_subpackage(tmp_path):
    """Hidden from the importer, the operators and the pipeline leave the other queries as they are."""
    code = """
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "pricenet.llm"):
            raise ModuleNotFoundError(name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as E
names = set(E.queries())
assert "rankings" in names and not any(n.startswith("op1") or n == "pipeline" for n in names), names
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=E.__file__.rpartition("/")[0], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
