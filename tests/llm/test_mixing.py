"""Mixing against its DuckDB query and a round-by-round water-filling."""

import duckdb
import pytest

from pricenet.llm import mixing, queries
from tests.conftest import SF_CHECK
from tests.llm.helpers import awkward_docs, empty_docs
from tools.check_oracles import rows_of


def fill_by_rounds(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    """Share by weight, clamp, redistribute the excess, repeat until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, total = {}, share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in target]
        left = total - sum(target.values())
        share_of = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share_of[s] >= epochs * sizes[s]]
        if not over:
            return target | share_of
        target |= {s: float(epochs * sizes[s]) for s in over}
        if len(target) == len(names):
            return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 10, None: 5}, {"a": 0, "b": 7},
    {"only": 10}, {f"s{i:02d}": (i * 37) % 101 + 1 for i in range(40)},
])
def test_targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(table).collect()}
    want = fill_by_rounds(sizes)
    assert got.keys() == want.keys()
    assert all(got[s] == pytest.approx(want[s]) for s in want)


def test_matches_sql_on_the_whole_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_CHECK}/documents.parquet')")
    df = queries.op4_source_mix(spark, SF_CHECK)
    res = con.execute(queries.ORACLES["op4_source_mix"])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())


def test_taken_words_meet_the_targets(spark):
    rows = queries.op4_source_mix(spark, SF_CHECK).collect()
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        taken, _ = by.get(r.source, (0, 0))
        by[r.source] = (taken + r.taken, r.target)
    assert all(abs(taken - target) <= 1 for taken, target in by.values())


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    first = sorted(map(str, mixing.mix(docs).collect()))
    assert first == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    assert len(first) == docs.count()
    assert mixing.mix(empty_docs(spark)).count() == 0
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixing.mixed_documents(empty_docs(spark)).count() == 0


def test_other_seeds_choose_other_documents(spark):
    docs = spark.createDataFrame([(i, "w " * 10, f"s{i % 2}") for i in range(200)], "doc_id long, text string, source string")
    one = {r.doc_id: r.taken for r in mixing.mix(docs, share=1.0).collect()}
    two = {r.doc_id: r.taken for r in mixing.mix(docs, share=1.0, seed="other").collect()}
    assert sum(one.values()) == sum(two.values()) == 2000 and one != two


def test_mixed_documents_repeat_rows(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "ab"[i % 2]) for i in range(100)], "doc_id long, text string, source string")
    plan = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    got = {}
    for r in mixing.mixed_documents(docs).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 10
    assert all(abs(got.get(i, 0) - plan[i]) <= 5 for i in plan)


@pytest.mark.parametrize("id_of", [lambda i: i % 50, lambda i: None if i < 40 else i, lambda i: None, lambda i: 7])
def test_rows_are_decided_by_themselves(spark, id_of):
    """Repeated and null ids over several sources: every source meets its target within one document."""
    docs = spark.createDataFrame([(id_of(i), f"w{i} " * 10, "abc"[i % 3], i) for i in range(240)],
                                 "doc_id long, text string, source string, row long")
    plan = mixing.mix(docs).collect()
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and len(plan) == 240
    targets = {r.source: r.target for r in plan}
    for source, target in targets.items():
        assert abs(sum(r.taken for r in plan if r.source == source) - target) <= 1
        assert abs(sum(10 for r in mixed.collect() if r.source == source) - target) <= 10
    times = {}
    for r in mixed.collect():
        times[r.row] = times.get(r.row, 0) + 1
    assert max(times.values()) <= 2
