"""Near-duplicates against all pairs on small tables, and components against union-find."""

import math
import random
import re

import pytest

from pricenet.llm import minhash_forest as M
from pricenet.llm import queries
from pricenet.llm.components import connected_components
from tests.conftest import SF_CHECK
from tests.llm.helpers import awkward_docs, empty_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def brute(rows, k, percent):
    """{id: (n, component)} for distinct ids, by all pairs that share a shingle."""
    sets = {i: shingles(t, k) for i, t in rows}
    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    pairs = {(a, b) for group in by.values() for a in group for b in group if a < b}
    links = [(a, b) for a, b in pairs
             if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = union_find(sets, links)
    return {i: (len(sets[i]), root[i]) for i in sets}


def check(df, want):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}
    assert got == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in df.collect())


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()]
    want = brute(rows, 3, 85)
    assert sum(i != c for i, (_, c) in want.items()) > 10
    check(queries.op3_minhash_forest(spark, SF_CHECK), want)


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_families_near_the_threshold(spark, k, percent):
    rng = random.Random(k)
    texts = []
    for f in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([30, 80, 200]))]
        texts += family(rng, base, rng.choice([2, 5, 40]), max(1, len(base) // 30))
    # A chain: each text differs a little more from the first one.
    words = [f"c{i}" for i in range(120)]
    for i in range(30):
        texts.append(" ".join(words))
        words[(7 * i) % 120] = f"chain{i}"
    texts += texts[:5] + ["two words", "Two  WORDS", "one"]
    rng.shuffle(texts)
    rows = [(100 + i * 3, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    check(M.near_duplicates(docs, k, percent), brute(rows, k, percent))


def test_large_regions_are_finished(spark, monkeypatch):
    """With regions of two compared at once, the exact step has to find the rest."""
    monkeypatch.setattr(M, "SMALL", 2)
    monkeypatch.setattr(M, "BLOCK", 20)
    monkeypatch.setattr(M, "COLUMNS", 64)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    # Few, some and many edits: linked to most, to the least edited ones, to none.
    rows = [(i, t) for i, t in enumerate(family(rng, base, 150, 3) + family(rng, base, 80, 9))]
    check(M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85), brute(rows, 3, 85))


def test_block_products():
    rng = random.Random(2)
    sets = [M.np.unique(M.np.array([rng.randrange(400) for _ in range(rng.randrange(1, 90))], dtype=M.np.uint64)) for _ in range(40)]
    got = M.overlaps(sets[:15], sets[15:])
    assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[15:]] for a in sets[:15]]
    chain = M.np.arange(99)
    assert not M.roots(chain + 1, chain, 100).any()


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = M.near_duplicates(docs, 3, 85).collect()
    assert len(rows) == docs.count()
    own = [(r.doc_id, r.text) for r in docs.where("doc_id is not null and doc_id not in (1, 3)").collect()]
    want = brute(own, 3, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id in want}
    assert got == want
    assert all(r.component_id == r.doc_id and r.kept for r in rows if r.n_shingles == 0)
    assert M.near_duplicates(empty_docs(spark), 3, 85).count() == 0
    assert M.near_duplicates(docs.where("text is null"), 3, 85).first().kept
    kept = M.keep_one(docs, k=3, percent=85)
    assert kept.columns == docs.columns
    assert kept.where("doc_id in (20, 21)").count() == 1


def groups_of(rows, k, percent):
    """Places of the rows of each group, by all pairs of rows; rows without words are groups of their own."""
    n = range(len(rows))
    sets = [shingles(t, k) for _, t in rows]
    root = union_find(n, [(a, b) for a in n for b in n if a < b and sets[a] and sets[b]
                          and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])])
    return [[q for q in n if root[q] == r] for r in sorted(set(root.values()))]


def test_keep_one_decides_by_row(spark):
    """Repeated rows, an id with several texts, null ids: one row of each group stays."""
    rng = random.Random(8)
    base = [[f"w{f}x{i}" for i in range(60)] for f in range(8)]
    text = lambda f, edit=0: " ".join(base[f] if not edit else [f"e{f}y{edit}", *base[f][1:]])
    rows = [(1, text(0)), (1, text(0)), (1, text(0).upper()), (2, text(0, 1)),
            (5, text(1)), (5, text(0, 2)), (5, text(2)), (6, text(2, 1)), (6, text(3)), (7, text(3, 1)),
            (None, ""), (None, None), (None, text(0)), (None, text(4)), (None, text(4)),
            (None, text(5)), (None, text(6)), (9, text(6)), (10, ""), (10, ""), (10, text(7)), (11, text(7, 1)), (12, " ")]
    rng.shuffle(rows)
    docs = (spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, at int")
            .selectExpr("*", "map('a', at) as `more.of`").repartition(5))
    kept = M.keep_one(docs, k=3, percent=80)
    assert kept.dtypes == docs.dtypes
    stay = sorted(r["at"] for r in kept.collect())
    groups = groups_of(rows, 3, 80)
    assert len(stay) == len(groups)
    last = lambda i: (i is None, i or 0)
    for group in groups:
        there = [q for q in group if q in stay]
        assert len(there) == 1 and rows[there[0]][0] == min((rows[q][0] for q in group), key=last)


def test_near_copies_without_an_id(spark, monkeypatch):
    """Null-id near copies of numbered documents and of each other, in small and in large regions."""
    monkeypatch.setattr(M, "SMALL", 2)
    monkeypatch.setattr(M, "BLOCK", 20)
    rng = random.Random(21)
    rows = []
    for f, (size, n, ids) in enumerate([(50, 2, [3]), (60, 2, []), (70, 60, [11, 14]), (80, 60, [])]):
        texts = family(rng, [f"w{f}x{i}" for i in range(size)], n, 2 if n == 2 else 5)
        rows += [(ids[q] if q < len(ids) else None, t) for q, t in enumerate(texts)]
    rng.shuffle(rows)
    want = []
    for group in groups_of(rows, 3, 85):
        least = min((rows[q][0] for q in group if rows[q][0] is not None), default=None)
        want += [(rows[q][0], len(shingles(rows[q][1], 3)), least, rows[q][0] == least) for q in group]
    assert sum(c is not None and i is None for i, _, c, _ in want) > 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(repr, (tuple(r) for r in M.near_duplicates(docs, 3, 85).collect()))) == sorted(map(repr, want))


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1300)]
    links += [(2000, 2000 + i) for i in range(1, 200)] + [(5, 5)]
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    want = union_find({x for e in links for x in e}, links)
    joined = {x for a, b in links if a != b for x in (a, b)}
    assert got == {n: want[n] for n in joined}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("percent", [80, 85])
def test_loss_at_the_threshold(percent):
    """No shared region, or too few equal values: together at most ``MISS``."""
    t = percent / 100
    size = M.DEPTH * M.trees_for(t)
    least = M.agreements_for(percent, size)
    dropped = sum(math.comb(size, k) * t ** k * (1 - t) ** (size - k) for k in range(least))
    assert (1 - t ** M.DEPTH) ** M.trees_for(t) + dropped <= M.MISS
    assert least > size * t / 2
