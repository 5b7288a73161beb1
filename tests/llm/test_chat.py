"""Chat formatting against brute force and its DuckDB query."""

import random

import duckdb

from pricenet.llm import chat, queries
from tests.conftest import SF_CHECK
from tools.check_oracles import rows_of

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, t, r, x in set(rows):
        convs.setdefault(c, []).append((t, r, x))
    last = lambda v: (v is None, v)
    turns = {c: tuple((r, x) for _, r, x in sorted(v, key=lambda q: tuple(map(last, q)))) for c, v in convs.items()}
    shorter = {s[:k] for s in turns.values() for k in range(1, len(s))}
    out = {}
    for c, s in turns.items():
        if s not in shorter:
            ids, n = out.get(s, ((True, 0), 0))
            out[s] = (min(ids, last(c) if c is not None else (True, 0)) if n else (last(c) if c is not None else (True, 0)), n + 1)
    return sorted((repr(None if i[0] else i[1]), len(s), n,
                   "".join(f"<|{r or 'unknown'}|>\n{x or ''}<|end|>\n" for r, x in s)) for s, (i, n) in out.items())


def got(df):
    rows = df.collect()
    assert all(r.n_chars == len(r.text) for r in rows)
    return sorted((repr(r.conv_id), r.n_turns, r.n_copies, r.text) for r in rows)


def test_matches_sql_on_the_whole_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF_CHECK}/conversations.parquet')")
    df = queries.op5_chat_format(spark, SF_CHECK)
    res = con.execute(queries.ORACLES["op5_chat_format"])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in res.description], res.fetchall())


def test_snapshots_copies_and_ties(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (3, 5, "user", "hi"), (3, 9, "assistant", "yo"),
            (4, 0, "user", "hi"), (4, 1, "assistant", "other"), (5, 0, None, "hi"), (6, 0, "user", None), (7, 0, "user", ""),
            (8, None, "user", "z"), (8, 0, "system", "first"), (None, 0, "user", "lost"), (9, 0, "user", "tie"), (9, 0, "user", "a tie"),
            (9, 0, "user", "tie")]
    df = chat.format_chats(spark.createDataFrame(rows, SCHEMA))
    assert got(df) == brute(rows)
    by = {r.conv_id: r for r in df.collect()}
    assert 1 not in by and by[2].n_copies == 2 and 3 not in by and by[9].n_turns == 2


def test_random_logs_with_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "SPAN", 4)
    rng = random.Random(3)
    rows = []
    for c in range(120):
        start = rng.choice([0, 1, 7])
        for t in range(rng.randrange(1, 14)):
            rows.append((c, start + t, ["user", "assistant"][t % 2], rng.choice("ab") if t > 1 else "same"))
    assert got(chat.format_chats(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_long_conversations_without_turn_numbers(spark):
    """A null id whose turn numbers repeat and equal or null numbers in a snapshot: far more turns than a span of numbers."""
    n, cut = 100_000, 80_000
    text = "concat('t', lpad(id, 6, '0'))"
    long_ = spark.range(n).selectExpr("cast(null as long) conv_id", "id % 3 turn", "'user' role", f"{text} text")
    whole = spark.range(n).selectExpr("7L conv_id", "cast(null as long) turn", "'user' role", f"{text} text")
    start = spark.range(cut).selectExpr("8L conv_id", "0L turn", "'user' role", f"{text} text")
    other = spark.range(cut).selectExpr("9L conv_id", "0L turn", "'user' role", f"if(id = {cut - 1}, 'u', {text}) text")
    df = chat.format_chats(long_.union(whole).union(start).union(other).repartition(4))
    texts = [f"t{i:06d}" for i in range(n)]
    rendered = lambda ts: "".join(f"<|user|>\n{t}<|end|>\n" for t in ts)
    assert got(df) == sorted([("None", n, 1, rendered(t for r in range(3) for t in texts[r::3])), ("7", n, 1, rendered(texts)),
                              ("9", cut, 1, rendered([*texts[:cut - 1], "u"]))])


def test_spans_hold_a_fixed_number_of_places(spark):
    turns = spark.range(50_000).selectExpr("'n' key", "cast(null as long) conv_id", "0L turn", "'user' role", "cast(id as string) text")
    placed = chat.placed_turns(turns)
    assert placed.selectExpr("min(pos)", "max(pos)", "count(distinct pos)", "min(n)").first()[:] == (1, 50_000, 50_000, 50_000)
    hashed = chat.prefix_hashes(turns)
    assert hashed.groupBy(chat.F.floor((chat.F.col("pos") - 1) / chat.SPAN)).count().selectExpr("max(count)").first()[0] == chat.SPAN


def test_native_plan(spark):
    plan = queries.op5_chat_format(spark, SF_CHECK)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.format_chats(empty).count() == 0
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "user", "b" * 100_000)]
    extra = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as key", "1 as n", "2 as pos", "3 as n_copies", "4 as h1")
    assert got(chat.format_chats(extra)) == brute(rows)
