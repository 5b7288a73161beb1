"""Incremental refresh (R1) equals a full recompute."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from pricenet.functions import moments as M
from pricenet.operators import scoring as W
from pricenet.plans.analysis import Analysis
from pricenet.sources import panel
from pricenet.streaming import refresh
from pricenet.streaming.refresh import Refresher
from tests.conftest import SF_SMALL


def test_refresh_matches_full_recompute(spark, tmpdir_path):
    raw = panel.raw_price_panel(spark, SF_SMALL).select(
        "city", "year", "category", "month_year", "item_description", "price")
    roster = panel.fixture_roster(spark, SF_SMALL)
    first = raw.where((F.col("year") <= 1997) | (F.col("category") == "ECONOMY"))
    second = raw.exceptAll(first)
    src = os.path.join(tmpdir_path, "incoming")
    out = os.path.join(tmpdir_path, "out")
    ck = os.path.join(tmpdir_path, "stream-ck")
    r = Refresher(roster, 0.2, out)
    first.write.mode("append").parquet(src)
    r.start(spark, src, ck).awaitTermination()
    eco_before = spark.read.parquet(os.path.join(out, "weighted_scores")).where("category = 'ECONOMY'")
    eco_before = {(x.year, x.city): x.score_equal for x in eco_before.collect()}
    second.write.mode("append").parquet(src)
    r.start(spark, src, ck).awaitTermination()

    got = r.current_scores(spark)
    assert got.count() == spark.read.parquet(os.path.join(out, "weighted_scores")).count()
    full = Analysis(panel.zscore(raw), roster, tau=0.2).scores
    key = ["year", "category", "city"]
    a = {tuple(x[k] for k in key): round(x.score_equal, 9) for x in got.collect()}
    b = {tuple(x[k] for k in key): round(x.score_equal, 9) for x in full.collect()}
    assert a == b
    eco_after = {(k[0], k[2]): v for k, v in a.items() if k[1] == "ECONOMY"}
    assert eco_after == {k: round(v, 9) for k, v in eco_before.items()}
    years = spark.read.parquet(os.path.join(out, "final_rankings"))
    expected = W.scores_by_year(full, sort=False)
    ya = {(x.year, x.city): round(x.score_equal, 9) for x in years.collect()}
    yb = {(x.year, x.city): round(x.score_equal, 9) for x in expected.collect()}
    assert ya == yb


def test_refresh_follows_lost_edges(spark, tmpdir_path):
    """A year and a whole category lose all their edges: every table on disk equals a full recompute."""
    src, out, ck = (os.path.join(tmpdir_path, x) for x in ("incoming", "out", "ck"))
    month = lambda y, m: f"{y}-{m:02d}"
    # Prices far apart once the third batch moves the means.
    first = [(c, y, cat, month(y, m), "rice", p) for cat in ("Food", "Fuel x/y") for y in (2020, 2021)
             for m, p in ((1, 10.0), (2, 12.0)) for c in "AB"]
    second = [("A", 2020, "Food", "2020-01", "rice", 99.0)]  # a revised price: the first one stays
    third = [(c, 2020, cat, month(2020, 3 + k), "rice", 11.0 + s * (400.0 + k)) for cat in ("Food", "Fuel x/y")
             for c, s in (("A", 1), ("B", -1)) for k in range(8)]
    third += [(c, 2021, "Fuel x/y", month(2021, 3 + k), "rice", 11.0 + s * (400.0 + k))
              for c, s in (("A", 1), ("B", -1)) for k in range(8)]
    schema = "city string, year int, category string, month_year string, item_description string, price double"
    r = Refresher(["A", "B"], 0.5, out)
    every = []
    for k, rows in enumerate((first, second + third)):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        r.start(spark, src, ck).awaitTermination()
        every += [(*x, k) for x in rows]
        if not k:
            assert {(x.category, x.year) for x in r.current_scores(spark).collect()} == {
                (c, y) for c in ("Food", "Fuel x/y") for y in (2020, 2021)}
    obs = panel.zscore(spark.createDataFrame(every, schema + ", ordinal int"))
    full = Analysis(obs, ["A", "B"], tau=0.5)
    want = {"network_metadata": full.metadata, "weighted_scores": full.scores, "network_evolution": full.evolution,
            "final_rankings": W.scores_by_year(full.scores, sort=False)}
    for name, table in want.items():
        got = refresh._read_or_none(spark, os.path.join(out, name))
        rows_of = lambda df: sorted(str([round(v, 9) if isinstance(v, float) else v for v in x])
                                    for x in df.select(*table.columns).collect())
        assert (rows_of(got) if got is not None else []) == rows_of(table), name
    left = {(x.category, x.year) for x in r.current_scores(spark).collect()}
    assert left == {("Food", 2021)}


def test_unreadable_table_is_an_error(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    assert refresh._read_or_none(spark, path) is None
    os.makedirs(path)
    with open(os.path.join(path, "part-0.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        refresh._read_or_none(spark, path).count()


PRICES = "city string, year int, category string, month_year string, item_description string, price double"


def tables_of(spark, out, names=("network_metadata", "weighted_scores", "network_evolution", "final_rankings")):
    got = {}
    for name in names:
        df = refresh._read_or_none(spark, os.path.join(out, name))
        got[name] = [] if df is None else sorted(
            str([round(v, 9) if isinstance(v, float) else v for v in x]) for x in df.select(*sorted(df.columns)).collect())
    return got


def wanted(spark, rows, cities, tau):
    full = Analysis(panel.zscore(spark.createDataFrame(rows, PRICES + ", ordinal int")), cities, tau=tau)
    tables = {"network_metadata": full.metadata, "weighted_scores": full.scores, "network_evolution": full.evolution,
              "final_rankings": W.scores_by_year(full.scores, sort=False)}
    return {name: sorted(str([round(v, 9) if isinstance(v, float) else v for v in x]) for x in df.select(*sorted(df.columns)).collect())
            for name, df in tables.items()}


def random_prices(seed, categories, n=60):
    rng = random.Random(seed)
    return [(rng.choice("ABC"), rng.choice([2020, 2021]), rng.choice(categories), f"m{rng.randrange(6)}", rng.choice(["rice", "oil"]),
             rng.choice([None, round(rng.uniform(1, 9), 2)])) for _ in range(n)]


def test_batches_read_only_their_categories(spark, tmpdir_path):
    """State and history of other categories are pruned; a replayed batch changes nothing."""
    out = os.path.join(tmpdir_path, "out")
    r = Refresher(["A", "B", "C"], 0.1, out)
    batches = [random_prices(1, ["Food", "Fuel", None]), random_prices(2, ["Food"]), random_prices(3, ["Fuel", "Rent"])]
    every = []
    for k, rows in enumerate(batches):
        r.process(spark.createDataFrame(rows, PRICES).coalesce(1), k)
        every += [(*x, 1000 * k + i) for i, x in enumerate(rows)]
    want = wanted(spark, every, ["A", "B", "C"], 0.1)
    assert tables_of(spark, out) == want
    r.process(spark.createDataFrame(batches[2], PRICES).coalesce(1), 2)
    assert tables_of(spark, out) == want
    history = r.history(spark, ["Food"])
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*category#\d+ = Food", plan) and "DataFilters: []" in plan
    assert {f.split("category=")[1].split("/")[0] for f in
            (x.p for x in history.selectExpr("_metadata.file_path as p").distinct().collect())} == {"Food"}

    def versions():
        state = spark.read.schema(refresh.MOMENTS_SCHEMA).parquet(f"{out}/moments")
        return {(x.category, x.batch_id) for x in state.select("category", "batch_id").distinct().collect()}
    assert versions() == {("Food", 0), ("Food", 1), ("Fuel", 0), ("Fuel", 2), ("Rent", 2), (None, 0)}
    r.merge_moments(spark, 3, ["Food"])
    assert versions() >= {("Food", 1), ("Food", 3)} and ("Food", 0) not in versions()
    r.process(spark.createDataFrame([], PRICES), 4)
    assert tables_of(spark, out) == want


def test_merged_moments(spark):
    rows = [("a", x) for x in (1.0, 2.5, 4.0, -3.0, 1e6)] + [("b", 0.1)] * 7 + [(None, 2.0), (None, 5.0), ("c", None), ("d", 1.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    part = df.repartition(3).withColumn("part", F.spark_partition_id() % 3)
    state = M.moments(part.where("part = 0"), ["k"], "x")
    for i in (1, 2):
        state = M.merged(state, M.moments(part.where(f"part = {i}"), ["k"], "x"), ["k"])
    want = {r.k: r for r in M.moments(df, ["k"], "x").collect()}
    got = {r.k: r for r in state.collect()}
    assert got.keys() == want.keys() == {"a", "b", None, "d"}
    for k, r in got.items():
        assert (r.n, r.lo, r.hi) == (want[k].n, want[k].lo, want[k].hi)
        assert r["mean"] == pytest.approx(want[k]["mean"]) and r.m2 == pytest.approx(want[k].m2, abs=1e-9)
    z = {(r.k, r.x): r.z for r in M.zscored(df, state, ["k"], "x", "z").collect()}
    full = {(r.k, r.x): r.z for r in panel.zscore(df.where("k is not null"), "x", ["k"], "z").collect()}
    assert all(z[key] == pytest.approx(v) for key, v in full.items()) and z[("b", 0.1)] == 0.0 and z[("d", 1.0)] == 0.0


def test_csv_stream_is_bound_by_header(spark, tmpdir_path):
    src, out, ck = (os.path.join(tmpdir_path, x) for x in ("incoming", "out", "ck"))
    os.makedirs(src)
    r = Refresher(["A", "B", "C"], 0.1, out)
    every, names = [], ["city", "year", "category", "month_year", "item_description", "price"]
    for k in range(2):
        rows = random_prices(10 + k, ["Food", "Fuel"])
        order = names if k else ["price", "category", "Extra", "month_year", "city", "item_description", "year"]
        with open(os.path.join(src, f"{k}.csv"), "w") as f:
            f.write(",".join(order) + "\n")
            for x in rows:
                named = dict(zip(names, x)) | {"Extra": "x"}  # noqa: B905
                f.write(",".join("" if named[c] is None else str(named[c]) for c in order) + "\n")
            f.write(",".join("bad" for _ in order) + "\n")
        r.start(spark, src, ck, fmt="csv").awaitTermination()
        every += [(*x, 1000 * k + i) for i, x in enumerate(rows)]
    assert tables_of(spark, out) == wanted(spark, every, ["A", "B", "C"], 0.1)
    bad = spark.read.parquet(os.path.join(out, "rejected"))
    assert [x.reject_reason for x in bad.collect()] == ["year is no int: bad"] * 2
