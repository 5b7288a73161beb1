"""Driver contract: entry smoke run and Spark-vs-DuckDB agreement."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from pricenet.plans import catalog
from tests.conftest import SF_SMALL
from tools.check_oracles import TABLES, rows_of

CHECKED = ["observations", "prep_categorize", "vector_dedup", "network_statistics", "edge_subset_swapped",
           "partial_order_broken", "prep_zscore", "cosine_pairs", "similarity_stats", "threshold_edges", "shortest_paths",
           "betweenness_centrality", "eigenvector_centrality", "centrality_all", "scores_all",
           "rankings", "compare_schemes", "containment_reduction", "containment_relation_turns", "overview_counts", "partial_order_check",
           "network_evolution", "report_summary"]


def test_contract_keys():
    """Every query of the analysis has SQL; SQL never names an unknown query."""
    assert set(catalog.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "rank", "city", "score_equal"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols) and srows
    assert rows_of(df.columns, srows) == rows_of(ocols, orows)
