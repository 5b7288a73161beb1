import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricenet.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", shuffle_partitions=8, app_name="pricenet-tests")
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="pricenet-test-")


def graph_frames(spark, networks):
    """networks: {(year, category): (cities, [(u, v), ...])} -> nodes, edges, meta."""
    from pyspark.sql import functions as F
    node_rows, edge_rows, meta_rows = [], [], []
    for (y, c), (cities, edges) in networks.items():
        for i, city in enumerate(cities):
            node_rows.append((y, c, i, city))
        canon = sorted({tuple(sorted(e)) for e in edges})
        for u, v in canon:
            edge_rows.append((y, c, u, v, 1.0, 1.0))
        meta_rows.append((y, c, len(cities), len(canon)))
    nodes = spark.createDataFrame(node_rows, "year int, category string, node_id int, city string")
    edges = spark.createDataFrame(edge_rows, "year int, category string, u string, v string, sim double, weight double")
    meta = spark.createDataFrame(meta_rows, "year int, category string, num_nodes long, num_edges long")
    return nodes, edges, meta
