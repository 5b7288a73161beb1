"""Connected components of all networks at once (N8), from edges alone.

Two rounds.  Every task first thins the edges it happens to hold to a spanning
forest of each network: an edge within a tree says nothing new.  What is left —
at most a task's nodes less one per network, however many edges there were — is
dealt by network, where union-find joins the forests.  A network's nodes are
the roster, so neither round holds more than the roster's nodes of a network,
and no round is repeated: a chain costs as much as a star.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricenet.session import GROUP


class UnionFind:
    """Trees of names; the root of a tree is its smallest name."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def root(self, name: str) -> str:
        parent = self.parent
        parent.setdefault(name, name)
        while parent[name] != name:
            parent[name] = parent[parent[name]]
            name = parent[name]
        return name

    def join(self, u: str, v: str) -> bool:
        """Whether the edge joins two trees."""
        a, b = self.root(u), self.root(v)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task that join trees of their network."""
    trees: dict[tuple, UnionFind] = {}
    for batch in batches:
        joins = [trees.setdefault((year, category), UnionFind()).join(u, v) for year, category, u, v in _rows(batch)]
        yield batch.filter(pa.array(joins, pa.bool_()))


def _labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges in order of their network -> the smallest name of every node's tree."""
    group, trees, schema = None, UnionFind(), None

    def named() -> pa.RecordBatch:
        names = list(trees.parent)
        columns = [[group[0]] * len(names), [group[1]] * len(names), names, [trees.root(x) for x in names]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                                          names=[*GROUP, "city", "component"])

    for batch in batches:
        schema = batch.schema
        for year, category, u, v in _rows(batch):
            if (year, category) != group:
                if group is not None:
                    yield named()
                group, trees = (year, category), UnionFind()
            trees.join(u, v)
    if group is not None:
        yield named()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes`` with ``component``, the smallest node name reachable."""
    kinds = dict(edges.dtypes)
    keys = ", ".join(f"{c} {kinds[c]}" for c in GROUP)
    forest = edges.select(*GROUP, "u", "v").mapInArrow(_forest, f"{keys}, u string, v string")
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    labels = (forest.repartition(parts, *GROUP).sortWithinPartitions(*GROUP)
              .mapInArrow(_labels, f"{keys}, city string, component string"))
    return (nodes.join(labels, [*GROUP, "city"], "left")
            .withColumn("component", F.coalesce("component", "city")))


def component_counts(comp: DataFrame) -> DataFrame:
    """Number of components and connectivity per network.

    A component is counted at the node that names it: no distinct count.
    """
    return comp.groupBy(*GROUP).agg(
        F.count_if(F.col("city") == F.col("component")).alias("num_components")).withColumn(
        "is_connected", F.col("num_components") == 1)
