"""One analysis run as a lazily built set of DataFrames.

``Analysis`` wires the operators: observations -> features -> similarity ->
threshold networks -> paths -> centralities -> scores.  Each table is built
on first use and shared by everything downstream, so a run is one plan over
all (year, category) networks, not a loop over slices.  Tables reused by
several consumers are written once to the checkpoint folder; iterative
stages write every round there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricenet.functions.validation import DEFAULT_METRIC_WEIGHTS, check_roster, check_tau
from pricenet.operators import centrality as C
from pricenet.operators import components as K
from pricenet.operators import graph as N
from pricenet.operators import paths as P
from pricenet.operators import scoring as W
from pricenet.operators import vectors as V
from pricenet.operators.eigen import eigenvector
from pricenet.session import GROUP, cut_lineage


class Analysis:
    def __init__(self, observations: DataFrame, cities: Sequence[str], tau: float = 0.75,
                 weighted: bool = False, years: Sequence[int] | None = None,
                 categories: Sequence[str] | None = None,
                 category_weights: Mapping[str, float] | None = None,
                 interactive_weights: Mapping[str, float] | None = None):
        self.cities = check_roster(cities)
        self.n = len(self.cities)
        self.tau = check_tau(tau)
        self.weighted = weighted
        self.category_weights = dict(category_weights or {})
        self.interactive_weights = dict(interactive_weights or DEFAULT_METRIC_WEIGHTS)
        obs = observations
        if years is not None:
            obs = obs.where(F.col("year").isin(list(years)))
        if categories is not None:
            obs = obs.where(F.col("category").isin(list(categories)))
        self.observations = obs

    def _keep(self, df: DataFrame) -> DataFrame:
        """Materialise a table shared by many consumers.

        Written to the reliable checkpoint folder: later plans start from a
        compact scan instead of re-planning (and after an executor loss
        re-running) the whole lineage behind it.
        """
        return cut_lineage(df)

    # ------------------------------------------------------------ vectors
    @cached_property
    def features(self) -> DataFrame:
        return V.features(self.observations)

    @cached_property
    def groups(self) -> DataFrame:
        return self._keep(V.slice_groups(self.observations))

    @cached_property
    def roster_features(self) -> DataFrame:
        return V.roster_features(self.features, self.cities)

    @cached_property
    def pairs(self) -> DataFrame:
        return self._keep(V.cosine_pairs(self.roster_features))

    # ------------------------------------------------------------ networks
    @cached_property
    def all_edges(self) -> DataFrame:
        # Where all similarities are at hand, or a zero makes an edge, they are filtered; else only
        # pairs that can reach tau are compared.
        if self.tau == 0 or "pairs" in self.__dict__:
            return N.threshold_edges(self.pairs, self.tau, self.weighted, self.groups, self.cities)
        return N.threshold_edges(V.similar_pairs(self.roster_features, self.tau), self.tau, self.weighted)

    @cached_property
    def metadata(self) -> DataFrame:
        """N5 for every slice with data (zero-edge ones included)."""
        return N.network_metadata(self.groups, self.all_edges, self.n, self.tau, self.weighted)

    @cached_property
    def networks(self) -> DataFrame:
        """Networks with edges."""
        return self._keep(N.nonempty(self.metadata))

    @cached_property
    def edges(self) -> DataFrame:
        return self._keep(self.all_edges)

    @cached_property
    def nodes(self) -> DataFrame:
        return N.network_nodes(self.networks.select(*GROUP), self.cities)

    @cached_property
    def degrees(self) -> DataFrame:
        return N.degree_table(self.nodes, self.edges)

    @cached_property
    def stats(self) -> DataFrame:
        return N.network_stats(self.networks, self.degrees)

    @cached_property
    def local_clustering(self) -> DataFrame:
        return N.local_clustering(self.nodes, self.edges)

    @cached_property
    def network_statistics(self) -> DataFrame:
        """N7-N10 as one row per network: size, degrees, components, clustering, paths."""
        return (self.stats.join(self.clustering, GROUP, "left")
                .join(self.path_metrics, GROUP, "left")
                .withColumn("num_components", F.col("num_components").cast("long")))

    @cached_property
    def clustering(self) -> DataFrame:
        return N.average_clustering(self.local_clustering)

    # ------------------------------------------------------------ paths
    @cached_property
    def paths(self) -> P.ShortestPaths:
        return P.shortest_paths(self.nodes, self.edges)

    @cached_property
    def path_summary(self) -> DataFrame:
        """Per-node reach and distance summary: of the paths where they are at hand, else without any pair of nodes."""
        if "paths" in self.__dict__:
            return self._keep(P.path_summary(self.paths))
        return self._keep(P.reach_summary(self.nodes, self.edges))

    @cached_property
    def components(self) -> DataFrame:
        return self._keep(K.components(self.nodes, self.edges))

    @cached_property
    def component_counts(self) -> DataFrame:
        return K.component_counts(self.components)

    @cached_property
    def path_metrics(self) -> DataFrame:
        return P.path_metrics_from_summary(self.path_summary, self.component_counts, self.n)

    # ------------------------------------------------------------ centrality
    @cached_property
    def degree_centrality(self) -> DataFrame:
        return C.degree_centrality(self.degrees, self.n)

    @cached_property
    def closeness(self) -> DataFrame:
        return P.closeness_from_summary(self.path_summary, self.n)

    @cached_property
    def betweenness(self) -> DataFrame:
        if self.n > P.BATCH_SOURCES:
            return P.betweenness_by_batches(self.nodes, self.edges, self.n)
        return P.betweenness(self.nodes, self.edges, self.paths, self.n)

    @cached_property
    def eigenvector(self) -> DataFrame:
        return self._keep(eigenvector(self.nodes, self.edges, self.networks))

    @cached_property
    def centrality(self) -> DataFrame:
        # Betweenness first: where it searches all paths, closeness needs no search of its own.
        betweenness = self.betweenness
        return self._keep(C.centrality_table(self.nodes, self.degree_centrality, self.closeness,
                                             betweenness, self.eigenvector))

    # ------------------------------------------------------------ scores
    @cached_property
    def scores(self) -> DataFrame:
        return self._keep(W.scores_all(self.centrality, self.category_weights,
                                       self.interactive_weights))

    @cached_property
    def year_scores(self) -> DataFrame:
        """W9 roll-up, unsorted (ranking consumers order it themselves)."""
        return W.scores_by_year(self.scores, sort=False)

    # ------------------------------------------------------------ evolution
    @cached_property
    def evolution(self) -> DataFrame:
        """Nodes, Edges, Density, Clustering, Components, IsConnected.

        Unsorted; :func:`pricenet.plans.job.run_full_analysis` returns it
        ordered by (year, category).
        """
        return (self.networks.select(*GROUP, "num_nodes", "num_edges", "density")
                .join(self.clustering, GROUP, "left")
                .join(self.component_counts, GROUP, "left")
                .select(*GROUP,
                        F.col("num_nodes").alias("nodes"),
                        F.col("num_edges").alias("edges"),
                        "density",
                        F.coalesce("clustering", F.lit(0.0)).alias("clustering"),
                        F.col("num_components").cast("long").alias("components"),
                        "is_connected"))
