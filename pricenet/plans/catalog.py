"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (through the fixture panel) and runs
over the whole tables.  Double columns are rounded to 6 decimals for the
cross-engine check (the library functions themselves never round).
Analyses are cached per (session, directory, parameters) so the queries of
one run share materialised tables instead of rebuilding them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricenet.functions.exprs import rnd
from pricenet.operators import centrality as C
from pricenet.operators import feeds as G
from pricenet.operators import graph as N
from pricenet.operators import scoring as W
from pricenet.operators import temporal as TT
from pricenet.operators import vectors as V
from pricenet.plans import report as S
from pricenet.plans.analysis import Analysis
from pricenet.session import GROUP, cut_lineage, ensure_checkpoint_dir, run_folder
from pricenet.sources import panel

# Fixed query parameters.
TAU = 0.2
NESTED_TAUS = (0.75, 0.5, 0.3, 0.2)
# Thresholds of even and odd years, for year graphs of which some lie in others.
TURN_TAUS = (0.2, 0.75)
SLICE_YEAR, SLICE_CATEGORY = 1998, "ECONOMY"
RADAR_CITY, RADAR_YEAR = "NATION_1", 1998
SERIES_CATEGORY = "ECONOMY"
CATEGORY_WEIGHTS = {"STANDARD": 0.25, "SMALL": 0.35, "MEDIUM": 0.15, "LARGE": 0.15}
CUSTOM_WEIGHTS = {"D_i": 0.4, "C_i": 0.3, "B_i": 0.2, "E_i": 0.1}
INDUCED_N = 10
# Left without prices (S1) and without a lookup row.
UNPRICED_CATEGORY = "SMALL"
TOP_N = 10


# Raw prices are means of cent amounts over integer quantities, so their
# exact values often end in ...5 at a decimal place: two engines summing in
# different orders then round to different decimals.  They are compared as
# single precision instead — a binary midpoint is never hit by such values.
SINGLE = {"price"}


def finalize(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name in SINGLE:
            cols.append(F.col(f.name).cast("float").alias(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(rnd(f.name, digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


class Context:
    """Shared inputs of one (session, sf_dir)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        ensure_checkpoint_dir(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        self.obs = cut_lineage(panel.fixture_observations(spark, sf_dir))
        self.roster = panel.fixture_roster(spark, sf_dir)
        self._analyses: dict[tuple, Analysis] = {}
        self._brand_obs: DataFrame | None = None

    @property
    def brand_obs(self) -> DataFrame:
        """Panel at brand granularity (item = p_brand), materialised once."""
        if self._brand_obs is None:
            self._brand_obs = cut_lineage(panel.fixture_observations(self.spark, self.sf_dir, item_col="p_brand"))
        return self._brand_obs

    def analysis(self, tau: float = TAU, weighted: bool = False, **kw) -> Analysis:
        key = (tau, weighted, tuple(sorted((k, repr(v)) for k, v in kw.items())))
        if key not in self._analyses:
            self._analyses[key] = Analysis(
                self.obs, self.roster, tau=tau, weighted=weighted,
                category_weights=CATEGORY_WEIGHTS, **kw)
        return self._analyses[key]


_CONTEXTS: dict[tuple[int, str], Context] = {}


def ctx(spark: SparkSession, sf_dir: str) -> Context:
    key = (id(spark), sf_dir)
    c = _CONTEXTS.get(key)
    if c is None or c.spark is not spark:
        c = _CONTEXTS[key] = Context(spark, sf_dir)
    return c


def main(spark, sf_dir) -> Analysis:
    return ctx(spark, sf_dir).analysis()


def _nested_edges(c: Context) -> DataFrame:
    """Edge sets of every slice at four thresholds, step 1..4 (growing sets)."""
    pairs = c.analysis().pairs
    parts = [N.threshold_edges(pairs, t).select(*GROUP, F.lit(i + 1).alias("step"), "u", "v")
             for i, t in enumerate(NESTED_TAUS)]
    return reduce(DataFrame.unionByName, parts)


def _nested_relation(c: Context) -> DataFrame:
    return TT.containment_relation(_nested_edges(c), GROUP, "step")


# ------------------------------------------------------------ query bodies

def q_observations(spark, d):
    """S1 from written CSV files of two layouts: columns in other orders, one too many, one item without
    any price, and rows whose price or year is no number, which are set apart."""
    rows = panel.fixture_observations(spark, d).select(
        F.col("city").alias("City"), F.col("year").cast("string").alias("Year"), F.col("category").alias("Category"),
        F.col("month_year").alias("Month_Year"), F.col("item_description").alias("Item_Description"),
        F.when(F.col("category") != UNPRICED_CATEGORY, F.col("normalized_price")).cast("string").alias("Normalized_Price"),
        F.length("city").alias("Extra"))
    bad = rows.where(F.col("Year") == str(SLICE_YEAR))
    rows = rows.unionByName(bad.withColumn("Normalized_Price", F.lit("n/a"))).unionByName(bad.withColumn("Year", F.lit("98a")))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pricenet-tables/{run_folder(spark)}/{uuid.uuid4().hex}"
    even = F.substring("Month_Year", -1, 1).cast("int") % 2 == 0
    layouts = {"a": sorted(rows.columns), "b": sorted(set(rows.columns) - {"Extra"}, reverse=True)}
    for name, of in (("a", even), ("b", ~even)):
        rows.where(of).select(*layouts[name]).write.option("header", "true").csv(f"{folder}/{name}")
    return panel.read_observations(spark, [f"{folder}/a", f"{folder}/b"], "csv", rejects=f"{folder}/rejects").drop("ordinal")


def q_prep_unpivot(spark, d):
    raw = panel.raw_price_panel(spark, d)
    cities = panel.fixture_roster(spark, d, absent=False)
    ids = ["year", "month_year", "category", "item_description"]
    wide = raw.groupBy(*ids).pivot("city", cities).agg(F.max("price"))
    return panel.unpivot_cities(wide, ids, cities, "price")


def q_prep_categorize(spark, d):
    """Items are part keys, their categories come from the lookup alone; some parts are not in it."""
    raw = panel.raw_price_panel(spark, d, item_col="p_partkey", fine=True).drop("category")
    lookup = (panel.table(spark, d, "part").where(F.col("p_type") != UNPRICED_CATEGORY)
              .select(F.col("p_partkey").cast("string").alias("item_description"), F.col("p_type").alias("category")))
    return panel.categorize(raw, lookup, default="Other")


def q_vector_dedup(spark, d):
    """V3 on single order lines: several prices a feature, in line order, those of returned lines missing."""
    lines = panel.line_prices(spark, d).select(
        "city", "year", "category", "month_year", "item_description", "ordinal",
        F.when(F.col("returned"), F.lit(None)).otherwise(F.col("unit_price")).cast("double").alias("normalized_price"))
    return V.features(lines)


def q_feature_key(spark, d):
    from pricenet.functions.exprs import feature_key
    return ctx(spark, d).obs.select(*GROUP, "city", feature_key().alias("feature"), "normalized_price")


def q_cosine_pairs_brand(spark, d):
    c = ctx(spark, d)
    return V.cosine_pairs(V.roster_features(V.features(c.brand_obs), c.roster))


def q_induced_subgraph(spark, d):
    a = main(spark, d)
    return N.induced_subgraph(a.nodes, a.edges, INDUCED_N)[1]


def q_centrality_single(spark, d):
    c = ctx(spark, d)
    return c.analysis(years=(SLICE_YEAR,), categories=(SLICE_CATEGORY,)).centrality


def q_top_cities(spark, d):
    top = C.top_cities(main(spark, d).centrality, "D_i", TOP_N)
    w = Window.orderBy(F.round("d_i", C.RANK_DIGITS).desc(), "city", "year", "category")
    return top.withColumn("rank", F.row_number().over(w))


def q_edge_subset(spark, d):
    pairs = main(spark, d).pairs
    return TT.edge_subset(N.threshold_edges(pairs, 0.5), N.threshold_edges(pairs, 0.2), GROUP)


def q_edge_subset_swapped(spark, d):
    """T1 the other way round: false wherever the lower threshold adds an edge."""
    pairs = main(spark, d).pairs
    return TT.edge_subset(N.threshold_edges(pairs, 0.2), N.threshold_edges(pairs, 0.5), GROUP)


def q_containment_years(spark, d):
    e = main(spark, d).edges
    return TT.containment_relation(e, ["category"], "year")


def q_containment_turns(spark, d):
    """T3 on year graphs of alternating thresholds: some pairs of years are contained, others are not."""
    pairs = main(spark, d).pairs
    parts = [N.threshold_edges(pairs.where(F.col("year") % 2 == i), t) for i, t in enumerate(TURN_TAUS)]
    return TT.containment_relation(reduce(DataFrame.unionByName, parts), ["category"], "year")


def q_partial_order(spark, d):
    c = ctx(spark, d)
    return TT.partial_order_check(_nested_edges(c), _nested_relation(c), GROUP, "step")


def q_partial_order_broken(spark, d):
    """T2 on a relation that lacks its step from the first to the last set: not transitive."""
    c = ctx(spark, d)
    lacking = _nested_relation(c).where(~((F.col("t_from") == 1) & (F.col("t_to") == len(NESTED_TAUS))))
    return TT.partial_order_check(_nested_edges(c), lacking, GROUP, "step")


def q_feed_network(spark, d):
    a = main(spark, d)
    return G.network_feed(a.degrees, a.edges)[0]


def q_scores_by_year(spark, d):
    return W.scores_by_year(main(spark, d).scores)


def _q(fn: Callable[[Analysis], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: fn(main(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources and preparation
    "observations": q_observations,
    "prep_time_features": lambda s, d: panel.raw_price_panel(s, d),
    "prep_unpivot": q_prep_unpivot,
    "prep_categorize": q_prep_categorize,
    "prep_zscore": lambda s, d: panel.fixture_observations(s, d),
    # vectors and similarity
    "slice": lambda s, d: V.slice_filter(ctx(s, d).obs, SLICE_YEAR, SLICE_CATEGORY),
    "feature_key": q_feature_key,
    "vector_dedup": q_vector_dedup,
    "vector_features": _q(lambda a: a.features),
    "vector_matrix": _q(lambda a: a.roster_features),
    "vector_coverage": lambda s, d: V.coverage(main(s, d).features, ctx(s, d).roster),
    "vector_norm": _q(lambda a: V.norms(a.roster_features)),
    "cosine_pairs": _q(lambda a: a.pairs),
    "cosine_pairs_brand": q_cosine_pairs_brand,
    "similarity_stats": lambda s, d: V.similarity_stats(main(s, d).pairs, main(s, d).groups, ctx(s, d).roster),
    "similarity_matrix": lambda s, d: V.similarity_matrix(main(s, d).pairs, main(s, d).groups, ctx(s, d).roster),
    # networks
    "threshold_edges": _q(lambda a: a.edges),
    "threshold_join": lambda s, d: N.threshold_edges(V.similar_pairs(main(s, d).roster_features, TAU), TAU),
    "threshold_join_tau075": lambda s, d: N.threshold_edges(V.similar_pairs(main(s, d).roster_features, 0.75), 0.75),
    "weighted_edges": lambda s, d: ctx(s, d).analysis(weighted=True).edges,
    "network_nodes": _q(lambda a: a.nodes),
    "network_adjacency": _q(lambda a: N.adjacency(a.edges)),
    "network_metadata": _q(lambda a: a.metadata),
    "networks_nonempty": _q(lambda a: a.networks),
    "network_stats": _q(lambda a: a.stats),
    "connected_components": _q(lambda a: a.component_counts),
    "clustering_coefficient": _q(lambda a: a.clustering),
    "path_metrics": _q(lambda a: a.path_metrics),
    "network_statistics": _q(lambda a: a.network_statistics),
    "network_summary": _q(lambda a: N.network_summary(a.networks)),
    "induced_subgraph": q_induced_subgraph,
    # paths and centrality
    "shortest_paths": _q(lambda a: a.paths.table),
    "degree_centrality": _q(lambda a: a.degree_centrality),
    "closeness_centrality": _q(lambda a: a.closeness),
    "betweenness_centrality": _q(lambda a: a.betweenness),
    "eigenvector_centrality": _q(lambda a: a.eigenvector),
    "centrality_single": q_centrality_single,
    "centrality_all": _q(lambda a: a.centrality),
    "centrality_minmax": _q(lambda a: C.minmax_normalize(a.centrality)),
    "top_cities": q_top_cities,
    "centrality_summary": _q(lambda a: C.centrality_summary(a.centrality)),
    "top3_per_metric": _q(lambda a: C.top_per_metric(a.centrality, 3)),
    # scoring
    "score_equal": _q(lambda a: W.score_equal(a.centrality)),
    "metric_correlations": _q(lambda a: W.metric_correlations(a.centrality)),
    "score_correlation": _q(lambda a: W.score_correlation(a.centrality)),
    "score_category": _q(lambda a: W.score_category(a.centrality, CATEGORY_WEIGHTS)),
    "metric_entropy": _q(lambda a: W.metric_entropy(a.centrality)),
    "score_entropy": _q(lambda a: W.score_entropy(a.centrality)),
    "score_custom": _q(lambda a: W.score_custom(a.centrality, CUSTOM_WEIGHTS)),
    "scores_all": _q(lambda a: a.scores),
    "scores_by_year": q_scores_by_year,
    "rankings": _q(lambda a: W.rankings(a.year_scores, "Score_Equal")),
    "compare_schemes": _q(lambda a: W.compare_schemes(a.year_scores, None, TOP_N)),
    # temporal
    "edge_subset": q_edge_subset,
    "edge_subset_swapped": q_edge_subset_swapped,
    "containment_relation": lambda s, d: _nested_relation(ctx(s, d)),
    "containment_relation_years": q_containment_years,
    "containment_relation_turns": q_containment_turns,
    "containment_reduction": lambda s, d: TT.containment_reduction(_nested_relation(ctx(s, d)), GROUP),
    "hasse_edges": lambda s, d: TT.hasse_edges(TT.containment_reduction(_nested_relation(ctx(s, d)), GROUP), GROUP),
    "partial_order_check": q_partial_order,
    "partial_order_broken": q_partial_order_broken,
    "network_evolution": _q(lambda a: a.evolution),
    "density_by_year": _q(lambda a: TT.density_by_year(a.evolution)),
    # feeds and report
    "feed_network": q_feed_network,
    "feed_network_edges": lambda s, d: G.network_feed(ctx(s, d).analysis(weighted=True).degrees,
                                                      ctx(s, d).analysis(weighted=True).edges)[1],
    "feed_radar": _q(lambda a: G.radar_feed(a.centrality, RADAR_CITY, RADAR_YEAR)),
    "feed_top_by_scheme": _q(lambda a: G.top_by_scheme_feed(a.year_scores, 5)),
    "feed_metric_series": _q(lambda a: G.metric_series_feed(a.evolution, SERIES_CATEGORY, "density")),
    "overview_counts": lambda s, d: G.overview_counts(ctx(s, d).obs, TAU),
    "report_summary": _q(lambda a: S.summary_counts(a.networks, a.centrality, a.evolution)),
    "report_top5": _q(lambda a: S.top5_by_year(a.year_scores, 5)),
    # the original default threshold and the eigenvector failure case
    "network_metadata_tau075": lambda s, d: ctx(s, d).analysis(tau=0.75).metadata,
    "centrality_all_tau075": lambda s, d: ctx(s, d).analysis(tau=0.75).centrality,
    "eigenvector_centrality_tau05": lambda s, d: ctx(s, d).analysis(tau=0.5).eigenvector,
    "path_metrics_tau05": lambda s, d: ctx(s, d).analysis(tau=0.5).path_metrics,
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda fn: (lambda spark, d: finalize(fn(spark, d))))(fn) for name, fn in QUERIES.items()}
