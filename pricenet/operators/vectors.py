"""City price vectors and cosine similarity (V1-V9).

Vectors stay long and sparse: ``features(year, category, city, feature,
value)``.  A missing cell is a zero, exactly as the zero-filled pivot of the
reference, but no (city x feature) matrix is ever materialised.  Similarity
is a self-join on ``(year, category, feature)`` restricted to ``u <= v``; each
join key holds at most one row per roster city (after de-duplication), so a
hot slice or a hot feature cannot make one key grow with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricenet.functions.exprs import clip, feature_key
from pricenet.functions.validation import check_roster
from pricenet.session import GROUP, cut_lineage


def roster_array(cities: Sequence[str]):
    """The roster as a literal array column (its size is a driver-known parameter)."""
    return F.array(*[F.lit(c) for c in check_roster(cities)])


def slice_filter(obs: DataFrame, year: int | None = None, category: str | None = None) -> DataFrame:
    """V1: keep one (year, category) slice; with no arguments keep all slices."""
    out = obs
    if year is not None:
        out = out.where(F.col("year") == F.lit(year))
    if category is not None:
        out = out.where(F.col("category") == F.lit(category))
    return out


def features(obs: DataFrame) -> DataFrame:
    """V2 + V3: one value per (year, category, city, feature).

    feature = ``<month_year>_<item_description>``; duplicates keep the first
    non-null value in the order of ``ordinal`` (any orderable type).  Without
    an ordinal keys have to be unique: a repeated key fails the job, as no
    value could be called the first.  All cities are kept here (they define
    the slice's feature set); roster restriction comes later.
    """
    base = (obs.where(F.col("normalized_price").isNotNull())
            .withColumn("feature", feature_key()))
    keys = GROUP + ["city", "feature"]
    if "ordinal" in obs.columns:
        value = F.min_by("normalized_price", "ordinal")
    else:
        unordered = F.raise_error(F.lit("repeated (slice, city, feature) without an ordinal to order them")).cast("double")
        value = F.when(F.count("*") > 1, unordered).otherwise(F.min("normalized_price"))
    return base.groupBy(*keys).agg(value.alias("value"))


def slice_groups(rows: DataFrame) -> DataFrame:
    """Slices that have data: at least one non-null observation (or a feature row).

    Read off the observations, so that listing slices needs no feature table.
    """
    if "normalized_price" in rows.columns:
        rows = rows.where(F.col("normalized_price").isNotNull())
    return rows.select(*GROUP).distinct()


def roster_features(feats: DataFrame, cities: Sequence[str]) -> DataFrame:
    """V4 (sparse): roster cities only, non-zero cells only.

    Cities outside the roster are dropped; roster cities without data have
    no rows, i.e. a zero vector.  Zero cells carry no information for norms
    or dot products.  ``isin`` on the literal roster is pushed into the scan.
    """
    return feats.where(F.col("city").isin(list(cities)) & (F.col("value") != 0))


def coverage(feats: DataFrame, cities: Sequence[str]) -> DataFrame:
    """V5: matrix shape and zero share per slice (as in the zero-filled pivot)."""
    n = len(cities)
    in_roster = F.col("city").isin(list(cities))
    stats = feats.groupBy(*GROUP).agg(
        F.countDistinct("feature").alias("n_features"),
        F.count_if(in_roster & (F.col("value") != 0)).alias("nonzero"))
    total = F.lit(n).cast("long") * F.col("n_features")
    zero = total - F.col("nonzero")
    return stats.select(
        *GROUP,
        F.lit(n).cast("long").alias("n_cities"),
        F.col("n_features").cast("long").alias("n_features"),
        total.alias("n_cells"),
        zero.alias("zero_count"),
        F.try_divide(zero * 100.0, total).alias("zero_pct"),
        (F.try_divide(zero * 100.0, total) > 70).alias("high_missing"),
    )


def norms(rfeats: DataFrame) -> DataFrame:
    """V6: L2 norm per (slice, city) over the sparse roster vectors."""
    return rfeats.groupBy(*GROUP, "city").agg(
        F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))


def cosine_pairs(rfeats: DataFrame) -> DataFrame:
    """V7: cosine similarity of every roster city pair sharing a non-zero feature.

    Output ``(year, category, u, v, sim)`` with ``u < v``.  Pairs absent from
    the output have similarity 0 (no shared non-zero feature, or a zero
    vector).  One self-join on ``(year, category, feature)`` with ``u <= v``
    yields all dot products; its diagonal (u = v) holds the squared norms,
    so the feature stream is shuffled once.  Dot products are partially
    aggregated in the join stage (one row per slice, pair and task leaves
    it); the norms are then attached to the aggregated pairs — at most
    roster^2 / 2 per slice — never to the feature stream.
    """
    a = rfeats.select(*GROUP, "feature", F.col("city").alias("u"), F.col("value").alias("a"))
    b = rfeats.select(*GROUP, "feature", F.col("city").alias("v"), F.col("value").alias("b"))
    dots = (a.join(b, GROUP + ["feature"]).where(F.col("u") <= F.col("v"))
            .groupBy(*GROUP, "u", "v").agg(F.sum(F.col("a") * F.col("b")).alias("dot")))
    # Each row takes |u|^2 from the diagonal row (u, u) of its u-window and
    # |v|^2 from (v, v) of its v-window; a window holds one city's pairs
    # (<= roster rows), and the pair table is computed once.
    diag = F.max(F.when(F.col("u") == F.col("v"), F.col("dot")))
    normed = dots.withColumns({
        "nu": F.sqrt(diag.over(Window.partitionBy(*GROUP, "u"))),
        "nv": F.sqrt(diag.over(Window.partitionBy(*GROUP, "v"))),
    })
    sim = F.col("dot") / (F.col("nu") * F.col("nv"))
    return (normed.where(F.col("u") < F.col("v"))
            .select(*GROUP, "u", "v", clip(sim, -1.0, 1.0).alias("sim")))


# Slack of the bounds against rounding.
_SLACK = 1e-9


def prefix_index(rfeats: DataFrame, tau: float) -> DataFrame:
    """The entries of each unit vector that a pair with cosine >= tau must share one of.

    Features are ordered by how few cities of their slice have them.  What
    follows a place of a vector can add to a product at most the smaller of its
    norm and the sum of its values times each feature's greatest value in the
    slice.  A vector's prefix ends where that falls below tau: if two vectors
    share nothing in their prefixes, all they share lies behind the end of the
    shorter one, and their cosine is below tau.

    ``(year, category, city, feature, unit, place, last, rest)``: ``place`` orders
    features, ``last`` is that of the prefix's end and ``rest`` the bound behind it.
    """
    city = Window.partitionBy(*GROUP, "city")
    unit = rfeats.select(*GROUP, "city", "feature", (F.col("value") / F.sqrt(
        F.sum(F.col("value") * F.col("value")).over(city))).alias("unit"))
    spread = unit.groupBy(*GROUP, "feature").agg(F.count("*").alias("held"), F.max(F.abs("unit")).alias("greatest"))
    placed = unit.join(spread, [*GROUP, "feature"]).withColumn("place", F.struct("held", "feature"))
    behind = city.orderBy(F.col("place").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def bound(over):
        return F.least(F.sqrt(F.sum(F.col("unit") * F.col("unit")).over(over)), F.sum(F.abs("unit") * F.col("greatest")).over(over))

    after = city.orderBy(F.col("place").desc()).rowsBetween(Window.unboundedPreceding, -1)
    bounded = placed.withColumns({"here": bound(behind), "rest": F.coalesce(bound(after), F.lit(0.0))})
    prefix = bounded.where(F.col("here") >= tau - _SLACK)
    ends = prefix.groupBy(*GROUP, "city").agg(F.max("place").alias("last"), F.max_by("rest", "place").alias("rest"))
    return prefix.drop("rest", "here", "held", "greatest").join(ends, [*GROUP, "city"])


def candidate_pairs(index: DataFrame, tau: float) -> DataFrame:
    """(year, category, u, v) that share a prefix entry and whose bound reaches tau.

    The bound adds what the prefixes share to what the rest behind the shorter
    prefix can add at most.  A key of the join holds one row a city of the roster.
    """
    own = [*GROUP, "feature"]
    a = index.select(*own, *[F.col(c).alias(f"{c}_a") for c in ("city", "unit", "last", "rest")])
    b = index.select(*own, *[F.col(c).alias(f"{c}_b") for c in ("city", "unit", "last", "rest")])
    rest = F.min(F.when(F.col("last_a") <= F.col("last_b"), F.col("rest_a")).otherwise(F.col("rest_b")))
    return (a.join(b, own).where(F.col("city_a") < F.col("city_b"))
            .groupBy(*GROUP, F.col("city_a").alias("u"), F.col("city_b").alias("v"))
            .agg(F.sum(F.col("unit_a") * F.col("unit_b")).alias("shared"), rest.alias("rest"))
            .where(F.col("shared") + F.col("rest") >= tau - _SLACK).select(*GROUP, "u", "v"))


def similar_pairs(rfeats: DataFrame, tau: float) -> DataFrame:
    """V7 for pairs with ``sim >= tau`` > 0 alone: no pair is compared that cannot reach tau.

    Same columns and values as :func:`cosine_pairs`.  Candidates come from a
    prefix-filtered index (signed values too) and are verified by whole products.
    """
    if not tau > 0:
        raise ValueError("a pair without a common feature has similarity 0: tau must be above it")
    rfeats = cut_lineage(rfeats)
    candidates = cut_lineage(candidate_pairs(cut_lineage(prefix_index(rfeats, tau)), tau))
    sizes = cut_lineage(norms(rfeats))
    a = rfeats.select(*GROUP, F.col("city").alias("u"), "feature", F.col("value").alias("a"))
    b = rfeats.select(*GROUP, F.col("city").alias("v"), "feature", F.col("value").alias("b"))
    dots = (candidates.join(a, [*GROUP, "u"]).join(b, [*GROUP, "v", "feature"])
            .groupBy(*GROUP, "u", "v").agg(F.sum(F.col("a") * F.col("b")).alias("dot")))
    for c in ("u", "v"):
        dots = dots.join(sizes.select(*GROUP, F.col("city").alias(c), F.col("norm").alias(f"n{c}")), [*GROUP, c])
    sim = clip(F.col("dot") / (F.col("nu") * F.col("nv")), -1.0, 1.0)
    return dots.select(*GROUP, "u", "v", sim.alias("sim")).where(F.col("sim") >= tau)


def roster_pairs(groups: DataFrame, cities: Sequence[str]) -> DataFrame:
    """Every roster pair ``u < v`` of every slice, generated without a join.

    Output size is the definition of a dense similarity view (roster^2 / 2
    per slice); it depends on the roster parameter, not on the data volume.
    """
    arr = roster_array(cities)
    return (groups.select(*GROUP, F.explode(arr).alias("u"))
            .select(*GROUP, "u", F.explode(F.filter(arr, lambda x: x > F.col("u"))).alias("v")))


def similarity_stats(pairs: DataFrame, groups: DataFrame, cities: Sequence[str]) -> DataFrame:
    """V8: min / max / mean of the upper triangle and the zero-share warning.

    Pairs missing from the sparse table are zeros; they enter the statistics
    arithmetically (count = n(n-1)/2 - present), not as generated rows.
    """
    n = len(cities)
    n_pairs = n * (n - 1) // 2
    agg = pairs.groupBy(*GROUP).agg(
        F.min("sim").alias("_min"), F.max("sim").alias("_max"),
        F.sum("sim").alias("_sum"), F.count("*").alias("_present"),
        F.count_if(F.col("sim") == 0).alias("_zeros"))
    g = groups.join(agg, GROUP, "left")
    absent = F.lit(n_pairs) - F.coalesce("_present", F.lit(0))
    zero_count = absent + F.coalesce("_zeros", F.lit(0))
    with_zero_min = F.when(absent > 0, F.least(F.coalesce("_min", F.lit(0.0)), F.lit(0.0))).otherwise(F.col("_min"))
    with_zero_max = F.when(absent > 0, F.greatest(F.coalesce("_max", F.lit(0.0)), F.lit(0.0))).otherwise(F.col("_max"))
    return g.select(
        *GROUP,
        F.lit(n_pairs).cast("long").alias("n_pairs"),
        with_zero_min.alias("min_sim"),
        with_zero_max.alias("max_sim"),
        F.try_divide(F.coalesce("_sum", F.lit(0.0)), F.lit(float(n_pairs))).alias("mean_sim"),
        zero_count.cast("long").alias("zero_pairs"),
        (zero_count > F.lit(n_pairs * 0.5)).alias("high_zero_share"),
    ).where(F.lit(n_pairs) > 0)


def similarity_matrix(pairs: DataFrame, groups: DataFrame, cities: Sequence[str]) -> DataFrame:
    """Full symmetric long matrix per slice, diagonal 1, absent pairs 0."""
    arr = roster_array(cities)
    cells = (groups.select(*GROUP, F.explode(arr).alias("city_i"))
             .select(*GROUP, "city_i", F.explode(arr).alias("city_j")))
    sym = pairs.select(*GROUP, "u", "v", "sim")
    keyed = cells.withColumns({"u": F.least("city_i", "city_j"), "v": F.greatest("city_i", "city_j")})
    out = keyed.join(sym, GROUP + ["u", "v"], "left")
    val = F.when(F.col("city_i") == F.col("city_j"), F.lit(1.0)).otherwise(F.coalesce("sim", F.lit(0.0)))
    return out.select(*GROUP, "city_i", "city_j", val.alias("sim"))
