"""Observation sources (S1) and panel preparation.

The analysis input is a long table of price observations::

    city STRING, year INT, category STRING, month_year STRING,
    item_description STRING, normalized_price DOUBLE [, ordinal]

``ordinal`` (any orderable type) records file order; "first value per (city,
feature)" is defined by it.  Text files are bound by their column names and
converted to these types, never inferred.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricenet.functions.exprs import safe_div
from pricenet.functions.validation import OBSERVATION_COLUMNS, require_columns
from pricenet.session import cut_lineage
from pricenet.sources.files import PLACE, accepted, file_order, read_by_name

# Required columns of a file and their types.
OBSERVATION_TYPES = {"City": "string", "Year": "int", "Category": "string", "Month_Year": "string",
                     "Item_Description": "string", "Normalized_Price": "double"}

# reference column name -> internal column name
_RENAME = {
    "City": "city", "Year": "year", "Category": "category",
    "Month_Year": "month_year", "Item_Description": "item_description",
    "Normalized_Price": "normalized_price",
}

# Literal city appended to the fixture roster so zero vectors are exercised.
ABSENT_CITY = "NATION_ABSENT"

# Order lines a task sorts or groups at once, and how many such shares are left to the planner.
TASK_ROWS = 250_000
FEW_SHARES = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(df: DataFrame, ordinal: bool = True) -> DataFrame:
    """Validate the required columns and bring them to internal names.

    Accepts either the capitalised column names or the internal ones; other
    columns are left out.  With ``ordinal`` rows without one get their order:
    that of the files for a file source, else that of the partitions.
    """
    lower = {c.lower(): c for c in df.columns}
    if all(k.lower() in lower for k in _RENAME.values()):
        src = {v: lower[v] for v in _RENAME.values()}
    else:
        require_columns(df, OBSERVATION_COLUMNS)
        src = {v: lower[k.lower()] for k, v in _RENAME.items()}
    out = [F.col(src[name]).cast(kind).alias(name) for name, kind in (
        ("city", "string"), ("year", "int"), ("category", "string"), ("month_year", "string"),
        ("item_description", "string"), ("normalized_price", "double"))]
    if "ordinal" in lower:
        out.append(F.col(lower["ordinal"]).alias("ordinal"))
    elif ordinal:
        out.append((file_order() if _from_files(df) else F.monotonically_increasing_id()).alias("ordinal"))
    return df.select(*out)


def _from_files(df: DataFrame) -> bool:
    """Whether rows still know the file they come from."""
    try:
        return bool(df.select("_metadata.file_path").columns)
    except AnalysisException:
        return False


def read_observations(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet",
                      rejects: str | None = None, **options) -> DataFrame:
    """S1 for files: columns are bound by name in every format.

    CSV files are read by their own headers and JSON lines by their keys, with
    every value checked (:mod:`pricenet.sources.files`): bad rows go to the
    parquet table ``rejects``, or fail the job where none is named.  Other
    formats carry their schema.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if fmt in ("csv", "json"):
        raw = accepted(read_by_name(spark, paths, fmt, OBSERVATION_TYPES, **options), rejects)
        return observations(raw.withColumnRenamed(PLACE, "ordinal"))
    return observations(spark.read.options(**options).format(fmt).load(paths))


# ---------------------------------------------------------------- P1 - P4

def unpivot_cities(wide: DataFrame, id_cols: Sequence[str], city_cols: Sequence[str],
                   value_name: str = "price") -> DataFrame:
    """Wide table (one column per city) -> long rows (city, value).

    Null cells are dropped: a missing price is not an observation.
    """
    long = wide.unpivot(list(id_cols), list(city_cols), "city", value_name)
    return long.where(F.col(value_name).isNotNull())


def time_features(df: DataFrame, date_col: str) -> DataFrame:
    """Integer year, month number and the ``yyyy-MM`` label."""
    d = F.col(date_col)
    return df.withColumns({
        "year": F.year(d),
        "month": F.month(d),
        "month_year": F.date_format(d, "yyyy-MM"),
    })


def categorize(df: DataFrame, item_categories: DataFrame | Mapping[str, str],
               default: str | None = None) -> DataFrame:
    """Tag each item with its category through a lookup table.

    A mapping given as a dict is a literal map expression (its size is known
    on the driver); a DataFrame is joined on ``item_description`` and left
    to the planner, which broadcasts it only when its measured size is small.
    """
    if isinstance(item_categories, Mapping):
        lookup = F.create_map(*[F.lit(x) for kv in item_categories.items() for x in kv])
        cat = lookup[F.col("item_description")]
        return df.withColumn("category", F.coalesce(cat, F.lit(default)) if default else cat)
    tagged = df.drop("category").join(
        item_categories.select("item_description", "category"), "item_description", "left")
    if default is not None:
        tagged = tagged.withColumn("category", F.coalesce("category", F.lit(default)))
    return tagged


def zscore(df: DataFrame, value_col: str = "price", by: Sequence[str] = ("category", "item_description"),
           out_col: str = "normalized_price") -> DataFrame:
    """Z = (X - mean) / std per (category, item) over all cities and months.

    Sample standard deviation; a null or zero std gives 0.0.  The statistics
    are a grouped aggregate (one small row per item, aggregated map-side),
    written and joined back.  Written, their real size is known: the planner
    broadcasts them when small, and otherwise both join sides are plain
    exchanges, in which a hot item can be split.
    """
    by = list(by)
    stats = cut_lineage(df.groupBy(*by).agg(
        F.avg(value_col).alias("_mu"), F.stddev_samp(value_col).alias("_sd")))
    z = F.when(F.col("_sd").isNull() | (F.col("_sd") == 0), F.lit(0.0)).otherwise(
        (F.col(value_col) - F.col("_mu")) / F.col("_sd"))
    return (df.join(stats, by, "inner")
            .withColumn(out_col, z)
            .drop("_mu", "_sd"))


# ------------------------------------------------------- driver fixture

def _shares(rows: DataFrame) -> int:
    """Partitions of :data:`TASK_ROWS` rows each, by the files' own row counts; 0 leaves few rows to the planner."""
    parts = math.ceil(rows.count() / TASK_ROWS)
    return parts if parts > FEW_SHARES else 0


def _dealt(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    return df.repartition(parts, *keys) if parts else df


def line_prices(spark: SparkSession, sf_dir: str, item_col: str = "p_type") -> DataFrame:
    """One row per order line of the TPC-H-like tables (P2 applied to order dates).

    city = nation name of the customer, category = part type, item =
    ``item_col`` of the part, ``unit_price`` of the line, ``returned`` lines
    marked, ``ordinal`` = place of the line (line numbers repeat within orders
    of the test tables, so part and price complete it).  Joins are written
    dimension-last so the lineitem stream is shuffled only on its join keys.
    Lines and orders meet in as many partitions as the lines need: shuffled
    lines are so small that partitions merged by size would hold millions.
    """
    parts = _shares(table(spark, sf_dir, "lineitem"))
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag",
        safe_div("l_extendedprice", "l_quantity").alias("unit_price"))
    orders = time_features(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"),
        "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    part = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_type").alias("category"),
        F.col(item_col).cast("string").alias("item_description"))
    order_city = (orders.join(cust, orders.o_custkey == cust.c_custkey)
                  .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
                  .select("o_orderkey", "city", "year", "month_year"))
    li, order_city = _dealt(li, parts, "l_orderkey"), _dealt(order_city, parts, "o_orderkey")
    return (li.join(order_city, li.l_orderkey == order_city.o_orderkey)
            .join(part, li.l_partkey == part.p_partkey)
            .select("city", "year", "category", "month_year", "item_description", "unit_price",
                    (F.col("l_returnflag") == "R").alias("returned"),
                    F.struct("l_orderkey", "l_linenumber", "l_partkey", "unit_price").alias("ordinal")))


def raw_price_panel(spark: SparkSession, sf_dir: str, item_col: str = "p_type", fine: bool = False) -> DataFrame:
    """Price panel: mean unit price per (city, category, month, item).

    The grouping runs map-side partial aggregation and collapses to at most
    cities x months x items rows.  ``fine`` items are so many that hardly two
    lines share a group: their lines are dealt out by the whole group first,
    as map-side groups would only hold them once more.
    """
    keys = ["city", "year", "category", "month_year", "item_description"]
    lines = line_prices(spark, sf_dir, item_col)
    if fine:
        lines = _dealt(lines.select(*keys, "unit_price"), _shares(table(spark, sf_dir, "lineitem")), *keys)
    return lines.groupBy(*keys).agg(F.avg("unit_price").alias("price"))


def fixture_observations(spark: SparkSession, sf_dir: str, item_col: str = "p_type") -> DataFrame:
    """Z-scored observation table derived from the driver tables.

    Keys (city, year, month, item) are unique after the aggregation, so no
    ordinal is needed to pick a first value.  The aggregated panel is
    written once (it is read twice: statistics and values), so the five-way
    join behind it never runs twice.
    """
    raw = cut_lineage(raw_price_panel(spark, sf_dir, item_col))
    return zscore(raw).select(
        "city", "year", "category", "month_year", "item_description", "normalized_price")


def fixture_roster(spark: SparkSession, sf_dir: str, absent: bool = True) -> list[str]:
    """City roster: nation names in key order, plus one city with no data.

    The roster is a parameter of the analysis (the node set of every
    network), read once from the nation dimension.
    """
    names = [r.n_name for r in table(spark, sf_dir, "nation")
             .select("n_nationkey", "n_name").orderBy("n_nationkey").collect()]
    return names + ([ABSENT_CITY] if absent else [])
