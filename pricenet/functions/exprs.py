"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_or_name(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_none(c) -> Column:
    """``str(x)`` as pandas would print it: nulls become the text 'None'."""
    return F.coalesce(col_or_name(c).cast("string"), F.lit("None"))


def feature_key(month_col="month_year", item_col="item_description") -> Column:
    """Feature name ``<month>_<item>`` (null parts spelled 'None')."""
    return F.concat_ws("_", text_or_none(month_col), text_or_none(item_col))


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 (no ANSI divide-by-zero error)."""
    return F.try_divide(col_or_name(num), col_or_name(den))


def clip(c, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), col_or_name(c)))


def rnd(c, digits: int = 6) -> Column:
    """Round for cross-engine comparison; -0.0 becomes 0.0.

    Computed as round(x * 10^d) / 10^d: scaling is exact IEEE arithmetic
    and a tie at 0 decimals is an exact binary .5, so every engine that
    rounds half away from zero gets the same double (rounding x directly
    to d decimals differs between decimal-string and binary rounding).
    """
    scale = float(10 ** digits)
    return F.round(col_or_name(c) * F.lit(scale), 0) / F.lit(scale) + F.lit(0.0)


def abs_pearson(x: str, y: str) -> Column:
    """|Pearson r| of two columns as an aggregate, 0 when undefined.

    Zero variance (a constant metric) or a single row makes r undefined;
    such pairs add nothing to a correlation sum, so they become 0 here.
    Population moments are fine: the n factors cancel in r.
    """
    cov = F.covar_pop(x, y)
    den = F.sqrt(F.var_pop(x) * F.var_pop(y))
    r = F.when(den > 0, F.try_divide(cov, den))
    return F.coalesce(F.abs(r), F.lit(0.0))
