"""Guarded statistics as native aggregate / window expressions.

Spark's ``corr`` and ``regr_slope`` raise under ANSI mode when one side is
constant, even inside a CASE, so both are rebuilt from ``covar_pop`` and
``stddev_pop`` / ``var_pop`` behind explicit guards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pairwise(x, y) -> tuple[Column, Column]:
    """Mask each side where the other is NULL (pairwise-complete rows)."""
    x, y = _col(x), _col(y)
    both = x.isNotNull() & y.isNotNull()
    return F.when(both, x), F.when(both, y)


def safe_corr(x, y, min_n: int = 3) -> Column:
    """Pearson correlation over pairwise-complete rows.

    NULL unless there are at least ``min_n`` rows and each side takes two or
    more distinct values.
    """
    xx, yy = pairwise(x, y)
    ok = ((F.count(xx) >= min_n) & (F.min(xx) < F.max(xx)) & (F.min(yy) < F.max(yy)))
    return F.when(ok, F.try_divide(F.covar_pop(xx, yy), F.stddev_pop(xx) * F.stddev_pop(yy)))


def safe_slope(y, x) -> Column:
    """Least-squares slope of y on x; NULL when x is constant."""
    yy, xx = pairwise(y, x)
    return F.when(F.min(xx) < F.max(xx), F.try_divide(F.covar_pop(xx, yy), F.var_pop(xx)))


def round_doubles(df: DataFrame, places: int = 9) -> DataFrame:
    """Round every floating column (used where results are compared across engines)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), places).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
