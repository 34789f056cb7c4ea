"""Query registry used by ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlake.functions.stats import round_doubles
from marketlake.plans.common import query_scope
from marketlake.plans.views import rounded

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, doubles: tuple[str, ...] = (), near: bool = False):
    """Register a query; doubles are rounded to 9 places on both sides.
    ``near``: it runs on the prints drawn together (one-minute grids)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # stored times are UTC wall clock (NTZ); conversions assume a UTC session
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            with query_scope(near):
                return round_doubles(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = rounded(sql, list(doubles))
        return fn
    return deco
