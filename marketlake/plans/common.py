"""Frames shared by several registered queries.

A registered query runs inside ``query_scope()``: dimensions derived from
the prints (markets with their outcome) are built once per query call and
written as a reliable checkpoint, so every branch of the plan reads that
small table instead of re-aggregating the fact table.  Nothing is kept
between calls.
"""

from __future__ import annotations

import contextvars
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.outcomes import labelled_trades, market_outcome, winner_probability
from marketlake.session import materialize
from marketlake.sources import proxies as P

_NEAR: contextvars.ContextVar[bool] = contextvars.ContextVar("marketlake_near", default=False)
_SHARED: contextvars.ContextVar[dict | None] = contextvars.ContextVar("marketlake_shared", default=None)


@contextmanager
def query_scope(near: bool = False):
    """Frames built through ``shared`` inside this block are built once.
    ``near``: the prints are those of ``proxies.near_trades``."""
    token, was = _SHARED.set({}), _NEAR.set(near)
    try:
        yield
    finally:
        _SHARED.reset(token)
        _NEAR.reset(was)


def shared(key: tuple, build: Callable[[], DataFrame]) -> DataFrame:
    cache = _SHARED.get()
    if cache is None:
        return build()
    if key not in cache:
        cache[key] = build()
    return cache[key]


def trades(spark: SparkSession, d: str) -> DataFrame:
    return P.near_trades(spark, d) if _NEAR.get() else P.trades(spark, d)


def markets_outcome(spark: SparkSession, d: str) -> DataFrame:
    """Markets (one row each) with outcome and source.  Aggregated from the
    prints once, then checkpointed: its size is one row per market, and
    joins against it see that size at planning time."""
    def build():
        m = P.markets(spark, d, trades(spark, d))
        return materialize(market_outcome(m, P.winners(m)))
    return shared(("markets_outcome", d), build)


def games(spark: SparkSession, d: str) -> DataFrame:
    """One row per game with its start and, when known, its winner."""
    return markets_outcome(spark, d).groupBy("game_id").agg(
        F.min("game_start").alias("game_start"), F.min("winner_side").alias("winner_side"))


def labelled(spark: SparkSession, d: str) -> DataFrame:
    return labelled_trades(trades(spark, d), markets_outcome(spark, d))


def scored(spark: SparkSession, d: str) -> DataFrame:
    return winner_probability(labelled(spark, d))


def pregame(spark: SparkSession, d: str) -> DataFrame:
    return scored(spark, d).filter(F.col("window") == "pregame")


def live(spark: SparkSession, d: str) -> DataFrame:
    return scored(spark, d).filter(F.col("window") == "live")
