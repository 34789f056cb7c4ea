"""Per-market and per-series trade statistics.

All are hash aggregates (partial + final), so a hot market only costs its
partial-aggregate rows in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.timecols import EASTERN, floor_to, to_eastern
from marketlake.operators.paths import _micros

def _order():
    return F.struct("trade_time", "trade_id")


def market_trade_summary(t: DataFrame, key: str = "market_id") -> DataFrame:
    """A1: count, volume, first/last time, min/max/avg/sample-std price."""
    return t.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_trades"),
        F.sum("size").cast("bigint").alias("total_contracts_traded"),
        F.min("trade_time").alias("first_trade_at"),
        F.max("trade_time").alias("last_trade_at"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.avg("price").alias("avg_price"),
        F.stddev_samp("price").alias("stddev_price"),
    )


def market_trade_stats(t: DataFrame, key: str = "market_id") -> DataFrame:
    """A2: count, open / close price (first / last non-NULL price by time),
    mean price, mean / min / max size."""
    has_price = F.when(F.col("price").isNotNull(), _order())
    return t.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_trades"),
        F.min_by("price", has_price).alias("open_price"),
        F.max_by("price", has_price).alias("close_price"),
        F.avg("price").alias("average_price"),
        F.avg("size").alias("average_trade_size"),
        F.min("size").alias("min_trade_size"),
        F.max("size").alias("max_trade_size"),
    ).withColumn("price_delta", F.col("close_price") - F.col("open_price"))


def peak_hour(t: DataFrame, key: str = "market_id", zone: str = EASTERN) -> DataFrame:
    """The hour with the most prints (earliest on ties).

    Grouping is on the UTC hour (an instant), shown in ``zone``: in the
    autumn clock change two UTC hours read as the same local hour."""
    hourly = (t.groupBy(key, floor_to("trade_time", "hour").alias("hour_utc"))
              .agg(F.count(F.lit(1)).alias("n")))
    best = F.max_by("hour_utc", F.struct("n", (-_micros("hour_utc")).alias("early")))
    return (hourly.groupBy(key)
            .agg(best.alias("hour_utc"), F.max("n").alias("peak_trade_hour_trade_count"))
            .select(key, to_eastern("hour_utc", zone).alias("peak_trade_hour_et"),
                    "peak_trade_hour_trade_count"))


def series_trade_stats(t: DataFrame, key: str = "series_ticker") -> DataFrame:
    """A4."""
    return t.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_trades"),
        F.avg("price").alias("average_price"),
        F.avg("size").alias("average_trade_size"),
        F.min("size").alias("min_trade_size"),
        F.max("size").alias("max_trade_size"),
    )


def series_market_stats(market_stats: DataFrame, key: str = "series_ticker",
                        market: str = "market_id") -> DataFrame:
    """A5: distinct markets and market-level means (mean of means)."""
    return market_stats.groupBy(key).agg(
        F.countDistinct(market).alias("market_count"),
        F.avg("open_price").alias("open_price"),
        F.avg("close_price").alias("close_price"),
        F.avg("price_delta").alias("price_delta"),
    )


def series_hourly_pivot(t: DataFrame, key: str = "series_ticker", zone: str = EASTERN,
                        values: list[str] | None = None) -> DataFrame:
    """Hour x series trade counts, absent -> 0.  Hours are UTC hours (in
    autumn two of them read as the same local hour), shown in ``zone``.
    Without ``values`` the series come from the prints (one distinct job);
    a list of them leaves all others out."""
    p = t.groupBy(floor_to("trade_time", "hour").alias("trade_hour_utc")).pivot(key, values).agg(F.count(F.lit(1)))
    counts = [c for c in p.columns if c != "trade_hour_utc"]
    return p.na.fill(0, counts).select("trade_hour_utc", to_eastern("trade_hour_utc", zone).alias("trade_hour_et"), *[F.col(f"`{c}`") for c in counts])


def day_trades(t: DataFrame, day: str, zone: str = EASTERN) -> DataFrame:
    """Local time, keep one local calendar day, add the local hour.
    The day is turned into a UTC range so the filter reaches the scan."""
    lo = F.convert_timezone(F.lit(zone), F.lit("UTC"), F.lit(day).cast("timestamp_ntz"))
    hi = F.convert_timezone(F.lit(zone), F.lit("UTC"),
                            F.date_add(F.lit(day).cast("date"), 1).cast("timestamp_ntz"))
    local = to_eastern("trade_time", zone)
    return (t.filter((F.col("trade_time") >= lo) & (F.col("trade_time") < hi))
            .withColumn("trade_time_et", local)
            .withColumn("trade_hour_et", floor_to(local, "hour")))


def drift_by_window(t: DataFrame, key: str = "market_id", window: str = "window") -> DataFrame:
    """Per window: count, first, last, mean, sample std, min, max, range."""
    has_price = F.when(F.col("price").isNotNull(), _order())
    return t.groupBy(key, window).agg(
        F.count(F.lit(1)).alias("trades"),
        F.min_by("price", has_price).alias("first_price"),
        F.max_by("price", has_price).alias("last_price"),
        F.avg("price").alias("mean_price"),
        F.stddev_samp("price").alias("std_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    ).withColumn("price_range", F.col("max_price") - F.col("min_price"))


def outcome_sources(markets_with_outcome: DataFrame) -> DataFrame:
    """Markets per outcome source."""
    return markets_with_outcome.groupBy("outcome_source").agg(F.count(F.lit(1)).alias("markets"))


def trade_value(t: DataFrame, key: str = "market_id") -> DataFrame:
    """Dollars exchanged = size x price, per market."""
    return t.groupBy(key).agg(F.sum(F.col("size") * F.col("price")).alias("dollars_traded"),
                              F.sum("size").cast("bigint").alias("contracts_traded"))


def coverage_counts(t: DataFrame, by: str = "window") -> DataFrame:
    """Prints, distinct markets, distinct games per window."""
    return t.groupBy(by).agg(F.count(F.lit(1)).alias("trades"),
                             F.countDistinct("market_id").alias("markets"),
                             F.countDistinct("game_id").alias("games"))


def jump_count(path: DataFrame, key: str, abs_delta: str, threshold: float) -> DataFrame:
    """Steps whose absolute move is at least ``threshold``."""
    return path.groupBy(key).agg(F.count_if(F.col(abs_delta) >= threshold).alias("jumps"))
