"""Exact-value watermark cases (epoch windows, overlap, backfill, errors)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake.operators import incremental as I

# The epoch seconds of these cases are the contract's.
NOW = int(dt.datetime(2026, 5, 14, 13, 30, 45, tzinfo=dt.timezone.utc).timestamp())


def markets(spark):
    return spark.createDataFrame([("M1",)], "market_ticker string")


def state(spark, ts):
    return spark.createDataFrame([("M1", ts, None, None)],
                                 "market_ticker string, checked_through_ts long, max_created_ts long, "
                                 "last_seen_trade_ts long")


def test_first_run_lookback(spark):
    r = I.plan_trade_windows(markets(spark), None, "incremental", NOW).collect()[0]
    assert (r.min_ts, r.max_ts, r.all_pages) == (1778679045, 1778765445, True)


@pytest.mark.parametrize("overlap,expected", [(30, 1778761815), (0, 1778761845)])
def test_watermark_overlap(spark, overlap, expected):
    r = I.plan_trade_windows(markets(spark), state(spark, 1778761845), "incremental", NOW,
                             overlap_seconds=overlap).collect()[0]
    assert r.min_ts == expected


def test_backfill_bounds_and_rules(spark):
    lo = int(dt.datetime(2026, 5, 13, tzinfo=dt.timezone.utc).timestamp())
    hi = int(dt.datetime(2026, 5, 14, tzinfo=dt.timezone.utc).timestamp())
    r = I.plan_trade_windows(markets(spark), None, "backfill", NOW, lo=lo, hi=hi).collect()[0]
    assert (r.min_ts, r.max_ts) == (1778630400, 1778716800)
    assert I.check_mode("backfill", lo, hi) is False          # backfill leaves state untouched
    assert I.check_mode("incremental") is True
    with pytest.raises(ValueError):
        I.check_mode("incremental", lo, hi)                    # bounds need backfill mode
    with pytest.raises(ValueError):
        I.check_mode("backfill", lo, None)
    assert I.plan_trade_windows(markets(spark), None, "recent", NOW).count() == 0


def test_state_advances_without_trades(spark):
    empty = spark.createDataFrame([], "market_ticker string, last_seen_trade_ts long, last_seen_trade_time string, "
                                      "last_seen_trade_id string")
    out = I.merge_watermark_state(None, empty, markets(spark), NOW, "2026-05-14T13:30:45Z").collect()[0]
    assert out.checked_through_ts == NOW and out.last_seen_trade_ts is None
    assert out.checked_through_time == "2026-05-14T13:30:45Z"


def test_latest_watermarks_and_advance_only(spark):
    raw = spark.createDataFrame(
        [("1", "M1", None, "2026-05-14T13:00:00Z"), ("2", None, "M1", "2026-05-14T13:05:00Z"),
         ("3", "M2", None, "bad"), ("4", "", None, "2026-05-14T13:06:00Z")],
        "trade_id string, ticker string, market_ticker string, created_time string")
    wm = {r.market_ticker: r for r in I.latest_trade_watermarks(raw).collect()}
    assert set(wm) == {"M1"} and wm["M1"].last_seen_trade_id == "2"
    old = spark.createDataFrame([("M1", 1778765445, "x", "9", 1778765445)],
                                "market_ticker string, last_seen_trade_ts long, last_seen_trade_time string, "
                                "last_seen_trade_id string, checked_through_ts long")
    latest = I.latest_trade_watermarks(raw)
    out = I.merge_watermark_state(old, latest, markets(spark), NOW - 100, "u").collect()[0]
    # an older run never moves either position back
    assert out.last_seen_trade_id == "9" and out.checked_through_ts == 1778765445


def test_fetch_window_filters_by_market(spark):
    t = spark.createDataFrame([("M1", 10), ("M1", 20), ("M2", 5)], "market_ticker string, sec long")
    w = spark.createDataFrame([("M1", 15, 30)], "market_ticker string, min_ts long, max_ts long")
    got = I.trade_fetch_window(t, w, F.col("sec")).collect()
    assert [(r.market_ticker, r.sec) for r in got] == [("M1", 20)]
