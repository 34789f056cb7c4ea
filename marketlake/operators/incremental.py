"""Incremental trade fetching state.

State is a small DataFrame with one row per market (checked_through_ts,
last_seen_trade_ts, ...).  Planning and merging are joins on the market
key; nothing is looped on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.settings import parse_bool, parse_float, parse_int

MODES = ("incremental", "backfill", "full_history", "recent")


def epoch_seconds(text_or_ts) -> Column:
    """ISO text (with or without 'Z') or timestamp -> epoch seconds (floor)."""
    c = F.col(text_or_ts) if isinstance(text_or_ts, str) else text_or_ts
    ntz = F.try_to_timestamp(c.cast("string")).cast("timestamp_ntz")
    return F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ntz) / 1e6) \
        .cast("bigint")


def format_epoch(sec: Column) -> Column:
    return F.date_format(F.timestamp_seconds(sec).cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def check_mode(mode: str, lo=None, hi=None, write_state: bool | None = None) -> bool:
    """Argument rules.  Returns whether the run writes watermarks
    (incremental by default, the other modes not, unless overridden)."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}")
    if (lo is not None or hi is not None) and mode != "backfill":
        raise ValueError("trade bounds need backfill mode")
    if mode == "backfill" and (lo is None or hi is None):
        raise ValueError("backfill needs both bounds")
    return (mode == "incremental") if write_state is None else bool(write_state)


def watermark_position(state: DataFrame) -> Column:
    """First non-NULL of checked_through, max_created, last_seen."""
    cols = [c for c in ("checked_through_ts", "max_created_ts", "last_seen_trade_ts") if c in state.columns]
    return F.coalesce(*[F.col(c) for c in cols])


def plan_trade_windows(markets: DataFrame, state: DataFrame | None, mode: str, now_ts: int,
                       lookback_hours: float = 24, overlap_seconds: int = 60, lo: int | None = None,
                       hi: int | None = None, key: str = "market_ticker") -> DataFrame:
    """T5: per market (all_pages, min_ts, max_ts).

    incremental: min = max(0, position - overlap), or max(0, now - lookback)
    for a market without state; max = now.  backfill: fixed bounds.
    full_history: all pages, no bounds.  recent: no rows (one page only)."""
    check_mode(mode, lo, hi)
    m = markets.select(key).distinct()
    if mode == "recent":
        return m.select(key, F.lit(False).alias("all_pages"), F.lit(None).cast("bigint").alias("min_ts"),
                        F.lit(None).cast("bigint").alias("max_ts")).limit(0)
    if mode == "full_history":
        return m.select(key, F.lit(True).alias("all_pages"), F.lit(None).cast("bigint").alias("min_ts"),
                        F.lit(None).cast("bigint").alias("max_ts"))
    if mode == "backfill":
        return m.select(key, F.lit(True).alias("all_pages"), F.lit(lo).cast("bigint").alias("min_ts"),
                        F.lit(hi).cast("bigint").alias("max_ts"))
    first = max(0, int(now_ts - lookback_hours * 3600))
    if state is None:
        j = m.withColumn("_pos", F.lit(None).cast("bigint"))
    else:
        j = m.join(state.select(key, watermark_position(state).alias("_pos")), key, "left")
    min_ts = F.when(F.col("_pos").isNotNull(), F.greatest(F.lit(0), F.col("_pos") - overlap_seconds)) \
              .otherwise(F.lit(first))
    return j.select(key, F.lit(True).alias("all_pages"), min_ts.cast("bigint").alias("min_ts"),
                    F.lit(now_ts).cast("bigint").alias("max_ts"))


def windows_from_settings(markets: DataFrame, state: DataFrame | None, settings: dict[str, str], now_ts: int,
                          key: str = "market_ticker") -> tuple[DataFrame, bool]:
    """T5 and T8 from a job's settings as text: (windows, whether the run writes state).

    TRADE_MODE, TRADE_LOOKBACK_HOURS, TRADE_OVERLAP_SECONDS, TRADE_MIN_TS, TRADE_MAX_TS, WRITE_TRADE_STATE; blank or
    absent ones are the defaults, one that isn't exactly of its kind is an error that names it."""
    get = settings.get
    mode = (get("TRADE_MODE") or "").strip() or "incremental"
    lo, hi = (parse_int(n, get(n), None, least=0) for n in ("TRADE_MIN_TS", "TRADE_MAX_TS"))
    if lo is not None and hi is not None and lo > hi:
        raise ValueError(f"TRADE_MIN_TS must not be above TRADE_MAX_TS, not {lo} > {hi}")
    asked = get("WRITE_TRADE_STATE")
    writes = check_mode(mode, lo, hi, parse_bool("WRITE_TRADE_STATE", asked, False) if (asked or "").strip() else None)
    plan = plan_trade_windows(markets, state, mode, now_ts, parse_float("TRADE_LOOKBACK_HOURS", get("TRADE_LOOKBACK_HOURS"), 24.0, least=0),
                              parse_int("TRADE_OVERLAP_SECONDS", get("TRADE_OVERLAP_SECONDS"), 60, least=0), lo, hi, key)
    return plan, writes


def trade_fetch_window(trades: DataFrame, windows: DataFrame, time_sec: Column,
                       key: str = "market_ticker") -> DataFrame:
    """Prints with min_ts <= t <= max_ts of their market's window
    (equi-join on the market, range predicate after it).  The window
    table has one row per market and is joined like any dimension."""
    w = windows.select(key, "min_ts", "max_ts")
    t = trades.withColumn("_sec", time_sec)
    j = t.join(w, key, "inner")
    cond = ((F.col("min_ts").isNull() | (F.col("_sec") >= F.col("min_ts")))
            & (F.col("max_ts").isNull() | (F.col("_sec") <= F.col("max_ts"))))
    return j.filter(cond).drop("_sec", "min_ts", "max_ts")


def latest_trade_watermarks(raw_trades: DataFrame) -> DataFrame:
    """Per market the latest print second, its text and id; ties go to
    the larger trade id; rows without a market or a parseable time skip."""
    key = (F.coalesce(F.nullif(F.col("ticker"), F.lit("")), F.nullif(F.col("market_ticker"), F.lit("")))
           if "market_ticker" in raw_trades.columns else F.nullif(F.col("ticker"), F.lit("")))
    t = raw_trades.select(key.alias("market_ticker"), epoch_seconds("created_time").alias("sec"), "trade_id") \
                  .filter(F.col("market_ticker").isNotNull() & F.col("sec").isNotNull())
    best = F.max_by(F.struct("sec", "trade_id"), F.struct("sec", "trade_id"))
    return (t.groupBy("market_ticker").agg(best.alias("_b"))
             .select("market_ticker", F.col("_b.sec").alias("last_seen_trade_ts"),
                     format_epoch(F.col("_b.sec")).alias("last_seen_trade_time"),
                     F.col("_b.trade_id").alias("last_seen_trade_id")))


def merge_watermark_state(state: DataFrame | None, latest: DataFrame, checked: DataFrame, checked_through_ts: int,
                          updated_at: str, key: str = "market_ticker") -> DataFrame:
    """Advance-only merge.  ``checked`` lists the markets this run
    covered (they advance even with no prints); ``last_seen`` moves only
    forward; checked_through = max(old position, this run's)."""
    run = (checked.select(key).distinct().join(latest, key, "left")
           .withColumn("_run", F.lit(True)))
    cols = ["last_seen_trade_ts", "last_seen_trade_time", "last_seen_trade_id"]
    if state is None:
        j = run.select(key, *[F.col(c).alias(f"n_{c}") for c in cols], "_run",
                       *[F.lit(None).cast(t).alias(c) for c, t in
                         (("last_seen_trade_ts", "bigint"), ("last_seen_trade_time", "string"),
                          ("last_seen_trade_id", "string"), ("checked_through_ts", "bigint"))])
    else:
        prev_upd = F.col("updated_at") if "updated_at" in state.columns else F.lit(None).cast("string")
        s = state.select(key, *cols, watermark_position(state).alias("checked_through_ts"),
                         prev_upd.alias("_prev_updated_at"))
        j = s.join(run.select(key, *[F.col(c).alias(f"n_{c}") for c in cols], "_run"), key, "full")
    take_new = F.col("n_last_seen_trade_ts").isNotNull() & (
        F.col("last_seen_trade_ts").isNull() | (F.col("n_last_seen_trade_ts") >= F.col("last_seen_trade_ts")))
    ran = F.coalesce(F.col("_run"), F.lit(False))
    ct = F.when(ran, F.greatest(F.lit(checked_through_ts), F.coalesce(F.col("checked_through_ts"),
                                                                       F.lit(checked_through_ts))))\
          .otherwise(F.col("checked_through_ts"))
    return j.select(
        F.lit(1).alias("version"), key,
        *[F.when(take_new, F.col(f"n_{c}")).otherwise(F.col(c)).alias(c) for c in cols],
        ct.cast("bigint").alias("checked_through_ts"),
        format_epoch(ct).alias("checked_through_time"),
        F.when(ran, F.lit(updated_at)).otherwise(
            F.col("_prev_updated_at") if "_prev_updated_at" in j.columns else F.lit(None).cast("string"))
        .alias("updated_at"))


def dedupe_overlap(trades: DataFrame, order, key: str = "trade_id") -> DataFrame:
    """Overlapping fetches repeat prints; keep one row per trade id
    (the key merge)."""
    from marketlake.operators.latest import latest_per_key
    return latest_per_key(trades, [key], order)
