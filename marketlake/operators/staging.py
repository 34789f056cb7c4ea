"""Typed staging projections of the raw current-state tables.

Raw columns are mostly text; staging renames and casts them with the
``try_`` forms so bad values become NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Staging output contracts (source column, output column, kind[, precision, scale]).
# Kinds: string, boolean, integer, decimal, timestamp.
MARKET_COLUMNS = [
    ("ticker", "market_ticker", "required"),
    ("event_ticker", "event_ticker", "required"),
    ("title", "market_title", "required"),
    ("market_type", "market_type", "string"),
    ("status", "market_status", "string"),
    ("result", "market_result", "string"),
    ("subtitle", "market_subtitle", "subtitle"),
    ("yes_sub_title", "yes_subtitle", "string"),
    ("no_sub_title", "no_subtitle", "string"),
    ("rules_primary", "primary_rules", "string"),
    ("rules_secondary", "secondary_rules", "string"),
    ("response_price_units", "response_price_units", "string"),
    ("price_level_structure", "price_level_structure", "string"),
    ("strike_type", "strike_type", "string"),
    ("expiration_value", "expiration_value", "string"),
    ("early_close_condition", "early_close_condition", "string"),
    ("primary_participant_key", "primary_participant_key", "string"),
    ("can_close_early", "can_close_early", "boolean"),
    ("fractional_trading_enabled", "is_fractional_trading_enabled", "boolean"),
    ("created_time", "created_at", "timestamp"),
    ("open_time", "open_at", "timestamp"),
    ("close_time", "close_at", "timestamp"),
    ("expected_expiration_time", "expected_expiration_at", "timestamp"),
    ("expiration_time", "expiration_at", "timestamp"),
    ("latest_expiration_time", "latest_expiration_at", "timestamp"),
    ("updated_time", "updated_at", "timestamp"),
    ("fee_waiver_expiration_time", "fee_waiver_expiration_at", "timestamp"),
    ("last_price_dollars", "last_price_dollars", "decimal", 18, 4),
    ("liquidity_dollars", "liquidity_dollars", "decimal", 18, 4),
    ("no_ask_dollars", "no_ask_dollars", "decimal", 18, 4),
    ("no_bid_dollars", "no_bid_dollars", "decimal", 18, 4),
    ("notional_value_dollars", "notional_value_dollars", "decimal", 18, 4),
    ("previous_price_dollars", "previous_price_dollars", "decimal", 18, 4),
    ("previous_yes_ask_dollars", "previous_yes_ask_dollars", "decimal", 18, 4),
    ("previous_yes_bid_dollars", "previous_yes_bid_dollars", "decimal", 18, 4),
    ("yes_ask_dollars", "yes_ask_dollars", "decimal", 18, 4),
    ("yes_bid_dollars", "yes_bid_dollars", "decimal", 18, 4),
    ("open_interest_fp", "open_interest_fp", "decimal", 38, 6),
    ("volume_24h_fp", "volume_24h_fp", "decimal", 38, 6),
    ("volume_fp", "volume_fp", "decimal", 38, 6),
    ("yes_ask_size_fp", "yes_ask_size_fp", "decimal", 38, 6),
    ("yes_bid_size_fp", "yes_bid_size_fp", "decimal", 38, 6),
    ("settlement_timer_seconds", "settlement_timer_seconds", "integer"),
    ("tick_size", "tick_size", "string"),
    ("floor_strike", "floor_strike", "decimal", 18, 4),
    ("cap_strike", "cap_strike", "decimal", 18, 4),
    ("custom_strike", "custom_strike", "string"),
    ("price_ranges", "price_ranges", "string"),
]

EVENT_COLUMNS = [("event_ticker", "event_ticker"), ("series_ticker", "series_ticker"), ("category", "category"),
                 ("title", "event_title"), ("sub_title", "event_subtitle"),
                 ("available_on_brokers", "is_available_on_brokers"),
                 ("mutually_exclusive", "is_mutually_exclusive"),
                 ("collateral_return_type", "collateral_return_type")]
SERIES_COLUMNS = [("ticker", "series_ticker"), ("category", "category"), ("title", "series_title"),
                  ("tags", "tags"), ("frequency", "frequency"), ("fee_multiplier", "fee_multiplier"),
                  ("fee_type", "fee_type")]

NULL_TYPES = {"string": "string", "boolean": "boolean", "integer": "int", "timestamp": "timestamp_ntz"}


def optional(df: DataFrame, col: str, alias: str, kind: str, p: int | None = None,
             s: int | None = None) -> Column:
    """Cast the column when the frame has it, else a typed NULL.
    Decimal and timestamp go through text first so float or text sources
    both cast."""
    present = col in df.columns
    if kind == "decimal":
        if present:
            return F.expr(f"try_cast(cast(`{col}` as string) as decimal({p},{s}))").alias(alias)
        return F.lit(None).cast(f"decimal({p},{s})").alias(alias)
    if kind == "timestamp":
        if present:
            return F.expr(f"try_cast(cast(`{col}` as string) as timestamp_ntz)").alias(alias)
        return F.lit(None).cast("timestamp_ntz").alias(alias)
    if present:
        c = F.col(col)
        return (c.cast("string") if kind == "string" else c).alias(alias)
    return F.lit(None).cast(NULL_TYPES[kind]).alias(alias)


def market_subtitle(df: DataFrame) -> Column:
    """The raw subtitle when the table has that column (no per-row
    fallback); else the YES label when both labels agree; else NULL."""
    if "subtitle" in df.columns:
        return F.col("subtitle").cast("string").alias("market_subtitle")
    if "yes_sub_title" in df.columns and "no_sub_title" in df.columns:
        return F.when(F.col("yes_sub_title") == F.col("no_sub_title"), F.col("yes_sub_title")) \
                .cast("string").alias("market_subtitle")
    return F.lit(None).cast("string").alias("market_subtitle")


def stg_markets(raw: DataFrame) -> DataFrame:
    """P5: 3 required + 44 optional columns + derived subtitle (48 columns)."""
    cols = []
    for spec in MARKET_COLUMNS:
        src, alias, kind = spec[0], spec[1], spec[2]
        if kind == "required":
            cols.append(F.col(src).alias(alias))
        elif kind == "subtitle":
            cols.append(market_subtitle(raw))
        else:
            cols.append(optional(raw, src, alias, kind, *spec[3:]))
    return raw.select(*cols)


def stg_events(raw: DataFrame) -> DataFrame:
    """Rename, ``last_updated_ts`` -> NTZ (NULL when unparseable)."""
    return raw.select(*[F.col(a).alias(b) for a, b in EVENT_COLUMNS],
                      F.expr("try_cast(last_updated_ts as timestamp_ntz)").alias("updated_at"),
                      F.col("product_metadata").alias("product_metadata"))


def stg_series(raw: DataFrame) -> DataFrame:
    """P2."""
    return raw.select(*[F.col(a).alias(b) for a, b in SERIES_COLUMNS],
                      F.expr("try_cast(last_updated_ts as timestamp_ntz)").alias("updated_at"))


def stg_trades(raw: DataFrame) -> DataFrame:
    """Text -> decimal(38,6) size, decimal(18,4) prices, NTZ time; the
    key is ``ticker`` or, in older payloads, ``market_ticker``."""
    key = (F.coalesce(F.col("ticker"), F.col("market_ticker")) if "market_ticker" in raw.columns
           and "ticker" in raw.columns else F.col("ticker" if "ticker" in raw.columns else "market_ticker"))
    return raw.select(
        F.col("trade_id"), key.alias("market_ticker"),
        F.expr("try_cast(cast(count_fp as string) as decimal(38,6))").alias("count_fp"),
        F.col("taker_side"),
        F.expr("try_cast(cast(no_price_dollars as string) as decimal(18,4))").alias("no_price_dollars"),
        F.expr("try_cast(cast(yes_price_dollars as string) as decimal(18,4))").alias("yes_price_dollars"),
        F.expr("try_cast(created_time as timestamp_ntz)").alias("trade_time"))


def stg_orderbooks(raw: DataFrame) -> DataFrame:
    """P4."""
    return raw.select("market_ticker", "orderbook")


# Team dimension columns.
TEAM_COLUMNS = ["team_id", "full_team_name", "team_code", "abbreviation", "team_name", "location_name",
                "first_year_of_play", "sport_id", "sport_name", "league_id", "league_name", "division_id",
                "division_name", "venue_id", "venue_name", "is_active", "ingested_at", "loaded_at"]


def dim_teams(latest_teams: DataFrame) -> DataFrame:
    """Project the latest team row (see latest_per_key with the teams
    ordering) to the dimension's 18 columns; ``ingested_at`` is exposed as
    ``source_ingested_at``, payload and file columns stay behind."""
    return latest_teams.select(*TEAM_COLUMNS).withColumnRenamed("ingested_at", "source_ingested_at")
