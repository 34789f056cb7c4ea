"""Table specs: keys and latest-row ordering for each current-state table.

Ordering terms are SQL expression text (evaluated lazily with F.expr)."""

from __future__ import annotations

# Ordering terms as (column, direction).  "desc_nulls_first" reproduces the
# warehouse's plain DESC (NULL sorts highest there).
INGEST_ORDER = [("ingested_at", "desc_nulls_last"), ("loaded_at", "desc_nulls_last"),
                ("source_file", "desc_nulls_first"), ("source_row_number", "desc_nulls_first")]


def try_ts(col: str) -> str:
    """SQL text: text -> TIMESTAMP_NTZ, NULL when unparseable.  A trailing
    'Z' is accepted and dropped, as the warehouse's TRY_TO_TIMESTAMP_NTZ does."""
    return f"try_cast({col} as timestamp_ntz)"


TABLE_SPECS = {
    "markets": {"keys": ["ticker"],
                "order": [(try_ts("updated_time"), "desc_nulls_last")] + INGEST_ORDER},
    "orderbooks": {"keys": ["market_ticker"], "order": INGEST_ORDER},
    "trades": {"keys": ["trade_id"],
               "order": [(try_ts("created_time"), "desc_nulls_last")] + INGEST_ORDER},
    "events": {"keys": ["event_ticker"], "order": INGEST_ORDER},
    "series": {"keys": ["ticker"], "order": INGEST_ORDER},
    # dbt staging of teams: plain DESC on every term -> NULLs first
    "teams": {"keys": ["team_id"],
              "order": [("ingested_at", "desc_nulls_first"), ("loaded_at", "desc_nulls_first"),
                        ("source_file", "desc_nulls_first"), ("source_row_number", "desc_nulls_first")]},
}


# The columns of the market load table, in order, with the kind of their landed values.
MARKET_LOAD = [
    ("ticker", "string"), ("event_ticker", "string"), ("market_type", "string"), ("status", "string"),
    ("result", "string"), ("title", "string"), ("subtitle", "string"), ("yes_sub_title", "string"),
    ("no_sub_title", "string"), ("rules_primary", "string"), ("rules_secondary", "string"),
    ("response_price_units", "string"), ("price_level_structure", "string"), ("strike_type", "string"),
    ("expiration_value", "string"), ("early_close_condition", "string"), ("primary_participant_key", "string"),
    ("can_close_early", "boolean"), ("fractional_trading_enabled", "boolean"), ("created_time", "time"),
    ("open_time", "time"), ("close_time", "time"), ("expected_expiration_time", "time"), ("expiration_time", "time"),
    ("latest_expiration_time", "time"), ("updated_time", "time"), ("fee_waiver_expiration_time", "time"),
    ("last_price_dollars", "price"), ("liquidity_dollars", "price"), ("no_ask_dollars", "price"),
    ("no_bid_dollars", "price"), ("notional_value_dollars", "price"), ("previous_price_dollars", "price"),
    ("previous_yes_ask_dollars", "price"), ("previous_yes_bid_dollars", "price"), ("yes_ask_dollars", "price"),
    ("yes_bid_dollars", "price"), ("open_interest_fp", "size"), ("volume_24h_fp", "size"), ("volume_fp", "size"),
    ("yes_ask_size_fp", "size"), ("yes_bid_size_fp", "size"), ("settlement_timer_seconds", "number"),
    ("tick_size", "string"), ("floor_strike", "price"), ("cap_strike", "price"), ("custom_strike", "object"),
    ("price_ranges", "array"), ("ingested_at", "timestamp")]
# how a load column is read from the payload: text, except these kinds
LOAD_KIND = {"boolean": "boolean", "number": "number", "object": "json", "array": "json", "timestamp": "time"}
MARKET_SPEC = [(f"$.{c}", c, LOAD_KIND.get(kind, "string")) for c, kind in MARKET_LOAD]


def order_for(table: str, columns: list[str]):
    """The spec's ordering restricted to columns the frame has."""
    out = []
    for term, d in TABLE_SPECS[table]["order"]:
        if term.isidentifier() and term not in columns:
            continue
        out.append((term, d))
    return out
