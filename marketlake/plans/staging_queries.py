"""Registered queries: staging, facts, dimensions, quality checks and
scope operators (P1-P20, J1-J3, A33, G1-G2, Q1-Q13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators import dims as D
from marketlake.operators import marts as M
from marketlake.operators import quality as Q
from marketlake.operators import scope as S
from marketlake.operators import staging as ST
from marketlake.operators.paths import label_window
from marketlake.plans import common as C
from marketlake.plans.registry import register
from marketlake.plans.views import with_views
from marketlake.schemas import MARKET_LOAD
from marketlake.sources import proxies as P

FULL_MARKET_COLS = {c for c, _ in MARKET_LOAD}
RAW_MARKET_COLS = {"ticker", "event_ticker", "title", "status", "result", "yes_sub_title", "no_sub_title",
                   "close_time", "liquidity_dollars", "volume_fp", "can_close_early"}
SQL_NULL = {"string": "varchar", "boolean": "boolean", "integer": "integer", "timestamp": "timestamp"}


def stg_markets_sql(src: str = "raw_markets", present=RAW_MARKET_COLS) -> str:
    cols = []
    for spec in ST.MARKET_COLUMNS:
        c, alias, kind = spec[0], spec[1], spec[2]
        if kind == "required":
            cols.append(f"{c} as {alias}")
        elif kind == "subtitle":
            if "subtitle" in present:
                cols.append(f"subtitle as {alias}")
            elif {"yes_sub_title", "no_sub_title"} <= present:
                cols.append(f"case when yes_sub_title = no_sub_title then yes_sub_title end as {alias}")
            else:
                cols.append(f"cast(null as varchar) as {alias}")
        elif c not in present:
            t = f"decimal({spec[3]},{spec[4]})" if kind == "decimal" else SQL_NULL[kind]
            cols.append(f"cast(null as {t}) as {alias}")
        elif kind == "decimal":
            cols.append(f"try_cast(cast({c} as varchar) as decimal({spec[3]},{spec[4]})) as {alias}")
        elif kind == "timestamp":
            cols.append(f"try_cast(cast({c} as varchar) as timestamp) as {alias}")
        elif kind == "string":
            cols.append(f"cast({c} as varchar) as {alias}")
        else:
            cols.append(f"{c} as {alias}")
    return f"select {', '.join(cols)} from {src}"


STG_EVENTS_SQL = """select event_ticker, series_ticker, category, title event_title, sub_title event_subtitle,
       available_on_brokers is_available_on_brokers, mutually_exclusive is_mutually_exclusive,
       collateral_return_type, try_cast(last_updated_ts as timestamp) updated_at, product_metadata
from raw_events"""
STG_SERIES_SQL = """select ticker series_ticker, category, title series_title, tags, frequency, fee_multiplier,
       fee_type, try_cast(last_updated_ts as timestamp) updated_at from raw_series"""
STG_TRADES_SQL = """select trade_id, ticker market_ticker, try_cast(count_fp as decimal(38,6)) count_fp, taker_side,
       try_cast(no_price_dollars as decimal(18,4)) no_price_dollars,
       try_cast(yes_price_dollars as decimal(18,4)) yes_price_dollars,
       try_cast(created_time as timestamp) trade_time from raw_trades"""


@register("stg_events", with_views(STG_EVENTS_SQL, "raw_events"))
def q_stg_events(spark, d):
    return ST.stg_events(P.raw_events(spark, d))


@register("stg_series", with_views(STG_SERIES_SQL, "raw_series"))
def q_stg_series(spark, d):
    return ST.stg_series(P.raw_series(spark, d))


@register("stg_trades", with_views(STG_TRADES_SQL, "raw_trades"))
def q_stg_trades(spark, d):
    return ST.stg_trades(P.raw_trades(spark, d))


@register("stg_markets", with_views(stg_markets_sql(), "raw_markets"))
def q_stg_markets(spark, d):
    return ST.stg_markets(P.raw_markets(spark, d))


# the load table holds the timer as a number
LOADED_MARKETS = ("select * replace (try_cast(settlement_timer_seconds as decimal(38,0)) as settlement_timer_seconds) "
                  "from raw_markets_full")


@register("stg_markets_full", with_views(stg_markets_sql("loaded", FULL_MARKET_COLS), "raw_markets_full",
                                         extra={"loaded": LOADED_MARKETS}))
def q_stg_markets_full(spark, d):
    """P5 with every optional column present: nested values as JSON text, bad numbers NULL."""
    return ST.stg_markets(_full_markets(spark, d))


def _full_markets(spark, d):
    """The full market rows as a load table holds them: nested values as JSON text."""
    m = P.raw_markets_full(spark, d)
    return m.withColumns({c: F.to_json(c) for c in ("custom_strike", "price_ranges")}).withColumn(
        "settlement_timer_seconds", F.expr("try_cast(settlement_timer_seconds as decimal(38,0))"))


@register("stg_orderbooks", with_views(
    "select 'MKT-' || cast(market_id as varchar) market_ticker, orderbook from book_text", "book_text"))
def q_stg_orderbooks(spark, d):
    """P4, the ladders as text."""
    return ST.stg_orderbooks(P.raw_orderbooks(spark, d))


FCT_MARKETS_SQL = ("select m.market_ticker, m.event_ticker, "
                   + ", ".join(f"e.{c}" for c in M.FCT_MARKET_EVENT_COLS) + ", "
                   + ", ".join(f"m.{s[1]}" for s in ST.MARKET_COLUMNS if s[1] not in ("market_ticker", "event_ticker"))
                   + " from sm m left join se e on e.event_ticker = m.event_ticker")


FCT_MARKETS_FULL = with_views(FCT_MARKETS_SQL, "raw_markets_full", "raw_events", extra={
    "loaded": LOADED_MARKETS, "sm": stg_markets_sql("loaded", FULL_MARKET_COLS),
    "se": STG_EVENTS_SQL + " where event_ticker not like '%7'"})


def some_events(spark, d):
    """Events with some missing, so that not every market finds one."""
    return ST.stg_events(P.raw_events(spark, d)).filter(~F.col("event_ticker").like("%7"))


@register("fct_markets", FCT_MARKETS_FULL)
def q_fct_markets(spark, d):
    """All 55 columns; markets of missing events keep their row."""
    return M.fct_markets(ST.stg_markets(_full_markets(spark, d)), some_events(spark, d))


FCT_ORDERBOOKS_SQL = with_views(
    "select b.market_ticker, m.event_ticker, e.category, e.series_ticker, e.event_title, e.event_subtitle, "
    + ", ".join(f"m.{c}" for c in M.FCT_ORDERBOOK_MARKET_COLS)
    + """, b.orderbook, cast(b.yes_level_count as int) yes_level_count, cast(b.no_level_count as int) no_level_count,
       b.yes_level_count > 0 has_yes_orders, b.no_level_count > 0 has_no_orders
from (select 'MKT-' || cast(market_id as varchar) market_ticker, any_value(orderbook) orderbook,
             count(distinct price) filter (where side = 'yes') yes_level_count,
             count(distinct price) filter (where side = 'no') no_level_count
      from levels join book_text using (market_id) group by market_id) b
left join sm m on m.market_ticker = b.market_ticker
left join se e on e.event_ticker = m.event_ticker""", "levels", "book_text", "raw_markets", "raw_events",
    extra={"sm": stg_markets_sql(), "se": STG_EVENTS_SQL})


@register("fct_orderbooks", FCT_ORDERBOOKS_SQL)
def q_fct_orderbooks(spark, d):
    return M.fct_orderbooks(ST.stg_orderbooks(P.raw_orderbooks(spark, d)), ST.stg_markets(P.raw_markets(spark, d)),
                            ST.stg_events(P.raw_events(spark, d)))


@register("hierarchy_join", with_views("""
select e.*, s.series_title, s.category series_category
from (""" + STG_EVENTS_SQL + """) e left join (""" + STG_SERIES_SQL + """) s
  on s.series_ticker = e.series_ticker and s.series_ticker not like '%3'""",
    "raw_events", "raw_series"))
def q_hierarchy_join(spark, d):
    e = ST.stg_events(P.raw_events(spark, d))
    s = ST.stg_series(P.raw_series(spark, d)).filter(~F.col("series_ticker").like("%3")).select("series_ticker", "series_title",
                                                     F.col("category").alias("series_category"))
    return M.hierarchy_join(e, s, "series_ticker", "series_ticker", ["series_title", "series_category"])


@register("trades_markets_join", with_views("""
select l.l_orderkey, l.l_linenumber, l.l_quantity, o.o_orderstatus, o.o_orderdate
from lineitem l left join orders o on o.o_orderkey = l.l_orderkey and o.o_orderkey % 8 <> 0""", ), doubles=("l_quantity",))
def q_trades_markets_join(spark, d):
    """J3 on the TPC-H hierarchy: trades (lineitem) LEFT JOIN markets (orders)."""
    li = P.h_trades(spark, d).select("l_orderkey", "l_linenumber", "l_quantity")
    orders = P.h_markets(spark, d).filter(F.col("o_orderkey") % 8 != 0)
    return M.hierarchy_join(li, orders, "l_orderkey", "o_orderkey", ["o_orderstatus", "o_orderdate"])


@register("categories", with_views("select distinct c_mktsegment category from customer where c_mktsegment is not null"))
def q_categories(spark, d):
    return M.categories(ST.stg_events(P.raw_events(spark, d)))


DIM_DATES_SQL = """
select the_date date_key, the_date, cast(day(the_date) as smallint) the_day,
       case when day(the_date) in (11, 12, 13) then 'th' when day(the_date) % 10 = 1 then 'st'
            when day(the_date) % 10 = 2 then 'nd' when day(the_date) % 10 = 3 then 'rd' else 'th' end the_day_suffix,
       dayname(the_date) the_day_name, cast(isodow(the_date) as smallint) the_day_of_week,
       cast((day(the_date) - 1) // 7 + 1 as smallint) the_day_of_week_in_month,
       cast(dayofyear(the_date) as smallint) the_day_of_year, isodow(the_date) >= 6 is_weekend,
       cast(w as smallint) the_week, cast(week(the_date) as smallint) the_iso_week,
       cast(the_date - (isodow(the_date) - 1) * interval 1 day as date) the_first_of_week,
       cast(the_date + (7 - isodow(the_date)) * interval 1 day as date) the_last_of_week,
       cast(dense_rank() over (partition by year(the_date), month(the_date) order by w) as smallint) the_week_of_month,
       cast(month(the_date) as smallint) the_month, monthname(the_date) the_month_name,
       cast(date_trunc('month', the_date) as date) the_first_of_month, last_day(the_date) the_last_of_month,
       cast(date_trunc('month', the_date) + interval 1 month as date) the_first_of_next_month,
       last_day(date_trunc('month', the_date) + interval 1 month) the_last_of_next_month,
       cast(quarter(the_date) as smallint) the_quarter,
       cast(date_trunc('quarter', the_date) as date) the_first_of_quarter,
       last_day(date_trunc('quarter', the_date) + interval 2 month) the_last_of_quarter,
       cast(year(the_date) as smallint) the_year, cast(isoyear(the_date) as smallint) the_iso_year,
       cast(date_trunc('year', the_date) as date) the_first_of_year, make_date(year(the_date), 12, 31) the_last_of_year,
       dayofyear(make_date(year(the_date), 12, 31)) = 366 is_leap_year,
       (dayofyear(make_date(year(the_date), 12, 31)) + dayofweek(make_date(year(the_date), 1, 1)) + 1 - 2) // 7 + 1 >= 53
         has_53_weeks,
       week(make_date(year(the_date), 12, 28)) = 53 has_53_iso_weeks,
       strftime(the_date, '%m%Y') mmyyyy, strftime(the_date, '%m/%d/%Y') style_101,
       strftime(the_date, '%d/%m/%Y') style_103, strftime(the_date, '%Y%m%d') style_112,
       strftime(the_date, '%Y-%m-%d') style_120
from (select the_date, (dayofyear(the_date) + dayofweek(date_trunc('year', the_date)) + 1 - 2) // 7 + 1 w
      from (select cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as date) the_date
            from (select cast(o_orderdate as date) o_orderdate from orders) o) g) x"""


@register("dim_dates", with_views(DIM_DATES_SQL))
def q_dim_dates(spark, d):
    """G1 over every date the orders table spans."""
    return D.dim_dates_from(D.date_span(P.h_markets(spark, d), "o_orderdate"))


DIM_TIMES_SQL = """
select cast(m as smallint) time_key, lpad(cast(m // 60 as varchar), 2, '0') || ':' || lpad(cast(m % 60 as varchar), 2, '0') || ':00' the_time,
       cast(m // 60 as smallint) the_hour, cast(m % 60 as smallint) the_minute, cast(m as smallint) the_minute_of_day,
       cast(case when (m // 60) % 12 = 0 then 12 else (m // 60) % 12 end as smallint) the_hour_12,
       case when m // 60 < 12 then 'AM' else 'PM' end am_pm,
       case when m // 60 >= 20 then 'night' when m // 60 >= 17 then 'evening' when m // 60 >= 13 then 'afternoon'
            when m // 60 >= 12 then 'noon' when m // 60 >= 11 then 'late_morning' when m // 60 >= 8 then 'morning'
            when m // 60 >= 5 then 'early_morning' else 'overnight' end portion_of_day,
       lpad(cast(m // 60 as varchar), 2, '0') || ':' || lpad(cast(m % 60 as varchar), 2, '0') style_hhmm,
       lpad(cast(case when (m // 60) % 12 = 0 then 12 else (m // 60) % 12 end as varchar), 2, '0') || ':'
         || lpad(cast(m % 60 as varchar), 2, '0') || ' ' || case when m // 60 < 12 then 'AM' else 'PM' end style_hhmm_12
from (select unnest(generate_series(min(hour(ts) * 60 + minute(ts)), max(hour(ts) * 60 + minute(ts)))) m
      from events) g"""


@register("dim_times", with_views(DIM_TIMES_SQL))
def q_dim_times(spark, d):
    """G2 over every minute of day the prints span."""
    return D.dim_times_from(D.minute_span(P.table(spark, d, "events"), "ts"))


# ---- quality ----

@register("dq_not_null", with_views("select * from load where ingested_at is null", "load"), doubles=("value",))
def q_dq_not_null(spark, d):
    return Q.not_null(P.load_rows(spark, d), "ingested_at")


@register("dq_unique", with_views(
    "select l_orderkey, count(*) n from lineitem where l_orderkey is not null group by 1 having count(*) > 1"))
def q_dq_unique(spark, d):
    return Q.unique(P.h_trades(spark, d).select("l_orderkey"), "l_orderkey")


@register("dq_relationship", with_views(
    "select * from orders o where o_custkey is not null and o_custkey not in (select c_custkey from customer where c_custkey % 10 <> 0)"),
    doubles=("o_totalprice",))
def q_dq_relationship(spark, d):
    """Q3 against a parent with every tenth customer missing (FIXTURES B5)."""
    parent = P.h_events(spark, d).filter(F.col("c_custkey") % 10 != 0)
    return Q.relationship(P.h_markets(spark, d), "o_custkey", parent, "c_custkey")


@register("dq_accepted_values", with_views("select * from orders where o_orderstatus not in ('F', 'O')"),
          doubles=("o_totalprice",))
def q_dq_accepted_values(spark, d):
    return Q.accepted_values(P.h_markets(spark, d), "o_orderstatus", ["F", "O"])


@register("dq_accepted_range", with_views(
    "select l_orderkey, l_linenumber, l_discount from lineitem where l_discount < 0 or l_discount > 0.05"),
    doubles=("l_discount",))
def q_dq_accepted_range(spark, d):
    li = P.h_trades(spark, d).select("l_orderkey", "l_linenumber", "l_discount")
    return Q.accepted_range(li, "l_discount", 0.0, 0.05)


@register("dq_duplicate_keys", with_views(
    "select event_ticker, ingested_at, count(*) n from load_events group by 1, 2 having count(*) > 1", "load_events"))
def q_dq_duplicate_keys(spark, d):
    return Q.duplicate_keys(P.load_entity(spark, d, "events"), ["event_ticker", "ingested_at"])


@register("dq_load_freshness", with_views("""
select 'load' table_name, count(*) row_count, max(ingested_at) latest_loaded_at from load
union all select 'load_view', count(*), max(ingested_at) from load where source_file = 'view.jsonl'""", "load"))
def q_dq_load_freshness(spark, d):
    ld = P.load_rows(spark, d)
    return Q.load_freshness({"load": ld, "load_view": ld.filter(F.col("source_file") == "view.jsonl")}, "ingested_at")


@register("dq_null_keys", with_views("select count(*) filter (where ingested_at is null) null_keys from load", "load"))
def q_dq_null_keys(spark, d):
    return Q.null_keys(P.load_rows(spark, d), "ingested_at")


@register("dq_single_row", with_views(
    "select market_id, count(*) n from (select market_id from markets union all select market_id from markets "
    "where market_id % 10 = 0) m group by 1 having count(*) <> 1", "markets"))
def q_dq_single_row(spark, d):
    """Q10: every tenth market is there twice."""
    m = P.markets(spark, d)
    return Q.single_row(m.unionByName(m.filter(F.col("market_id") % 10 == 0)), "market_id")


@register("dq_window_bounds", with_views("""
select market_id, min(trade_time) first_trade_time, max(trade_time) last_trade_time, min(game_start) game_start
from (select * replace (case when market_id % 7 = 0 then timestamp '2030-01-01 00:00:00' else game_start end as game_start)
      from trades) t group by market_id
having not (min(trade_time) < min(game_start) and min(game_start) < max(trade_time))""", "trades"))
def q_dq_window_bounds(spark, d):
    """Q11: every seventh market's start lies behind its prints."""
    late = F.when(F.col("market_id") % 7 == 0, F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")).otherwise(F.col("game_start"))
    return Q.window_bounds(C.trades(spark, d).withColumn("game_start", late))


@register("dq_price_complement", with_views(
    "select * from (" + STG_TRADES_SQL + ") s where abs(yes_price_dollars + no_price_dollars - 1) > 0.01",
    "raw_trades"))
def q_dq_price_complement(spark, d):
    return Q.price_complement(ST.stg_trades(P.raw_trades(spark, d)), "yes_price_dollars", "no_price_dollars", 0.01)


@register("run_row_counts", with_views("select source_file, count(*) rows_written from load group by 1", "load"))
def q_run_row_counts(spark, d):
    return Q.run_row_counts(P.load_rows(spark, d), "source_file")


SUITE = [Q.Rule("markets", "unique", ("o_orderkey",)), Q.Rule("markets", "not_null", ("o_custkey", "o_orderdate")),
         Q.Rule("markets", "accepted_values", ("o_orderstatus",), values=("F", "O")), Q.Rule("markets", "accepted_range", ("o_totalprice",), lo=1000, hi=400000),
         Q.Rule("markets", "relationship", ("o_custkey",), parent="events", parent_column="c_custkey"),
         Q.Rule("trades", "relationship", ("l_orderkey",), parent="markets", parent_column="o_orderkey"),
         Q.Rule("trades", "unique", ("l_orderkey", "l_linenumber")), Q.Rule("trades", "unique", ("l_partkey",)),
         Q.Rule("trades", "accepted_range", ("l_discount",), hi=0.05), Q.Rule("trades", "holds", condition="l_quantity > 10"),
         Q.Rule("trades", "not_null", ("l_shipdate",))]


def _suite_tables(spark, d):
    return {"markets": P.h_markets(spark, d), "trades": P.h_trades(spark, d), "events": P.h_events(spark, d).where("c_custkey % 7 <> 0")}


@register("dq_suite", """
with e as (select * from customer where c_custkey % 7 <> 0), m as (select count(*) n from orders), t as (select count(*) n from lineitem)
select 'markets.unique(o_orderkey)' as rule, m.n as checked_rows, (select count(*) from (select 1 from orders where o_orderkey is not null group by o_orderkey having count(*) > 1) x) as failing from m
union all select 'markets.not_null(o_custkey, o_orderdate)', m.n, (select count(*) from orders where o_custkey is null or o_orderdate is null) from m
union all select 'markets.accepted_values(o_orderstatus)', m.n, (select count(*) from orders where o_orderstatus not in ('F', 'O')) from m
union all select 'markets.accepted_range(o_totalprice)', m.n, (select count(*) from orders where o_totalprice not between 1000 and 400000) from m
union all select 'markets.relationship(o_custkey)', m.n, (select count(*) from orders where o_custkey is not null and o_custkey not in (select c_custkey from e)) from m
union all select 'trades.relationship(l_orderkey)', t.n, (select count(*) from lineitem where l_orderkey is not null and l_orderkey not in (select o_orderkey from orders)) from t
union all select 'trades.unique(l_orderkey, l_linenumber)', t.n, (select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1) x) from t
union all select 'trades.unique(l_partkey)', t.n, (select count(*) from (select 1 from lineitem where l_partkey is not null group by l_partkey having count(*) > 1) x) from t
union all select 'trades.accepted_range(l_discount)', t.n, (select count(*) from lineitem where l_discount > 0.05) from t
union all select 'trades.holds(l_quantity > 10)', t.n, (select count(*) from lineitem where not l_quantity > 10) from t
union all select 'trades.not_null(l_shipdate)', t.n, (select count(*) from lineitem where l_shipdate is null) from t""")
def q_dq_suite(spark, d):
    """Q1-Q6, Q8, Q12 as one suite: every rule of markets and trades from one scan of each table."""
    return Q.run_suite(_suite_tables(spark, d), SUITE)


# ---- scope ----

@register("scope_filter", with_views("select * from trades where series_ticker = 'SERIES-1'", "trades"),
          doubles=("price",))
def q_scope_filter(spark, d):
    return S.scope_filter(C.trades(spark, d), series="SERIES-1", series_col="series_ticker")


@register("status_filter", with_views("select * from raw_markets where status = 'O'", "raw_markets"))
def q_status_filter(spark, d):
    return S.status_filter(P.raw_markets(spark, d), "O")


# The series titles of the scope query.
TITLES = ["Pro Baseball Spread", "Pro Baseball Total Bases", "Pro Baseball Hits", "Pro Baseball Total Points",
          "First 5 Innings Spread", "First 5 Innings Total", "First 5 Innings Winner"]


@register("series_scope_query", with_views(
    "select * from raw_series where category = 'Sports' and list_contains(tags, 'Baseball') and ticker like '%S1%' "
    "and title in (" + ", ".join(f"'{t}'" for t in TITLES) + ")", "raw_series"))
def q_series_scope_query(spark, d):
    return S.series_scope(P.raw_series(spark, d), "Sports", "Baseball", "%S1%", TITLES)


@register("tag_match_all", with_views(
    "select * from raw_series where tags is not null and list_contains(list_transform(tags, lambda x: lower(x)), 'baseball')",
    "raw_series"))
def q_tag_match_all(spark, d):
    return S.tags_match_all(P.raw_series(spark, d), ["BaseBall"])


@register("active_slate", with_views("""
select distinct event_ticker from gt
where try_strptime(upper(substr(split_part(event_ticker, '-', 2), 1, 7)), '%y%b%d') = date '2024-01-16'""", "gt"))
def q_active_slate(spark, d):
    ev = P.game_tickers(spark, d).select("event_ticker", F.lit("KXGAME").alias("series_ticker")).distinct()
    return S.active_slate(ev, ["KXGAME"], "2024-01-16")


@register("scope_keys", with_views("select distinct ticker from load where ticker is not null and trim(ticker) <> ''",
                                   "load"))
def q_scope_keys(spark, d):
    return S.scope_keys(P.load_rows(spark, d), "ticker")


@register("parse_event_ticker", with_views("""
select *, split_part(event_ticker, '-', 1) series_code, substr(split_part(event_ticker, '-', 2), 1, 7) date_code,
       substr(split_part(event_ticker, '-', 2), 8, 4) start_hhmm, substr(split_part(event_ticker, '-', 2), 12) team_codes,
       try_strptime(substr(split_part(event_ticker, '-', 2), 1, 11), '%y%b%d%H%M') game_start_et,
       (try_strptime(substr(split_part(event_ticker, '-', 2), 1, 11), '%y%b%d%H%M') at time zone 'America/New_York')
         at time zone 'UTC' game_start_utc
from gt""", "gt"))
def q_parse_event_ticker(spark, d):
    return S.parse_event_ticker(P.game_tickers(spark, d))


@register("contract_team_code", with_views(
    "select market_ticker, split_part(market_ticker, '-', -1) team_code from gt", "gt"))
def q_contract_team_code(spark, d):
    return P.game_tickers(spark, d).select("market_ticker", S.contract_team_code().alias("team_code"))


@register("coerce_numeric", with_views(
    "select ticker, try_cast(case when ticker like '%1' then 'n/a' else liquidity_dollars end as double) liquidity_dollars, "
    "try_cast(volume_fp as double) volume_fp from raw_markets", "raw_markets"), doubles=("liquidity_dollars", "volume_fp"))
def q_coerce_numeric(spark, d):
    m = P.raw_markets(spark, d).select("ticker", "volume_fp", F.when(F.col("ticker").like("%1"), F.lit("n/a"))
                                       .otherwise(F.col("liquidity_dollars")).alias("liquidity_dollars"))
    return S.coerce_numeric(m, ["liquidity_dollars", "volume_fp", "not_there"])


@register("label_window_right", with_views("""
select trade_id, market_id, trade_time, game_start,
       case when trade_time <= game_start then 'pregame' else 'live' end "window" from trades""", "trades", trades="edge_trades"))
def q_label_window_right(spark, d):
    t = P.edge_trades(C.trades(spark, d)).select("trade_id", "market_id", "trade_time", "game_start")
    return label_window(t, "right")
