"""Registered queries for the remaining inventory items: teams history,
per-entity latest rows, path utilities, schema checks and retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marketlake.operators.quantiles import average_rank
from marketlake.operators import latest as L
from marketlake.operators import market_stats as MS
from marketlake.operators import paths as PA
from marketlake.operators import pairs as PR
from marketlake.operators import quality as Q
from marketlake.operators import repricing as R
from marketlake.operators import schema_ops as SO
from marketlake.operators import staging as ST
from marketlake.operators.incremental import watermark_position
from marketlake.operators.scope import market_spec
from marketlake.plans import common as C
from marketlake.plans.ingest_queries import _state1
from marketlake.plans.registry import register
from marketlake.plans.state_queries import LOAD_COLS, entity_sql, merge_sql
from marketlake.plans.views import with_views
from marketlake.schemas import order_for
from marketlake.session import shared_dir
from marketlake.sources import jsonl as J
from marketlake.sources import proxies as P
from marketlake.sources import tables as TB

TEAM_COLS = ["team_id", "full_team_name", "team_code", "abbreviation", "team_name", "location_name",
             "first_year_of_play", "sport_id", "sport_name", "league_id", "league_name", "division_id",
             "division_name", "venue_id", "venue_name", "is_active", "ingested_at", "source_file", "source_row_number", "loaded_at"]


def _teams(spark, d):
    snaps = P.team_snapshots(spark, d)
    flat = J.flatten_team(snaps, "payload", keep=("ingested_at", "source_file", "source_row_number", "loaded_at"))
    return flat.withColumnRenamed("name", "full_team_name").withColumnRenamed("active", "is_active")


@register("flatten_team_payload", with_views(f"select {', '.join(TEAM_COLS)} from teams", "teams"))
def q_flatten_team_payload(spark, d):
    """S3 (+ S9 typing): nested team payloads to 18 flat columns."""
    return _teams(spark, d).select(*TEAM_COLS)


# The columns of the team load table (beside the audit columns).
TEAM_SPEC = [(f"$.{c}", c, k) for c, k in (
    ("team_id", "number"), ("name", "string"), ("team_code", "string"), ("abbreviation", "string"),
    ("team_name", "string"), ("location_name", "string"), ("first_year_of_play", "number"), ("sport_id", "number"),
    ("sport_name", "string"), ("league_id", "number"), ("league_name", "string"), ("division_id", "number"),
    ("division_name", "string"), ("venue_id", "number"), ("venue_name", "string"), ("active", "boolean"),
    ("ingested_at", "time"))]


@register("scan_teams_jsonl", with_views(
    "select team_id, full_team_name \"name\", team_code, abbreviation, team_name, location_name, "
    "cast(first_year_of_play as decimal(38,0)) first_year_of_play, sport_id, sport_name, league_id, league_name, division_id, "
    "division_name, venue_id, venue_name, is_active active, ingested_at, true numbered from teams", "teams"))
def q_scan_teams_jsonl(spark, d):
    """Flattened teams landed as JSONL and scanned back with the whole load contract."""
    root = shared_dir(spark, "teams")
    flat = J.flatten_team(P.team_snapshots(spark, d), "payload", keep=("ingested_at",)).drop("raw_payload")
    J.land(flat, root, "teams", dt.datetime(2024, 1, 16, tzinfo=dt.timezone.utc))
    good, _ = J.scan_jsonl(spark, root, TEAM_SPEC)
    ids = [c for c in good.columns if c.endswith("_id")]
    return good.select(*[c for _, c, _ in TEAM_SPEC], (F.col("source_row_number") > 0).alias("numbered")).withColumns(
        {c: F.col(c).cast("bigint") for c in ids})


TEAMS_ORDER = [("ingested_at", "desc_nulls_first"), ("loaded_at", "desc_nulls_first"), ("source_file", "desc_nulls_first"),
               ("source_row_number", "desc_nulls_first")]


@register("dim_teams", with_views(
    "select * exclude (rn, ingested_at, source_file, source_row_number), ingested_at source_ingested_at "
    "from (select *, row_number() over (partition by team_id "
    "order by ingested_at desc nulls first, loaded_at desc nulls first, source_file desc nulls first, source_row_number desc nulls first) rn "
    "from teams) x where rn = 1", "teams"))
def q_dim_teams(spark, d):
    """W3f + P8: latest snapshot per team (plain DESC = NULLs first), renamed."""
    t = _teams(spark, d).select(*TEAM_COLS)
    return ST.dim_teams(L.latest_per_key(t, ["team_id"], TEAMS_ORDER))


def _load(spark, d):
    return P.load_rows(spark, d)


@register("latest_orderbooks", with_views(entity_sql("orderbooks", "market_ticker"), "load_orderbooks"))
def q_latest_orderbooks(spark, d):
    """Ingest ordering (no business timestamp)."""
    df = P.load_entity(spark, d, "orderbooks")
    return L.latest_per_key(df, ["market_ticker"], order_for("orderbooks", df.columns))


@register("latest_series", with_views(entity_sql("series", "ticker"), "load_series"))
def q_latest_series(spark, d):
    """W3e."""
    df = P.load_entity(spark, d, "series")
    return L.latest_per_key(df, ["ticker"], order_for("series", df.columns))


@register("latest_trades", with_views(
    "select * exclude (rn) from (select *, row_number() over (partition by trade_id order by "
    "try_cast(created_time as timestamp) desc nulls last, ingested_at desc nulls last, source_file desc nulls first, "
    "source_row_number desc nulls first) rn from (select ticker trade_id, updated_time created_time, ingested_at, "
    "source_file, source_row_number, value from load) l) x where rn = 1", "load"), doubles=("value",))
def q_latest_trades(spark, d):
    """W3c: per trade id, by the parsed creation time first."""
    df = _load(spark, d).select(F.col("ticker").alias("trade_id"), F.col("updated_time").alias("created_time"),
                                "ingested_at", "source_file", "source_row_number", "value")
    return L.latest_per_key(df, ["trade_id"], order_for("trades", df.columns))


@register("drop_duplicate_keys", with_views(
    f"select {LOAD_COLS} from (select *, row_number() over (partition by ticker, ingested_at "
    "order by source_row_number desc) rn from load) x where rn = 1", "load"), doubles=("value",))
def q_drop_duplicate_keys(spark, d):
    """One row per key kept (the latest load row), not every copy dropped."""
    return L.drop_duplicate_keys(_load(spark, d), ["ticker", "ingested_at"], [("source_row_number", "desc_nulls_first")])


@register("merge_rows", with_views(
    f"select {LOAD_COLS} from load union all "
    f"select {LOAD_COLS} from load where source_file = 'view.jsonl'", "load"), doubles=("value",))
def q_merge_rows(spark, d):
    """A key-less table only appends, rows it has already too."""
    ld = _load(spark, d)
    return L.merge_rows(ld, ld.filter(F.col("source_file") == "view.jsonl"), None, [])


@register("merge_rows_keyed", merge_sql("b1", "b2"), doubles=("value",))
def q_merge_rows_keyed(spark, d):
    """A keyed table upserts."""
    ld = _load(spark, d)
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    order = order_for("markets", ld.columns)
    target = L.latest_per_key(ld.filter(F.col("event_time") < cut), ["ticker"], order)
    return L.merge_rows(target, ld.filter(F.col("event_time") >= cut), ["ticker"], order)


@register("path_deltas", with_views("""
select market_id, minute, price, price - lag(price) over (partition by market_id order by minute) delta,
       abs(price - lag(price) over (partition by market_id order by minute)) abs_delta
from (select g.market_id, g.minute, last_value(b.price ignore nulls) over
        (partition by g.market_id order by g.minute rows between unbounded preceding and current row) price
      from (select market_id, unnest(generate_series(min(bucket), max(bucket), interval 1 minute)) as minute
            from b0 group by market_id) g
      left join b0 b on b.market_id = g.market_id and b.bucket = g.minute) p""", "trades", extra={
    "b0": "select market_id, date_trunc('minute', trade_time) bucket, arg_max(price, (trade_time, trade_id)) price "
          "from trades group by 1, 2"}, trades="near_trades"), doubles=("price", "delta", "abs_delta"), near=True)
def q_path_deltas(spark, d):
    """W4 on the one-minute path (rows are buckets, bounded per market)."""
    return PA.path_deltas(PA.minute_path(C.trades(spark, d), "minute"), "market_id", ["minute"], "price")


@register("average_rank", with_views("""
select market_id, series_ticker, average_price,
       rank() over (partition by series_ticker order by average_price)
         + (count(*) over (partition by series_ticker, average_price) - 1) / 2.0 price_rank
from (select market_id, series_ticker, round(avg(price), 6) average_price from trades group by 1, 2) s""", "trades"),
    doubles=("average_price", "price_rank"))
def q_average_rank(spark, d):
    """Ties share the mean of their ranks."""
    s = C.trades(spark, d).groupBy("market_id", "series_ticker").agg(F.round(F.avg("price"), 6).alias("average_price"))
    return average_rank(s, ["series_ticker"], "average_price", "price_rank").select(
        "market_id", "series_ticker", "average_price", "price_rank")


@register("first_last_trade", with_views("""
select market_id, arg_min(trade_id, (trade_time, trade_id)) first_trade_id, min(trade_time) first_trade_time,
       arg_min(price, (trade_time, trade_id)) first_price, arg_max(trade_id, (trade_time, trade_id)) last_trade_id,
       max(trade_time) last_trade_time, arg_max(price, (trade_time, trade_id)) last_price
from trades group by market_id""", "trades"), doubles=("first_price", "last_price"))
def q_first_last_trade(spark, d):
    """W7 / O3."""
    return PA.first_last_trade(C.trades(spark, d))


@register("row_shift", with_views("""
select a.game_id, a.minute, a.loser_implied, l.lag, b.loser_implied shifted
from (select *, row_number() over (partition by game_id order by minute) rn from pp) a
cross join (select unnest(range(-10, 11)) lag) l
left join (select *, row_number() over (partition by game_id order by minute) rn from pp) b
  on b.game_id = a.game_id and b.rn = a.rn + l.lag""", "pp", trades="near_trades"), doubles=("loser_implied", "shifted"), near=True)
def q_row_shift(spark, d):
    """Shifted copies -10..10 rows of the loser-implied pair path."""
    pp = PR.pair_path(C.pregame(spark, d), PR.winner_loser_pairs(C.markets_outcome(spark, d)), "minute")
    return PA.row_shift(pp.select("game_id", "minute", "loser_implied"), "game_id", ["minute"], "loser_implied")


@register("sorted_pregame_summary", with_views(
    "select game_id, market_id, brier_improvement from msum order by game_id nulls first, brier_improvement desc nulls last", "msum"),
    doubles=("brier_improvement",))
def q_sorted_pregame_summary(spark, d):
    """O2: multi-key output order, mixed directions (a range-partitioned sort)."""
    s = R.pregame_market_summary(C.pregame(spark, d))
    return s.select("game_id", "market_id", "brier_improvement").orderBy(
        F.col("game_id").asc_nulls_first(), F.col("brier_improvement").desc_nulls_last())


@register("trades_in_scope", with_views(
    "select * from trades where market_id in (select market_id from markets where market_result is not null)",
    "trades", "markets"), doubles=("price",))
def q_trades_in_scope(spark, d):
    """Prints whose market is in a filtered set (left semi join)."""
    t = C.trades(spark, d)
    m = P.markets(spark, d, t).filter(F.col("market_result").isNotNull())
    return t.join(m.select("market_id"), "market_id", "left_semi")


@register("jump_count", with_views("""
select game_id, count(*) filter (where a >= 0.05) jumps from (
  select game_id, abs(winner_probability - lag(winner_probability) over (partition by game_id order by minute)) a
  from lpath) x group by game_id""", "lpath", trades="near_trades"), near=True)
def q_jump_count(spark, d):
    """Live-path steps with an absolute move of at least 5 cents."""
    lp = PR.live_path(C.scored(spark, d), PR.winner_loser_pairs(C.markets_outcome(spark, d)), "minute")
    deltas = PA.path_deltas(lp, "game_id", ["minute"], "winner_probability")
    return MS.jump_count(deltas, "game_id", "abs_delta", 0.05)


@register("watermark_position", with_views("""
select market_ticker, checked_through_ts position from st""", "raw_trades", extra={
    "st": __import__("marketlake.plans.ingest_queries", fromlist=["STATE1_SQL"]).STATE1_SQL}))
def q_watermark_position(spark, d):
    """First non-NULL of checked-through, max-created, last-seen."""
    s = _state1(spark, d)
    return s.select("market_ticker", watermark_position(s).alias("position"))


@register("schema_drift", with_views("""
select * from (select 'event_time' column_name, 'added' change, count(event_time) filled_rows from load
  union all select unnest(['ingested_date', 'loaded_at', 'raw_payload']), 'removed', 0) v""", "load"))
def q_schema_drift(spark, d):
    """Columns that landed rows have beyond the load table's, with
    the number of rows that fill them, and declared ones they lack."""
    known = ["ticker", "updated_time", "ingested_at", "source_file", "source_row_number", "value", "raw_payload",
             "loaded_at", "ingested_date"]
    return SO.drift_report(_load(spark, d), known)


@register("dq_column_contract", with_views("""
select 'missing market_ticker' problem, count(*) affected_rows from book_text
union all select 'unexpected market_id', count(market_id) from book_text""", "book_text"))
def q_dq_column_contract(spark, d):
    """Q9: the order-book frame against its documented columns; every finding
    with the rows it concerns (all for a missing column, filled ones for an
    unexpected one)."""
    return Q.contract_report(P.books(spark, d), ["market_ticker", "orderbook"])


RETENTION_RUN = dt.datetime(2024, 1, 30, 3, 0)   # two days back: the 28th


@register("retention_cleanup", with_views(
    "select ticker, source_row_number, true refused_while_pending from load "
    "where cast(event_time as date) >= date '2024-01-28'", "load"))
def q_retention_cleanup(spark, d):
    """T4: date-partitioned load table; partitions of more than two days
    before the run are dropped once the merge has taken every load row.  The
    backlog is what lies past the merged table's own mark: before the second
    batch is merged nothing may go."""
    path, now = shared_dir(spark, "retention"), TB.fresh_name("retention_now")
    ld = _load(spark, d).withColumn("ingested_date", F.to_date("event_time").cast("string"))
    ld.select("ticker", "updated_time", "ingested_at", "source_file", "source_row_number", "ingested_date").write.partitionBy("ingested_date").parquet(path)
    load = spark.read.parquet(path).withColumn("ingested_date", F.col("ingested_date").cast("string"))
    order = order_for("markets", load.columns)
    cutoff = TB.retention_cutoff(RETENTION_RUN)
    merge = lambda rows, batch: TB.keyed_load(spark, rows, now, ["ticker"], order, batch, guard=True, progress="ingested_date")
    merge(load.filter("ingested_date < '2024-01-20'"), "first")
    refused = not TB.retention_cleanup(spark, path, cutoff, TB.pending_rows(load, now, "ingested_date"))
    merge(load.filter("ingested_date >= '2024-01-20'"), "second")
    TB.retention_cleanup(spark, path, cutoff, TB.pending_rows(load, now, "ingested_date"))
    return spark.read.parquet(path).select("ticker", "source_row_number", F.lit(refused).alias("refused_while_pending"))


@register("retention_all_loads", with_views("""
select 'markets' entity, ticker load_key, source_row_number from load where cast(event_time as date) >= date '2024-01-28'
union all select 'trades', cast(trade_id as varchar), trade_id from trades where cast(trade_time as date) >= date '2024-01-28'
union all select 'series', ticker, source_row_number from load""", "load", "trades"))
def q_retention_all_loads(spark, d):
    """T4 over all load tables of a run: each is held back by its own backlog (here the series') only."""
    ld = _load(spark, d).select(F.col("ticker").alias("load_key"), "source_row_number", F.to_date("event_time").cast("string").alias("ingested_date"))
    tr = C.trades(spark, d).select(F.col("trade_id").cast("string").alias("load_key"), F.col("trade_id").alias("source_row_number"),
                                   F.to_date("trade_time").cast("string").alias("ingested_date"))
    loads, order = {}, [("source_row_number", "desc_nulls_last")]
    for entity, rows, merged in (("markets", ld, ld), ("trades", tr, tr), ("series", ld, ld.filter("ingested_date < '2024-01-20'"))):
        path, now = shared_dir(spark, f"retention-{entity}"), TB.fresh_name(f"retention_{entity}")
        rows.write.partitionBy("ingested_date").parquet(path)
        TB.keyed_load(spark, merged, now, ["load_key"], order, "all", progress="ingested_date")
        loads[entity] = (path, now)
    TB.clean_loads(spark, loads, "ingested_date", RETENTION_RUN)
    left = [spark.read.parquet(path).select(F.lit(entity).alias("entity"), "load_key", "source_row_number") for entity, (path, _) in loads.items()]
    return left[0].unionByName(left[1]).unionByName(left[2])


@register("market_spec", with_views("""
select m.market_title, m.market_status, t.trade_id, t.trade_time, t.price, t.size, t.taker_side
from trades t join mctx m on m.market_id = t.market_id
where t.market_id = (select min(market_id) from trades) and t.taker_side = 'view'""", "trades", "mctx"), doubles=("price",))
def q_market_spec(spark, d):
    """The static row and the prints of one market (the smallest key),
    one taker side."""
    t = C.trades(spark, d)
    one = t.agg(F.min("market_id")).first()[0]
    ctx = P.market_context(t)
    static, prints = market_spec(ctx, t, one, "view", key="market_id")
    return prints.join(static.select("market_id", "market_title", "market_status"), "market_id").select(
        "market_title", "market_status", "trade_id", "trade_time", "price", "size", "taker_side")
