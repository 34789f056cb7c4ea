"""Registered queries: order books, context joins and rank correlations
(A17-A20, A29, A30, J6, J14, J16, P29)."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators import books as B
from marketlake.operators import market_stats as MS
from marketlake.operators import pairs as PR
from marketlake.operators import rankcorr as RC
from marketlake.operators import repricing as R
from marketlake.plans import common as C
from marketlake.plans.registry import register
from marketlake.plans.views import with_views
from marketlake.session import materialize
from marketlake.sources import proxies as P

DEPTH_D = ("orderbook_yes_depth_contracts", "orderbook_no_depth_contracts", "orderbook_total_depth_contracts",
           "best_yes_bid", "best_no_bid")


def _books(spark, d):
    return P.books(spark, d)


def _depth(spark, d):
    return B.orderbook_depth(_books(spark, d))


@register("orderbook_depth", with_views("select * from depth", "depth"), doubles=DEPTH_D)
def q_orderbook_depth(spark, d):
    return _depth(spark, d)


@register("orderbook_implied_std", with_views("select * from istd", "istd"), doubles=("orderbook_yes_implied_std",))
def q_orderbook_implied_std(spark, d):
    return B.orderbook_implied_std(_books(spark, d))


@register("orderbook_levels", with_views("""
select market_id, cast(count(distinct price) filter (where side = 'yes') as int) yes_levels,
       cast(count(distinct price) filter (where side = 'no') as int) no_levels,
       coalesce(sum(size) filter (where side = 'yes'), 0) yes_resting_size,
       coalesce(sum(size) filter (where side = 'no'), 0) no_resting_size
from levels group by market_id""", "levels"), doubles=("yes_resting_size", "no_resting_size"))
def q_orderbook_levels(spark, d):
    return B.orderbook_levels(_books(spark, d))


@register("nonempty_books", with_views("select * from book_text", "book_text"))
def q_nonempty_books(spark, d):
    """Books without a level and books without a key go."""
    odd = spark.range(4).select(
        F.when(F.col("id") > 0, -F.col("id")).alias("market_id"),
        F.element_at(F.array(*map(F.lit, ('{"yes_dollars":[["0.5","1.0"]],"no_dollars":[]}',
                                          '{"yes_dollars":[],"no_dollars":[]}', "{}", "no book"))),
                     (F.col("id") + 1).cast("int")).alias("orderbook"))
    return B.nonempty_books(_books(spark, d).unionByName(odd))


@register("market_stats_join", with_views("""
select m.market_id, m.game_id, m.side, coalesce(t.total_trades, 0) total_trades, t.open_price, t.close_price,
       t.average_price, t.price_delta, i.orderbook_yes_implied_std, k.peak_trade_hour_et,
       k.peak_trade_hour_trade_count
from markets m
left join (select market_id, count(*) total_trades,
                  arg_min(price, (trade_time, trade_id)) filter (where price is not null) open_price,
                  arg_max(price, (trade_time, trade_id)) filter (where price is not null) close_price,
                  avg(price) average_price,
                  arg_max(price, (trade_time, trade_id)) filter (where price is not null)
                    - arg_min(price, (trade_time, trade_id)) filter (where price is not null) price_delta
           from trades group by market_id) t on t.market_id = m.market_id
left join istd i on i.market_id = m.market_id
left join (select market_id, (arg_max(hour_utc, (n, -epoch_us(hour_utc))) at time zone 'UTC')
                  at time zone 'America/New_York' peak_trade_hour_et, max(n) peak_trade_hour_trade_count
           from (select market_id, date_trunc('hour', trade_time) hour_utc, count(*) n from trades group by 1, 2) h
           group by market_id) k on k.market_id = m.market_id""", "markets", "trades", "istd"),
    doubles=("open_price", "close_price", "average_price", "price_delta", "orderbook_yes_implied_std"))
def q_market_stats_join(spark, d):
    """Market universe LEFT JOIN trade, book and peak-hour stats; an
    absent trade count is 0."""
    t = C.trades(spark, d)
    m = P.markets(spark, d, t).select("market_id", "game_id", "side")
    st = MS.market_trade_stats(t).select("market_id", "total_trades", "open_price", "close_price",
                                         "average_price", "price_delta")
    j = (m.join(st, "market_id", "left")
          .join(B.orderbook_implied_std(_books(spark, d)), "market_id", "left")
          .join(MS.peak_hour(t), "market_id", "left"))
    return j.withColumn("total_trades", F.coalesce(F.col("total_trades"), F.lit(0)).cast("bigint"))


MSUM_D = ("actual_outcome", "open_price", "first_pitch_price", "winner_prob_open", "winner_prob_first_pitch",
          "brier_open", "brier_first_pitch", "total_abs_winner_prob_move", "winner_prob_slope_per_hour",
          "hours_observed_pregame", "price_change", "winner_prob_change", "brier_improvement",
          "path_efficiency")


CTX_D = ("last_price_dollars", "volume_fp", "liquidity_dollars", "yes_bid_dollars", "yes_ask_dollars",
         "yes_bid_size_fp", "yes_ask_size_fp")


def _la(spark, d):
    """Pregame summary LEFT JOIN market context LEFT JOIN book depth, one
    row per market; stored once, as several branches read it."""
    def build():
        s = R.pregame_market_summary(C.pregame(spark, d))
        ctx = P.market_context(C.trades(spark, d)).join(
            C.markets_outcome(spark, d).select("market_id", "outcome_source"), "market_id")
        return materialize(s.join(ctx, "market_id", "left").join(_depth(spark, d), "market_id", "left"))
    return C.shared(("la", d), build)


@register("market_context_join", with_views("select * from la", "la"), doubles=MSUM_D + DEPTH_D + CTX_D)
def q_market_context_join(spark, d):
    return _la(spark, d)


# Metrics and features of the output.
METRICS = ["brier_improvement", "winner_prob_change", "path_efficiency", "winner_prob_slope_per_hour"]
FEATURES = ["pregame_trade_count", "pregame_volume", "volume_fp", "liquidity_dollars", "yes_bid_size_fp",
            "yes_ask_size_fp", "orderbook_yes_depth_contracts", "orderbook_no_depth_contracts",
            "orderbook_total_depth_contracts"]


def rank_corr_sql(src: str, metrics: list[str], features: list[str]) -> str:
    """Oracle: stack, drop incomplete / infinite rows, average ranks, guarded Pearson."""
    parts = " union all ".join(
        f"select '{m}' metric, '{f}' feature, cast({m} as double) x, cast({f} as double) y from {src}"
        for m in metrics for f in features)
    allp = " union all ".join(f"select '{m}' metric, '{f}' feature" for m in metrics for f in features)
    return f"""
select a.metric, a.feature, c.spearman_corr, coalesce(c.n, 0) n
from ({allp}) a left join (
  select metric, feature,
         case when count(*) >= 3 and min(rx) < max(rx) and min(ry) < max(ry)
              then covar_pop(rx, ry) / (stddev_pop(rx) * stddev_pop(ry)) end spearman_corr, count(*) n
  from (select *, rank() over (partition by metric, feature order by x)
                    + (count(*) over (partition by metric, feature, x) - 1) / 2.0 rx,
                  rank() over (partition by metric, feature order by y)
                    + (count(*) over (partition by metric, feature, y) - 1) / 2.0 ry
        from ({parts}) s where x is not null and y is not null and isfinite(x) and isfinite(y)) r
  group by metric, feature) c on c.metric = a.metric and c.feature = a.feature"""


@register("liquidity_rank_corr", with_views(rank_corr_sql("la", METRICS, FEATURES), "la"),
          doubles=("spearman_corr",))
def q_liquidity_rank_corr(spark, d):
    return RC.rank_corr(_la(spark, d), METRICS, FEATURES)


def _lla(spark, d):
    """Analysable live games LEFT JOIN pregame and book sums per game."""
    lpath = PR.live_path(C.scored(spark, d), PR.winner_loser_pairs(C.markets_outcome(spark, d)), "minute")
    games = C.games(spark, d)
    live = PR.live_game_summary(lpath, C.live(spark, d), games).filter("has_enough_live_coverage")
    la = _la(spark, d)
    ctx = la.groupBy("game_id").agg(
        F.sum("pregame_trade_count").alias("pregame_trade_count"),
        F.sum("pregame_volume").alias("pregame_volume"),
        F.sum("volume_fp").alias("market_volume_fp"),
        F.sum("liquidity_dollars").alias("market_liquidity_dollars"),
        F.coalesce(F.sum("orderbook_total_depth_contracts"), F.lit(0.0)).alias("orderbook_total_depth_contracts"),
        F.coalesce(F.sum("orderbook_yes_depth_contracts"), F.lit(0.0)).alias("orderbook_yes_depth_contracts"),
        F.coalesce(F.sum("orderbook_no_depth_contracts"), F.lit(0.0)).alias("orderbook_no_depth_contracts"))
    return live.join(ctx, "game_id", "left")


LSUM_D = ("live_volume", "live_duration_minutes", "winner_prob_first_pitch", "winner_prob_last_observed",
          "live_repricing_to_winner", "total_abs_live_move", "path_efficiency", "max_1m_abs_move",
          "largest_jump_share_of_path", "trend_slope_per_hour")


@register("event_context_join", with_views("select * from lla", "lla", trades="near_trades"),
          doubles=LSUM_D + ("orderbook_total_depth_contracts", "orderbook_yes_depth_contracts",
                            "orderbook_no_depth_contracts", "market_volume_fp", "market_liquidity_dollars"), near=True)
def q_event_context_join(spark, d):
    return _lla(spark, d)


# Metrics and features of the output.
LIVE_METRICS = ["live_repricing_to_winner", "path_efficiency", "max_1m_abs_move", "largest_jump_share_of_path"]
LIVE_FEATURES = ["live_trade_count", "live_volume", "pregame_trade_count", "pregame_volume", "market_volume_fp",
                 "market_liquidity_dollars", "orderbook_total_depth_contracts"]


@register("live_rank_corr", with_views(rank_corr_sql("lla", LIVE_METRICS, LIVE_FEATURES), "lla", trades="near_trades"),
          doubles=("spearman_corr",), near=True)
def q_live_rank_corr(spark, d):
    return RC.rank_corr(_lla(spark, d), LIVE_METRICS, LIVE_FEATURES)


def matrix_sql(src: str, cols: list[str], id_col: str) -> str:
    parts = " union all ".join(f"select {id_col} id, '{c}' col, cast({c} as double) v from {src}" for c in cols)
    return f"""
with lg as (select * from ({parts}) s where v is not null and isfinite(v)),
rk as (select *, rank() over (partition by col order by v) + (count(*) over (partition by col, v) - 1) / 2.0 r
       from lg),
kept as (select col from lg group by col having count(*) >= 3 and min(v) < max(v))
select a.col a, b.col b,
       case when count(*) >= 2 and min(a.r) < max(a.r) and min(b.r) < max(b.r)
            then covar_pop(a.r, b.r) / (stddev_pop(a.r) * stddev_pop(b.r)) end corr
from (select a.* from rk a join kept using (col)) a join (select b.* from rk b join kept using (col)) b
  on a.id = b.id group by a.col, b.col
union all
select a.col, b.col, null from kept a cross join kept b
where not exists (select 1 from rk x join rk y on x.id = y.id where x.col = a.col and y.col = b.col)"""


@register("rank_corr_matrix", with_views(
    "select * from (" + matrix_sql("lla", LIVE_METRICS + LIVE_FEATURES, "game_id") + ") m", "lla", trades="near_trades"),
    doubles=("corr",), near=True)
def q_rank_corr_matrix(spark, d):
    """A30 over the live analysis frame (per-column deletion rule)."""
    return RC.rank_corr_matrix(_lla(spark, d), LIVE_METRICS + LIVE_FEATURES, "game_id")
