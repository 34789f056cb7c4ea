"""Registered queries: paired contracts and live repricing.

Paths have the step of one minute, over the prints drawn together
(``proxies.near_trades``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators import pairs as PR
from marketlake.operators import paths as PA
from marketlake.operators import repricing as R
from marketlake.plans import common as C
from marketlake.plans.registry import register
from marketlake.plans.views import with_views
from marketlake.session import materialize

STEP = "minute"


def _mo(spark, d):
    return C.markets_outcome(spark, d)


def _pairs(spark, d):
    return PR.winner_loser_pairs(_mo(spark, d))


def _games(spark, d):
    return C.games(spark, d)


def _pp(spark, d):
    return PR.pair_path(C.pregame(spark, d), _pairs(spark, d), STEP)


@register("next_trade_lag", with_views("""
select t.game_id, t.side from_side, t.trade_id, t.trade_time,
       date_diff('microsecond', t.trade_time, o.trade_time) lag_micros,
       date_diff('microsecond', t.trade_time, o.trade_time) / 6e7 lag_minutes
from trades t asof join trades o
  on o.game_id = t.game_id and o.side = 1 - t.side and o.trade_time > t.trade_time""", "trades"),
    doubles=("lag_minutes",))
def q_next_trade_lag(spark, d):
    return PA.next_trade_lag(C.trades(spark, d))


@register("winner_loser_pairs", with_views("select * from pairs", "pairs"))
def q_winner_loser_pairs(spark, d):
    return _pairs(spark, d)


@register("pair_path", with_views("select * from pp", "pp", trades="near_trades"), doubles=("winner_price", "loser_implied"), near=True)
def q_pair_path(spark, d):
    return _pp(spark, d)


@register("lagged_pair_corr", with_views("select * from lagc", "lagc", trades="near_trades"), doubles=("delta_corr",), near=True)
def q_lagged_pair_corr(spark, d):
    return PR.lagged_pair_corr(_pp(spark, d))


@register("best_pair_lag", with_views("select * from bestlag", "bestlag", trades="near_trades"), doubles=("best_delta_corr",), near=True)
def q_best_pair_lag(spark, d):
    return PR.best_pair_lag(PR.lagged_pair_corr(_pp(spark, d)))


@register("best_lag_distribution", with_views(
    "select best_delta_lag_minutes, count(*) games from bestlag group by 1", "bestlag", trades="near_trades"), near=True)
def q_best_lag_distribution(spark, d):
    return PR.best_lag_distribution(PR.best_pair_lag(PR.lagged_pair_corr(_pp(spark, d))))


@register("pair_gap_summary", with_views("""
select p.game_id, p.winner_market_id, p.loser_market_id, p.winner_side, s.overlap_minutes, s.contemporaneous_level_corr,
       s.contemporaneous_delta_corr, s.mean_abs_complement_gap, s.max_abs_complement_gap,
       b.best_delta_lag_minutes, b.best_delta_corr,
       g.median_minutes_winner_to_loser, g.median_minutes_loser_to_winner,
       g.share_winner_followed_within_1m, g.share_loser_followed_within_1m
from pairs p
join (select game_id, count(*) overlap_minutes,
             case when count(*) >= 3 and min(winner_price) < max(winner_price) and min(loser_implied) < max(loser_implied)
                  then covar_pop(winner_price, loser_implied) / (stddev_pop(winner_price) * stddev_pop(loser_implied))
             end contemporaneous_level_corr,
             case when count(winner_delta) >= 3 and min(winner_delta) < max(winner_delta)
                       and min(loser_delta) < max(loser_delta)
                  then covar_pop(winner_delta, loser_delta) / (stddev_pop(winner_delta) * stddev_pop(loser_delta))
             end contemporaneous_delta_corr,
             avg(abs(winner_price - loser_implied)) mean_abs_complement_gap,
             max(abs(winner_price - loser_implied)) max_abs_complement_gap
      from pdl group by game_id) s on s.game_id = p.game_id
left join bestlag b on b.game_id = p.game_id
left join (select t.game_id,
                  median(date_diff('microsecond', t.trade_time, o.trade_time) / 6e7) filter (where t.role = 1)
                    median_minutes_winner_to_loser,
                  median(date_diff('microsecond', t.trade_time, o.trade_time) / 6e7) filter (where t.role = 0)
                    median_minutes_loser_to_winner,
                  avg(case when date_diff('microsecond', t.trade_time, o.trade_time) / 6e7 <= 1 then 1.0 else 0.0 end)
                    filter (where t.role = 1) share_winner_followed_within_1m,
                  avg(case when date_diff('microsecond', t.trade_time, o.trade_time) / 6e7 <= 1 then 1.0 else 0.0 end)
                    filter (where t.role = 0) share_loser_followed_within_1m
           from pr t asof join pr o on o.game_id = t.game_id and o.role = 1 - t.role and o.trade_time > t.trade_time
           group by t.game_id) g on g.game_id = p.game_id""", "pdl", "bestlag", "pairs", "pregame", extra={
    "pr": """select t.*, case when t.market_id = p.winner_market_id then 1 else 0 end role
             from pregame t join pairs p on p.game_id = t.game_id
             where t.market_id in (p.winner_market_id, p.loser_market_id)"""}, trades="near_trades"),
    doubles=("contemporaneous_level_corr", "contemporaneous_delta_corr", "mean_abs_complement_gap",
             "max_abs_complement_gap", "best_delta_corr", "median_minutes_winner_to_loser",
             "median_minutes_loser_to_winner", "share_winner_followed_within_1m",
             "share_loser_followed_within_1m"), near=True)
def q_pair_gap_summary(spark, d):
    pairs = _pairs(spark, d)
    pre = C.pregame(spark, d)
    # the pair path feeds two branches (gap statistics and lag correlations):
    # written once, as the path table it is
    pp = materialize(PR.pair_path(pre, pairs, STEP))
    roles = PR._roles(pre, pairs)
    lags = materialize(PA.next_trade_lag(roles, side="role"))
    best = PR.best_pair_lag(PR.lagged_pair_corr(pp))
    return PR.pair_gap_summary(pp, lags, best, pairs)


def _lpath(spark, d):
    return PR.live_path(C.scored(spark, d), _pairs(spark, d), STEP)


def _lsum(spark, d):
    return PR.live_game_summary(_lpath(spark, d), C.live(spark, d), _games(spark, d))


@register("live_path", with_views("select * from lpath", "lpath", trades="near_trades"), doubles=("winner_probability",), near=True)
def q_live_path(spark, d):
    return _lpath(spark, d)


LSUM_D = ("live_volume", "live_duration_minutes", "winner_prob_first_pitch", "winner_prob_last_observed",
          "live_repricing_to_winner", "total_abs_live_move", "path_efficiency", "max_1m_abs_move",
          "largest_jump_share_of_path", "trend_slope_per_hour")


@register("live_game_summary", with_views("select * from lsum", "lsum", trades="near_trades"), doubles=LSUM_D, near=True)
def q_live_game_summary(spark, d):
    return _lsum(spark, d)


@register("live_answers", with_views("""
select 0 question_order, 'games with live prints' question,
       cast(sum(cast(has_any_live_trades as int)) as bigint) yes_count, count(*) total,
       avg(cast(has_any_live_trades as double)) share from lsum
union all select 1, 'games with 15 live minutes or more', cast(sum(cast(has_enough_live_coverage as int)) as bigint),
       count(*), avg(cast(has_enough_live_coverage as double)) from lsum
union all select 2, 'covered games repriced towards the winner',
       cast(coalesce(sum(cast(coalesce(live_repricing_to_winner > 0, false) as int)), 0) as bigint), count(*),
       avg(cast(coalesce(live_repricing_to_winner > 0, false) as double)) from lsum where has_enough_live_coverage
union all select 3, 'covered games with a one-minute jump of 5 cents or more',
       cast(coalesce(sum(cast(coalesce(jump_count_5c > 0, false) as int)), 0) as bigint), count(*),
       avg(cast(coalesce(jump_count_5c > 0, false) as double)) from lsum where has_enough_live_coverage
union all select 4, 'covered games with a one-minute jump of 10 cents or more',
       cast(coalesce(sum(cast(coalesce(jump_count_10c > 0, false) as int)), 0) as bigint), count(*),
       avg(cast(coalesce(jump_count_10c > 0, false) as double)) from lsum where has_enough_live_coverage
""", "lsum", trades="near_trades"), doubles=("share",), near=True)
def q_live_answers(spark, d):
    flag = lambda c: F.coalesce(c, F.lit(False))
    s = (_lsum(spark, d).withColumn("toward", flag(F.col("live_repricing_to_winner") > 0))
         .withColumn("j5", flag(F.col("jump_count_5c") > 0))
         .withColumn("j10", flag(F.col("jump_count_10c") > 0)))
    scope = "has_enough_live_coverage"
    return R.answers([("games with live prints", s, "has_any_live_trades"),
                      ("games with 15 live minutes or more", s, "has_enough_live_coverage"),
                      ("covered games repriced towards the winner", s, "toward", scope),
                      ("covered games with a one-minute jump of 5 cents or more", s, "j5", scope),
                      ("covered games with a one-minute jump of 10 cents or more", s, "j10", scope)])


@register("live_distribution", with_views(
    " union all ".join(
        f"select '{m}' metric, count({m}) count, avg({m}::double) mean, stddev_samp({m}::double) std, "
        f"min({m}::double) min, quantile_cont({m}::double, 0.25) p25, quantile_cont({m}::double, 0.5) p50, "
        f"quantile_cont({m}::double, 0.75) p75, max({m}::double) max from lsum where has_enough_live_coverage"
        for m in PR.LIVE_METRICS), "lsum", trades="near_trades"),
    doubles=("mean", "std", "min", "p25", "p50", "p75", "max"), near=True)
def q_live_distribution(spark, d):
    return PR.live_distribution(_lsum(spark, d).filter("has_enough_live_coverage"))


LCP_SQL = """
select p.game_id, c.checkpoint, c.checkpoint_order, g.game_start + to_minutes(c.mins) checkpoint_time,
       arg_max(p.winner_probability, p.minute) winner_probability
from lpath p join games g on g.game_id = p.game_id
join (values ('first_pitch', 0, 0), ('15m_live', 1, 15), ('30m_live', 2, 30), ('60m_live', 3, 60),
             ('120m_live', 4, 120)) c(checkpoint, checkpoint_order, mins)
  on p.minute <= g.game_start + to_minutes(c.mins)
join (select game_id, max(minute) e from lpath group by 1) e on e.game_id = p.game_id
where g.game_start + to_minutes(c.mins) <= e.e
group by 1, 2, 3, 4
union all
select game_id, 'last_observed', 5, max(minute), arg_max(winner_probability, minute) from lpath group by game_id"""


@register("live_checkpoint_prices", with_views(LCP_SQL, "lpath", "games", trades="near_trades"), doubles=("winner_probability",), near=True)
def q_live_checkpoint_prices(spark, d):
    return PR.live_checkpoint_prices(_lpath(spark, d), _games(spark, d))


@register("live_checkpoint_summary", with_views(f"""
select checkpoint_order, checkpoint, count(distinct game_id) games,
       avg(winner_probability) mean_winner_probability, median(winner_probability) median_winner_probability
from ({LCP_SQL}) c group by 1, 2""", "lpath", "games", trades="near_trades"),
    doubles=("mean_winner_probability", "median_winner_probability"), near=True)
def q_live_checkpoint_summary(spark, d):
    return PR.live_checkpoint_summary(PR.live_checkpoint_prices(_lpath(spark, d), _games(spark, d)))
