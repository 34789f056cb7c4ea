"""Registered queries: market / series statistics and pregame repricing
(A1-A16, A31-A37, J4, J7, J12, P18-P22, P27)."""

from __future__ import annotations


from marketlake.operators import market_stats as MS
from marketlake.operators import paths as PA
from marketlake.operators import repricing as R
from marketlake.operators.outcomes import labelled_trades, market_outcome
from marketlake.plans import common as C
from marketlake.plans.registry import register
from marketlake.plans.views import with_views
from marketlake.sources import proxies as P

ET = "'America/New_York'"


def et(col: str) -> str:
    return f"(({col}) at time zone 'UTC') at time zone {ET}"


@register("market_trade_summary", with_views("""
select market_id, count(*) total_trades, cast(sum(size) as bigint) total_contracts_traded,
       min(trade_time) first_trade_at, max(trade_time) last_trade_at, min(price) min_price,
       max(price) max_price, avg(price) avg_price, stddev_samp(price) stddev_price
from trades group by market_id""", "trades"), doubles=("min_price", "max_price", "avg_price", "stddev_price"))
def q_market_trade_summary(spark, d):
    return MS.market_trade_summary(C.trades(spark, d))


A2_SQL = """
select {k}, count(*) total_trades,
       arg_min(price, (trade_time, trade_id)) filter (where price is not null) open_price,
       arg_max(price, (trade_time, trade_id)) filter (where price is not null) close_price,
       avg(price) average_price, avg(size) average_trade_size, min(size) min_trade_size,
       max(size) max_trade_size,
       arg_max(price, (trade_time, trade_id)) filter (where price is not null)
         - arg_min(price, (trade_time, trade_id)) filter (where price is not null) price_delta
from trades group by {k}"""
A2_D = ("open_price", "close_price", "average_price", "average_trade_size", "price_delta")


@register("market_trade_stats", with_views(A2_SQL.format(k="market_id"), "trades"), doubles=A2_D)
def q_market_trade_stats(spark, d):
    return MS.market_trade_stats(C.trades(spark, d))


PEAK_SQL = """
select {k}, {hour_et} peak_trade_hour_et, max(n) peak_trade_hour_trade_count
from (select {k}, date_trunc('hour', trade_time) hour_utc, count(*) n from trades group by 1, 2) h
group by {k}"""


@register("market_peak_hour", with_views(PEAK_SQL.format(
    k="market_id", hour_et=et("arg_max(hour_utc, (n, -epoch_us(hour_utc)))")), "trades"))
def q_market_peak_hour(spark, d):
    return MS.peak_hour(C.trades(spark, d), "market_id")


@register("series_trade_stats", with_views("""
select series_ticker, count(*) total_trades, avg(price) average_price, avg(size) average_trade_size,
       min(size) min_trade_size, max(size) max_trade_size
from trades group by series_ticker""", "trades"), doubles=("average_price", "average_trade_size"))
def q_series_trade_stats(spark, d):
    return MS.series_trade_stats(C.trades(spark, d))


@register("series_market_stats", with_views("""
select series_ticker, count(distinct market_id) market_count, avg(open_price) open_price,
       avg(close_price) close_price, avg(price_delta) price_delta
from (""" + A2_SQL.format(k="market_id, series_ticker") + ") s group by series_ticker", "trades"),
    doubles=("open_price", "close_price", "price_delta"))
def q_series_market_stats(spark, d):
    t = C.trades(spark, d)
    return MS.series_market_stats(MS.market_trade_stats(t, ["market_id", "series_ticker"]))


@register("series_peak_hour", with_views(PEAK_SQL.format(
    k="series_ticker", hour_et=et("arg_max(hour_utc, (n, -epoch_us(hour_utc)))")), "trades"))
def q_series_peak_hour(spark, d):
    return MS.peak_hour(C.trades(spark, d), "series_ticker")


SERIES = ["SERIES-0", "SERIES-1", "SERIES-2"]


@register("series_hourly_pivot", with_views(
    f"select hour_utc trade_hour_utc, {et('hour_utc')} trade_hour_et, "
    + ", ".join(f"count(*) filter (where series_ticker = '{s}') \"{s}\"" for s in SERIES)
    + " from (select *, date_trunc('hour', trade_time) hour_utc from trades) h group by 1, 2", "trades"))
def q_series_hourly_pivot(spark, d):
    """The series are found in the prints, none is left out."""
    return MS.series_hourly_pivot(C.trades(spark, d))


@register("day_trades", with_views(f"""
select *, {et('trade_time')} trade_time_et, date_trunc('hour', {et('trade_time')}) trade_hour_et
from trades where cast({et('trade_time')} as date) = date '2024-01-16'""", "trades"), doubles=("price",))
def q_day_trades(spark, d):
    return MS.day_trades(C.trades(spark, d), "2024-01-16")


@register("labelled_trades", with_views("select * from labelled", "labelled", trades="edge_trades"),
          doubles=("price", "actual_outcome"))
def q_labelled_trades(spark, d):
    """J4 + P18 + P20: incomplete prints go, a print at the start is live."""
    t = P.edge_trades(C.trades(spark, d))
    m = P.markets(spark, d, t)
    return labelled_trades(t, market_outcome(m, P.winners(m)))


@register("winner_probability", with_views("select * from scored", "scored"),
          doubles=("price", "actual_outcome", "winner_probability", "brier_score"))
def q_winner_probability(spark, d):
    return C.scored(spark, d)


@register("market_outcome", with_views("""
select m.market_id, m.game_id, m.side, m.game_start, m.market_result, w.winner_side,
       coalesce(case lower(trim(m.market_result)) when 'yes' then 1.0 when 'no' then 0.0 end,
                case when w.winner_side is null then null when m.side = w.winner_side then 1.0 else 0.0 end)
         actual_outcome,
       case when lower(trim(m.market_result)) in ('yes', 'no') then 'market_result'
            when w.winner_side is not null then 'winner_map' else 'missing' end outcome_source
from markets m left join winners w on w.game_id = m.game_id""", "markets", "winners"),
    doubles=("actual_outcome",))
def q_market_outcome(spark, d):
    return C.markets_outcome(spark, d)


@register("outcome_sources", with_views("""
select outcome_source, count(*) markets from (
  select case when lower(trim(market_result)) in ('yes', 'no') then 'market_result'
              when w.winner_side is not null then 'winner_map' else 'missing' end outcome_source
  from markets m left join winners w on w.game_id = m.game_id) x group by 1""", "markets", "winners"))
def q_outcome_sources(spark, d):
    return MS.outcome_sources(C.markets_outcome(spark, d))


@register("drift_by_window", with_views("""
select market_id, "window", count(*) trades,
       arg_min(price, (trade_time, trade_id)) filter (where price is not null) first_price,
       arg_max(price, (trade_time, trade_id)) filter (where price is not null) last_price,
       avg(price) mean_price, stddev_samp(price) std_price, min(price) min_price, max(price) max_price,
       max(price) - min(price) price_range
from labelled group by market_id, "window" """, "labelled"),
    doubles=("first_price", "last_price", "mean_price", "std_price", "min_price", "max_price", "price_range"))
def q_drift_by_window(spark, d):
    return MS.drift_by_window(C.labelled(spark, d))


@register("trade_value", with_views("""
select market_id, sum(size * price) dollars_traded, cast(sum(size) as bigint) contracts_traded
from trades group by market_id""", "trades"), doubles=("dollars_traded",))
def q_trade_value(spark, d):
    return MS.trade_value(C.trades(spark, d))


@register("coverage_counts", with_views("""
select "window", count(*) trades, count(distinct market_id) markets, count(distinct game_id) games
from labelled group by 1""", "labelled"))
def q_coverage_counts(spark, d):
    return MS.coverage_counts(C.labelled(spark, d))


MSUM_D = ("actual_outcome", "open_price", "first_pitch_price", "winner_prob_open", "winner_prob_first_pitch",
          "brier_open", "brier_first_pitch", "total_abs_winner_prob_move", "winner_prob_slope_per_hour",
          "hours_observed_pregame", "price_change", "winner_prob_change", "brier_improvement",
          "path_efficiency")


def _msum(spark, d):
    return R.pregame_market_summary(C.pregame(spark, d))


@register("pregame_market_summary", with_views("select * from msum", "msum"), doubles=MSUM_D)
def q_pregame_market_summary(spark, d):
    return _msum(spark, d)


ESUM_D = ("mean_winner_prob_open", "mean_winner_prob_first_pitch", "mean_winner_prob_change", "mean_brier_open",
          "mean_brier_first_pitch", "mean_brier_improvement", "mean_path_efficiency")


@register("pregame_event_summary", with_views("select * from esum", "esum"), doubles=ESUM_D)
def q_pregame_event_summary(spark, d):
    return R.pregame_event_summary(_msum(spark, d))


ANSWER_SQL = """
select 0 question_order, 'markets whose price went towards the winner' question,
       cast(coalesce(sum(cast(moved_toward_winner as int)), 0) as bigint) yes_count, count(*) total,
       avg(cast(moved_toward_winner as double)) share from msum
union all select 1, 'markets with a better Brier score at the start', cast(coalesce(sum(cast(forecast_improved as int)), 0) as bigint),
       count(*), avg(cast(forecast_improved as double)) from msum
union all select 2, 'games whose prices went towards the winner',
       cast(coalesce(sum(cast(moved_toward_winner as int)), 0) as bigint), count(*),
       avg(cast(moved_toward_winner as double)) from esum
union all select 3, 'games with a better mean Brier score at the start', cast(coalesce(sum(cast(forecast_improved as int)), 0) as bigint),
       count(*), avg(cast(forecast_improved as double)) from esum"""


@register("pregame_answers", with_views(ANSWER_SQL, "esum"), doubles=("share",))
def q_pregame_answers(spark, d):
    s = _msum(spark, d)
    e = R.pregame_event_summary(s)
    return R.answers([("markets whose price went towards the winner", s, "moved_toward_winner"),
                      ("markets with a better Brier score at the start", s, "forecast_improved"),
                      ("games whose prices went towards the winner", e, "moved_toward_winner"),
                      ("games with a better mean Brier score at the start", e, "forecast_improved")])


SYNC_SQL = """
select game_id, min(winner_side) winner_side, cast(sum(cast(forecast_improved as int)) as bigint) improving_contracts,
       count(distinct market_id) contracts, avg(brier_improvement) mean_brier_improvement,
       min(brier_improvement) min_brier_improvement, max(brier_improvement) max_brier_improvement,
       avg(winner_prob_change) mean_winner_prob_change, avg(brier_improvement) > 0 game_improved_mean_brier
from msum group by game_id"""


@register("contract_sync", with_views(SYNC_SQL, "msum"),
          doubles=("mean_brier_improvement", "min_brier_improvement", "max_brier_improvement",
                   "mean_winner_prob_change"))
def q_contract_sync(spark, d):
    return R.contract_sync(_msum(spark, d))


@register("contract_sync_distribution", with_views(
    f"select improving_contracts, count(*) games from ({SYNC_SQL}) s group by 1", "msum"))
def q_contract_sync_distribution(spark, d):
    return R.contract_sync_distribution(R.contract_sync(_msum(spark, d)))


# Checkpoint names of the output.
CHECKPOINTS = [("first_observed", None), ("6h_before", "6 hours"), ("3h_before", "3 hours"),
               ("1h_before", "1 hour"), ("15m_before", "15 minutes"), ("first_pitch", "0 seconds")]
CP_NAMES = [n for n, _ in CHECKPOINTS]
CP_CARRY = ("price", "winner_probability", "brier_score", "game_id", "side", "actual_outcome")


def _cp(spark, d):
    return PA.checkpoint_prices(C.pregame(spark, d), CHECKPOINTS, carry=CP_CARRY)


@register("checkpoint_prices", with_views("select * from cp", "cp"),
          doubles=("price", "winner_probability", "brier_score", "actual_outcome"))
def q_checkpoint_prices(spark, d):
    return _cp(spark, d)


@register("checkpoint_summary", with_views("""
select checkpoint_order, checkpoint, count(distinct market_id) markets,
       avg(winner_probability) mean_winner_probability, median(winner_probability) median_winner_probability,
       avg(brier_score) mean_brier_score, median(brier_score) median_brier_score
from cp group by 1, 2""", "cp"), doubles=("mean_winner_probability", "median_winner_probability",
                                          "mean_brier_score", "median_brier_score"))
def q_checkpoint_summary(spark, d):
    return R.checkpoint_summary(_cp(spark, d))


@register("checkpoint_wide", with_views(
    "select market_id, " + ", ".join(
        f"max(case when checkpoint = '{n}' then brier_score end) brier_{n}" for n in CP_NAMES)
    + " from cp group by market_id", "cp"), doubles=tuple(f"brier_{n}" for n in CP_NAMES))
def q_checkpoint_wide(spark, d):
    return R.checkpoint_wide(_cp(spark, d), "brier_score", CP_NAMES, "brier_")


CONC_D = tuple([f"brier_{n}" for n in CP_NAMES] + [f"winner_prob_{n}" for n in CP_NAMES] + [
    "path_efficiency", "total_brier_improvement", "final_hour_brier_improvement",
    "final_hour_share_of_positive_improvement", "total_winner_prob_change", "final_hour_winner_prob_change"])


@register("final_hour_concentration", with_views("select * from conc", "conc"), doubles=CONC_D)
def q_final_hour_concentration(spark, d):
    return R.final_hour_concentration(_msum(spark, d), _cp(spark, d), CP_NAMES)


@register("concentration_medians", with_views("""
select median(final_hour_share_of_positive_improvement) filter (where total_brier_improvement > 0)
         median_final_hour_share,
       median(path_efficiency) median_path_efficiency from conc""", "conc"),
    doubles=("median_final_hour_share", "median_path_efficiency"))
def q_concentration_medians(spark, d):
    return R.concentration_medians(R.final_hour_concentration(_msum(spark, d), _cp(spark, d), CP_NAMES))
