"""DuckDB text of the proxy views (the oracle side of sources/proxies.py).

Written independently of the Spark code; the DuckDB dialect differs in
integer division (//), JSON access (->>) and interval construction.
"""

from __future__ import annotations

from marketlake.schemas import MARKET_LOAD

VIEWS: dict[str, str] = {
    "trades": """
        select event_id trade_id, user_id market_id, user_id // 2 game_id, user_id % 2 side,
               ts trade_time, floor(value*10000/(value+20))/10000 price,
               cast(props->>'$.k' as int)+1 size,
               timestamp '2024-01-16 00:00:00' + to_hours(cast((user_id // 2) % 24 as int)) game_start,
               'SERIES-' || cast((user_id // 2) % 3 as varchar) series_ticker,
               event_type taker_side
        from events""",
    "markets": """
        select market_id, min(game_id) game_id, min(side) side, min(game_start) game_start,
               case when min(game_id) % 3 = 0 then null
                    when min(side) = min(game_id) % 2 then ' Yes' else 'no' end market_result,
               min(game_id) % 2 winner_side
        from trades group by market_id""",
    "winners": "select game_id, min(winner_side) winner_side from markets where game_id % 9 <> 0 group by game_id",
    "levels": """
        select l_suppkey market_id, case when l_linenumber % 2 = 1 then 'yes' else 'no' end side,
               (l_partkey % 99 + 1) / 100.0::double price, l_quantity size
        from lineitem""",
    "load": """
        select cast(user_id as varchar) ticker,
               case when event_id % 50 = 0 then 'bad' else strftime(ts, '%Y-%m-%dT%H:%M:%SZ') end updated_time,
               case when event_id % 7 = 0 then null else date_trunc('hour', ts) end ingested_at,
               event_type || '.jsonl' source_file, event_id source_row_number, value,
               ts event_time
        from events""",
    # trades labelled with outcome (market result, else winner map) and window
    "labelled": """
        select * from (
        select t.*, m.market_result, w.winner_side,
               coalesce(case lower(trim(m.market_result)) when 'yes' then 1.0 when 'no' then 0.0 end,
                        case when w.winner_side is null then null
                             when t.side = w.winner_side then 1.0 else 0.0 end) actual_outcome,
               case when t.trade_time < t.game_start then 'pregame' else 'live' end "window"
        from trades t join markets m using (market_id) left join winners w on w.game_id = m.game_id) j
        where trade_time is not null and price is not null and actual_outcome is not null""",
    "scored": """
        select *, case when actual_outcome = 1.0 then price else 1.0 - price end winner_probability,
               (price - actual_outcome) * (price - actual_outcome) brier_score
        from labelled where trade_time is not null and price is not null and actual_outcome is not null""",
    "pregame": "select * from scored where \"window\" = 'pregame'",
    "livep": "select * from scored where \"window\" = 'live'",
    # A8 pregame market summary
    "msum": """
        select *, date_diff('microsecond', first_trade_time, last_pregame_trade_time) / 3.6e9 hours_observed_pregame,
               first_pitch_price - open_price price_change,
               winner_prob_first_pitch - winner_prob_open winner_prob_change,
               winner_prob_first_pitch - winner_prob_open > 0 moved_toward_winner,
               brier_open - brier_first_pitch brier_improvement,
               brier_open > brier_first_pitch forecast_improved,
               case when total_abs_winner_prob_move > 0
                    then abs(winner_prob_first_pitch - winner_prob_open) / total_abs_winner_prob_move end path_efficiency
        from (select market_id,
                     arg_min(game_id, (trade_time, trade_id)) game_id, arg_min(side, (trade_time, trade_id)) side,
                     min(winner_side) winner_side,
                     arg_min(actual_outcome, (trade_time, trade_id)) actual_outcome,
                     min(trade_time) first_trade_time, max(trade_time) last_pregame_trade_time,
                     arg_min(game_start, (trade_time, trade_id)) game_start,
                     count(*) pregame_trade_count, cast(sum(size) as bigint) pregame_volume,
                     arg_min(price, (trade_time, trade_id)) open_price,
                     arg_max(price, (trade_time, trade_id)) first_pitch_price,
                     arg_min(winner_probability, (trade_time, trade_id)) winner_prob_open,
                     arg_max(winner_probability, (trade_time, trade_id)) winner_prob_first_pitch,
                     arg_min(brier_score, (trade_time, trade_id)) brier_open,
                     arg_max(brier_score, (trade_time, trade_id)) brier_first_pitch,
                     coalesce(sum(step), 0.0) total_abs_winner_prob_move,
                     case when min(x) < max(x) then covar_pop(x, winner_probability) / var_pop(x) end
                         winner_prob_slope_per_hour
              from (select *, abs(winner_probability - lag(winner_probability) over
                                  (partition by market_id order by trade_time, trade_id)) step,
                           date_diff('microsecond', game_start, trade_time) / 3.6e9 x
                    from pregame) d
              group by market_id) s""",
    # A9 pregame event summary
    "esum": """
        select *, mean_brier_improvement > 0 forecast_improved, mean_winner_prob_change > 0 moved_toward_winner
        from (select game_id, min(winner_side) winner_side, count(distinct market_id) markets,
                     sum(pregame_trade_count) pregame_trade_count, sum(pregame_volume) pregame_volume,
                     avg(winner_prob_open) mean_winner_prob_open,
                     avg(winner_prob_first_pitch) mean_winner_prob_first_pitch,
                     avg(winner_prob_change) mean_winner_prob_change, avg(brier_open) mean_brier_open,
                     avg(brier_first_pitch) mean_brier_first_pitch,
                     avg(brier_improvement) mean_brier_improvement, avg(path_efficiency) mean_path_efficiency
              from msum group by game_id) e""",
    # J7 checkpoint prices, brute force: every print joined to every checkpoint it precedes
    "cps": """select * from (values ('6h_before', 1, interval 6 hour), ('3h_before', 2, interval 3 hour),
                  ('1h_before', 3, interval 1 hour), ('15m_before', 4, interval 15 minute),
                  ('first_pitch', 5, interval 0 second)) v(checkpoint, checkpoint_order, off)""",
    "cp": """
        select p.market_id, c.checkpoint, c.checkpoint_order, p.game_start - c.off checkpoint_time,
               max(p.trade_time) observed_trade_time,
               arg_max(p.price, (p.trade_time, p.trade_id)) price,
               arg_max(p.winner_probability, (p.trade_time, p.trade_id)) winner_probability,
               arg_max(p.brier_score, (p.trade_time, p.trade_id)) brier_score,
               arg_max(p.game_id, (p.trade_time, p.trade_id)) game_id,
               arg_max(p.side, (p.trade_time, p.trade_id)) side,
               arg_max(p.actual_outcome, (p.trade_time, p.trade_id)) actual_outcome
        from pregame p join cps c on p.trade_time <= p.game_start - c.off
        group by p.market_id, c.checkpoint, c.checkpoint_order, p.game_start - c.off
        union all
        select market_id, 'first_observed', 0, min(trade_time), min(trade_time),
               arg_min(price, (trade_time, trade_id)), arg_min(winner_probability, (trade_time, trade_id)),
               arg_min(brier_score, (trade_time, trade_id)), arg_min(game_id, (trade_time, trade_id)),
               arg_min(side, (trade_time, trade_id)), arg_min(actual_outcome, (trade_time, trade_id))
        from pregame group by market_id""",
    # A14/A15 concentration
    "conc": """
        select *, brier_first_observed - brier_first_pitch total_brier_improvement,
               brier_1h_before - brier_first_pitch final_hour_brier_improvement,
               case when brier_first_observed - brier_first_pitch > 0
                    then (brier_1h_before - brier_first_pitch) / (brier_first_observed - brier_first_pitch)
               end final_hour_share_of_positive_improvement,
               winner_prob_first_pitch - winner_prob_first_observed total_winner_prob_change,
               winner_prob_first_pitch - winner_prob_1h_before final_hour_winner_prob_change
        from (select s.market_id, s.game_id, s.side, s.winner_side, s.path_efficiency,
                     max(case when checkpoint = 'first_observed' then brier_score end) brier_first_observed,
                     max(case when checkpoint = '6h_before' then brier_score end) brier_6h_before,
                     max(case when checkpoint = '3h_before' then brier_score end) brier_3h_before,
                     max(case when checkpoint = '1h_before' then brier_score end) brier_1h_before,
                     max(case when checkpoint = '15m_before' then brier_score end) brier_15m_before,
                     max(case when checkpoint = 'first_pitch' then brier_score end) brier_first_pitch,
                     max(case when checkpoint = 'first_observed' then winner_probability end) winner_prob_first_observed,
                     max(case when checkpoint = '6h_before' then winner_probability end) winner_prob_6h_before,
                     max(case when checkpoint = '3h_before' then winner_probability end) winner_prob_3h_before,
                     max(case when checkpoint = '1h_before' then winner_probability end) winner_prob_1h_before,
                     max(case when checkpoint = '15m_before' then winner_probability end) winner_prob_15m_before,
                     max(case when checkpoint = 'first_pitch' then winner_probability end) winner_prob_first_pitch
              from msum s left join cp c on c.market_id = s.market_id
              group by s.market_id, s.game_id, s.side, s.winner_side, s.path_efficiency) w""",
    "mo": """
        select m.market_id, m.game_id, m.side, m.game_start, m.market_result, w.winner_side
        from markets m left join winners w on w.game_id = m.game_id""",
    "pairs": """
        select game_id, min(case when side = winner_side then market_id end) winner_market_id,
               min(case when side <> winner_side then market_id end) loser_market_id, min(winner_side) winner_side
        from mo where winner_side is not null group by game_id
        having min(case when side = winner_side then market_id end) is not null
           and min(case when side <> winner_side then market_id end) is not null""",
    "games": "select game_id, min(game_start) game_start, min(winner_side) winner_side from mo group by game_id",
    # J9 pair path over pregame prints, one-minute buckets
    "pb": """
        select t.game_id, case when t.market_id = p.winner_market_id then 1 else 0 end role,
               date_trunc('minute', t.trade_time) bucket, arg_max(t.price, (t.trade_time, t.trade_id)) price
        from pregame t join pairs p on p.game_id = t.game_id
        where t.market_id in (p.winner_market_id, p.loser_market_id) group by 1, 2, 3""",
    "ppath": """
        select g.game_id, g.role, g.minute, last_value(b.price ignore nulls) over
                 (partition by g.game_id, g.role order by g.minute rows between unbounded preceding and current row) price
        from (select game_id, role, unnest(generate_series(min(bucket), max(bucket), interval 1 minute)) as minute
              from pb group by 1, 2) g
        left join pb b on b.game_id = g.game_id and b.role = g.role and b.bucket = g.minute""",
    "pp": """
        select w.game_id, w.minute, w.price winner_price, 1.0 - l.price loser_implied
        from ppath w join ppath l on w.game_id = l.game_id and w.minute = l.minute and w.role = 1 and l.role = 0""",
    "pdl": """
        select *, winner_price - lag(winner_price) over (partition by game_id order by minute) winner_delta,
               loser_implied - lag(loser_implied) over (partition by game_id order by minute) loser_delta
        from pp""",
    "lagc": """
        select a.game_id, l.lag_minutes,
               case when count(b.loser_delta) >= 3
                         and min(case when b.loser_delta is not null then a.winner_delta end)
                           < max(case when b.loser_delta is not null then a.winner_delta end)
                         and min(b.loser_delta) < max(b.loser_delta)
                    then covar_pop(case when b.loser_delta is not null then a.winner_delta end, b.loser_delta)
                         / (stddev_pop(case when b.loser_delta is not null then a.winner_delta end)
                            * stddev_pop(b.loser_delta)) end delta_corr,
               count(b.loser_delta) n
        from (select *, row_number() over (partition by game_id order by minute) rn from pdl
              where winner_delta is not null and loser_delta is not null) a
        cross join (select unnest(range(-10, 11)) lag_minutes) l
        left join (select *, row_number() over (partition by game_id order by minute) rn from pdl
                   where winner_delta is not null and loser_delta is not null) b
               on b.game_id = a.game_id and b.rn = a.rn + l.lag_minutes
        group by a.game_id, l.lag_minutes""",
    "bestlag": """
        select game_id, arg_max(lag_minutes, (delta_corr, -lag_minutes)) filter (where delta_corr is not null)
                 best_delta_lag_minutes, max(delta_corr) best_delta_corr
        from lagc group by game_id""",
    # J11 live path: each contract's own filled path, cut to the live grid and filled on
    "lt": """
        select t.*, case when t.market_id = p.winner_market_id then 1 else 0 end role
        from scored t join pairs p on p.game_id = t.game_id
        where t.market_id in (p.winner_market_id, p.loser_market_id)""",
    "lgrid": """
        select game_id, g0, case when date_trunc('minute', last_live) = last_live then last_live
                                 else date_trunc('minute', last_live) + interval 1 minute end g1
        from (select game_id, date_trunc('minute', min(game_start)) g0,
                     max(case when trade_time >= game_start then trade_time end) last_live
              from scored where game_id in (select game_id from pairs) group by game_id) x
        where last_live is not null""",
    "lb": """
        select game_id, role, date_trunc('minute', trade_time) bucket, arg_max(price, (trade_time, trade_id)) price
        from lt group by 1, 2, 3""",
    "lown": """
        select g.game_id, g.role, g.minute, last_value(b.price ignore nulls) over
                 (partition by g.game_id, g.role order by g.minute rows between unbounded preceding and current row) price
        from (select game_id, role, unnest(generate_series(min(bucket), max(bucket), interval 1 minute)) as minute
              from lb group by 1, 2) g
        left join lb b on b.game_id = g.game_id and b.role = g.role and b.bucket = g.minute""",
    "lre": """
        select x.game_id, r.role, x.minute, last_value(o.price ignore nulls) over
                 (partition by x.game_id, r.role order by x.minute rows between unbounded preceding and current row) price
        from (select game_id, unnest(generate_series(g0, g1, interval 1 minute)) as minute from lgrid) x
        cross join (select 0 role union all select 1) r
        left join lown o on o.game_id = x.game_id and o.role = r.role and o.minute = x.minute""",
    "lpath": """
        select game_id, minute, avg(case when role = 1 then price else 1.0 - price end) winner_probability
        from lre group by 1, 2 having count(price) > 0""",
    "lsum": """
        select *, live_trade_count > 0 has_any_live_trades, live_duration_minutes >= 15 has_enough_live_coverage
        from (select g.game_id, g.game_start, g.winner_side,
               case when s.p0 is null then 0 else coalesce(t.n, 0) end live_trade_count,
               case when s.p0 is null then 0.0 else coalesce(t.vol, 0.0) end live_volume,
               case when s.p0 is null then 0 else coalesce(t.mk, 0) end live_markets_with_trades,
               case when s.p0 is not null then t.f end first_live_trade_time,
               case when s.p0 is not null then t.l end last_live_trade_time,
               case when s.p0 is null then 0.0 else date_diff('microsecond', s.p0, s.p1) / 6e7 end live_duration_minutes,
               s.first_p winner_prob_first_pitch, s.last_p winner_prob_last_observed,
               s.last_p - s.first_p live_repricing_to_winner,
               case when s.p0 is not null then coalesce(s.tot, 0.0) end total_abs_live_move,
               case when s.tot > 0 then abs(s.last_p - s.first_p) / s.tot end path_efficiency,
               s.mx max_1m_abs_move, s.j5 jump_count_5c, s.j10 jump_count_10c,
               case when s.tot > 0 then s.mx / s.tot end largest_jump_share_of_path,
               s.slope trend_slope_per_hour
        from games g
        left join (select game_id, min(minute) p0, max(minute) p1, arg_min(winner_probability, minute) first_p,
                          arg_max(winner_probability, minute) last_p, sum(a) tot, max(a) mx,
                          count(*) filter (where a >= 0.05) j5, count(*) filter (where a >= 0.10) j10,
                          case when min(x) < max(x) then covar_pop(x, winner_probability) / var_pop(x) end slope
                   from (select p.*, abs(winner_probability - lag(winner_probability) over
                                    (partition by p.game_id order by minute)) a,
                                date_diff('microsecond', g.game_start, minute) / 3.6e9 x
                         from lpath p join games g on g.game_id = p.game_id) d group by game_id) s
               on s.game_id = g.game_id
        left join (select game_id, count(*) n, cast(sum(size) as double) vol, count(distinct market_id) mk,
                          min(trade_time) f, max(trade_time) l from livep group by game_id) t
               on t.game_id = g.game_id) z""",
    "depth": """
        select market_id, coalesce(sum(size) filter (where side = 'yes'), 0) orderbook_yes_depth_contracts,
               coalesce(sum(size) filter (where side = 'no'), 0) orderbook_no_depth_contracts,
               coalesce(sum(size), 0) orderbook_total_depth_contracts,
               max(price) filter (where side = 'yes') best_yes_bid, max(price) filter (where side = 'no') best_no_bid
        from levels group by market_id""",
    "istd": """
        select market_id, case when count(*) = 0 then null when count(*) = 1 then 0.0
                               when sum(size) <= 0 then stddev_pop(p)
                               else sqrt(sum(size * (p - wm) * (p - wm)) / sum(size)) end orderbook_yes_implied_std
        from (select *, sum(size * p) over (partition by market_id) / sum(size) over (partition by market_id) wm
              from (select market_id, size, case when side = 'yes' then price else 1.0 - price end p
                    from levels) a) b
        group by market_id""",
    # Pregame summary with market context and book depth
    "la": """
        select s.*, x.* exclude (market_id), d.orderbook_yes_depth_contracts, d.orderbook_no_depth_contracts,
               d.orderbook_total_depth_contracts, d.best_yes_bid, d.best_no_bid
        from msum s left join mctx x on x.market_id = s.market_id
        left join depth d on d.market_id = s.market_id""",
    # Analysable live games with pregame and book context per game
    "lla": """
        select g.*, c.pregame_trade_count, c.pregame_volume, c.market_volume_fp, c.market_liquidity_dollars,
               c.orderbook_total_depth_contracts,
               c.orderbook_yes_depth_contracts, c.orderbook_no_depth_contracts
        from (select * from lsum where has_enough_live_coverage) g
        left join (select game_id, sum(pregame_trade_count) pregame_trade_count, sum(pregame_volume) pregame_volume,
                          sum(volume_fp) market_volume_fp, sum(liquidity_dollars) market_liquidity_dollars,
                          coalesce(sum(orderbook_total_depth_contracts), 0) orderbook_total_depth_contracts,
                          coalesce(sum(orderbook_yes_depth_contracts), 0) orderbook_yes_depth_contracts,
                          coalesce(sum(orderbook_no_depth_contracts), 0) orderbook_no_depth_contracts
                   from la group by game_id) c on c.game_id = g.game_id""",
    "raw_series": """
        select 'KXS' || cast(n_nationkey as varchar) ticker,
               case when n_regionkey < 3 then 'Sports' else 'Economics' end category,
               case n_nationkey % 7 when 0 then 'Pro Baseball Spread' when 1 then 'Pro Baseball Hits'
                    when 2 then 'First 5 Innings Winner' else n_name end title,
               case n_nationkey % 3 when 0 then ['Baseball', 'Sports'] when 1 then ['BaseBall']
                    else ['Basketball'] end tags,
               'daily' frequency, cast(n_regionkey as decimal(38,0)) fee_multiplier, 'quadratic' fee_type,
               '2024-01-0' || cast(n_regionkey + 1 as varchar) || 'T00:00:00Z' last_updated_ts
        from nation""",
    "raw_events": """
        select 'EVT-' || cast(c_custkey as varchar) event_ticker, 'KXS' || cast(c_nationkey as varchar) series_ticker,
               c_mktsegment category, c_name title, c_mktsegment sub_title, c_acctbal > 0 available_on_brokers,
               c_nationkey % 2 = 0 mutually_exclusive, 'binary' collateral_return_type,
               case when c_custkey % 10 = 0 then 'bad'
                    else strftime(timestamp '2024-01-01 00:00:00' + to_seconds(c_custkey), '%Y-%m-%dT%H:%M:%SZ')
               end last_updated_ts,
               cast(null as varchar) product_metadata
        from customer""",
    "raw_markets": """
        select 'MKT-' || cast(o_orderkey as varchar) ticker, 'EVT-' || cast(o_custkey as varchar) event_ticker,
               o_orderpriority title, o_orderstatus status,
               case o_orderstatus when 'F' then 'yes' when 'P' then 'no' else '' end result,
               o_orderpriority yes_sub_title,
               case when o_orderkey % 3 = 0 then o_orderpriority else 'other' end no_sub_title,
               strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') close_time,
               cast(cast(o_totalprice as decimal(18,2)) as varchar) liquidity_dollars,
               cast(o_custkey as varchar) volume_fp, o_orderkey % 2 = 0 can_close_early
        from orders""",
    "raw_trades": """
        select cast(trade_id as varchar) trade_id, cast(market_id as varchar) ticker,
               case when trade_id % 97 = 0 then 'n/a' else cast(size as varchar) end count_fp, taker_side,
               cast(cast(1 - price + case when trade_id % 101 = 0 then 0.02 else 0.0 end as decimal(18,4)) as varchar)
                 no_price_dollars,
               cast(cast(price as decimal(18,4)) as varchar) yes_price_dollars,
               strftime(trade_time, '%Y-%m-%dT%H:%M:%SZ') created_time
        from trades""",
    "gt": """
        select game_id, side, game_start, ev event_ticker, ev || '-S' || cast(side as varchar) market_ticker
        from (select game_id, side, game_start,
                     'KXGAME-' || upper(strftime((game_start at time zone 'UTC') at time zone 'America/New_York',
                                                 '%y%b%d%H%M'))
                     || 'H' || cast(game_id as varchar) || 'A' || cast(game_id as varchar) ev
              from (select game_id, side, min(game_start) game_start from trades group by 1, 2) g) x""",
    "teams": """
        select n_nationkey team_id, n_name full_team_name, lower(substr(n_name, 1, 3)) team_code,
               upper(substr(n_name, 1, 3)) abbreviation, n_name team_name, r_name location_name,
               '1884' first_year_of_play, 1 sport_id, 'Major League Baseball' sport_name, r_regionkey league_id,
               r_name league_name, n_regionkey * 100 + n_nationkey division_id, r_name || ' ' || n_name division_name,
               s_suppkey venue_id, 'Park ' || cast(s_suppkey as varchar) venue_name, s_suppkey % 2 = 0 is_active,
               case when s_suppkey % 9 = 0 then null
                    else timestamp '2024-01-01 00:00:00' + to_hours(cast(s_suppkey % 48 as int)) end ingested_at,
               'teams_' || cast(s_suppkey % 4 as varchar) || '.jsonl' source_file, s_suppkey source_row_number,
               timestamp '2024-02-01 00:00:00' + to_hours(cast(s_suppkey % 5 as int)) loaded_at
        from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
}

VIEWS["near_trades"] = f"""
        select * replace (
          timestamp '2000-01-01 00:00:00' + to_microseconds(cast(date_diff('microsecond', timestamp '2000-01-01 00:00:00', timestamp '2024-01-16 00:00:00') + date_diff('microsecond', timestamp '2000-01-01 00:00:00', trade_time) // 60 - date_diff('microsecond', timestamp '2000-01-01 00:00:00', timestamp '2024-01-16 00:00:00') // 60 as bigint)) as trade_time,
          timestamp '2024-01-16 00:00:00' + to_minutes(cast(game_id % 24 as int))
            + to_seconds(cast(game_id % 3 * 20 as int)) as game_start)
        from ({VIEWS['trades']}) far"""
VIEWS["edge_trades"] = f"""
        select * replace (case when trade_id % 53 <> 0 then price end as price,
                          case when trade_id % 59 = 0 then game_start else trade_time end as trade_time)
        from ({VIEWS['trades']}) plain"""
VIEWS["mctx"] = """
        select m.*, case when lower(trim(k.market_result)) in ('yes', 'no') then 'market_result'
                         when w.winner_side is not null then 'winner_map' else 'missing' end outcome_source
        from (select market_id, 'Market ' || cast(market_id as varchar) market_title,
                     case when market_id % 4 = 0 then 'open' else 'settled' end market_status,
                     arg_max(price, (trade_time, trade_id)) last_price_dollars, cast(sum(size) as double) volume_fp,
                     case when market_id % 11 <> 0 then round(sum(size * price), 4) end liquidity_dollars,
                     arg_max(price, (trade_time, trade_id)) - 0.01 yes_bid_dollars,
                     arg_max(price, (trade_time, trade_id)) + 0.01 yes_ask_dollars,
                     cast(market_id % 13 + 1 as double) yes_bid_size_fp, cast(market_id % 7 + 1 as double) yes_ask_size_fp
              from trades group by market_id) m
        join markets k on k.market_id = m.market_id left join winners w on w.game_id = k.game_id"""


def raw_markets_full_sql(orders: str = "orders") -> str:
    """The oracle side of ``proxies.raw_markets_full``: nested values as the JSON text they land as."""
    base = {"ticker": "'MKT-' || cast(o_orderkey as varchar)", "event_ticker": "'EVT-' || cast(o_custkey as varchar)",
            "title": "o_orderpriority"}
    cols = []
    for i, (name, kind) in enumerate(MARKET_LOAD):
        value = {"string": f"'{name}-' || cast(o_orderkey % 97 as varchar)", "boolean": f"(o_orderkey + {i}) % 2 = 0",
                 "time": "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')",
                 "price": f"cast(cast((o_orderkey + {i}) % 100 / 100 as decimal(18,4)) as varchar)",
                 "size": f"cast((o_orderkey + {i}) % 1000 as varchar)",
                 "number": "case when o_orderkey % 4 = 0 then 'n/a' else cast(o_orderkey % 3600 as varchar) end",
                 "object": "'{\"floor\":' || cast(o_orderkey % 50 as varchar) || '}'",
                 "array": "'[{\"start\":\"' || cast(o_orderkey % 5 as varchar) || '\"}]'",
                 "timestamp": "cast(o_orderdate as timestamp)"}[kind]
        cols.append(f"{base[name] if name in base else f'case when (o_orderkey + {i}) % 5 <> 0 then {value} end'} {name}")
    return f"select {', '.join(cols)} from {orders}"


VIEWS["raw_markets_full"] = raw_markets_full_sql()
for _entity, (_table, _n, _key, _value, _groups) in {
        "events": ("customer", "c_custkey", "event_ticker", "c_name", 40),
        "orderbooks": ("supplier", "s_suppkey", "market_ticker", "s_name", 7),
        "series": ("part", "p_partkey", "ticker", "p_name", 60)}.items():
    VIEWS[f"load_{_entity}"] = f"""
        select 'K-' || cast({_n} % {_groups} as varchar) {_key}, {_value} title,
               case when {_n} % 7 <> 0 then timestamp '2024-01-01 00:00:00' + to_hours(cast({_n} % 3 as int)) end ingested_at,
               timestamp '2024-02-01 00:00:00' + to_hours(cast({_n} % 2 as int)) loaded_at,
               'f' || cast({_n} % 4 as varchar) || '.jsonl' source_file, {_n} source_row_number
        from {_table}"""
# the order book of a market as the JSON text it arrives as
VIEWS["book_text"] = """
        select market_id, '{"yes_dollars":[' || coalesce(string_agg(lvl, ',' order by price desc) filter (where side = 'yes'), '')
                 || '],"no_dollars":[' || coalesce(string_agg(lvl, ',' order by price desc) filter (where side = 'no'), '')
                 || ']}' orderbook
        from (select market_id, side, price, '["' || cast(price as varchar) || '","' || cast(sum(size) as varchar) || '"]' lvl
              from levels group by market_id, side, price) l group by market_id"""

DEPS: dict[str, list[str]] = {
    "mctx": ["trades", "markets", "winners"],
    "book_text": ["levels"],
    "markets": ["trades"],
    "winners": ["markets"],
    "labelled": ["trades", "markets", "winners"],
    "scored": ["labelled"],
    "pregame": ["scored"],
    "livep": ["scored"],
    "msum": ["pregame"],
    "esum": ["msum"],
    "cp": ["pregame", "cps"],
    "conc": ["msum", "cp"],
    "mo": ["markets", "winners"],
    "pairs": ["mo"],
    "games": ["mo"],
    "pb": ["pregame", "pairs"],
    "ppath": ["pb"],
    "pp": ["ppath"],
    "pdl": ["pp"],
    "lagc": ["pdl"],
    "bestlag": ["lagc"],
    "lt": ["scored", "pairs"],
    "lgrid": ["scored", "pairs"],
    "lb": ["lt"],
    "lown": ["lb"],
    "lre": ["lgrid", "lown"],
    "lpath": ["lre"],
    "lsum": ["games", "lpath", "livep"],
    "depth": ["levels"],
    "istd": ["levels"],
    "la": ["msum", "mctx", "depth"],
    "lla": ["lsum", "la"],
    "raw_trades": ["trades"],
    "gt": ["trades"],
}


def _order(names):
    seen: list[str] = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in seen:
            seen.append(n)
    for n in names:
        visit(n)
    return seen


# views that a LIMIT above them would otherwise be pushed into, which turns their joins into nested loops
MATERIALIZED = {"pp"}


def with_views(body: str, *names: str, extra: dict[str, str] | None = None, trades: str = "trades") -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first).

    ``extra`` adds query-local CTEs after the proxy views, in order.
    ``trades`` names the view that stands for the prints.
    """
    parts = [f"{n} as {'materialized ' if n in MATERIALIZED else ''}({VIEWS[trades if n == 'trades' else n]})" for n in _order(names)]
    for n, q in (extra or {}).items():
        parts.append(f"{n} as ({q})")
    if not parts:
        return body
    return "with " + ",\n".join(parts) + "\n" + body


def rounded(body: str, doubles: list[str], places: int = 9) -> str:
    """Wrap a statement so the listed double columns are rounded like the
    Spark side (``round_doubles``)."""
    if not doubles:
        return body
    rep = ", ".join(f"round({c}, {places}) as {c}" for c in doubles)
    return f"select * replace ({rep}) from ({body}) _r"
