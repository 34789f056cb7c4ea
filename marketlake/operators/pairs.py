"""Paired contracts and live repricing.

A game has two complementary contracts; the winner's YES price and one
minus the loser's YES price both estimate the winner's probability.
Everything is keyed by game, so windows partition by game and the grid
of minutes is generated per observed bucket (no grid-table joins).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.stats import safe_corr, safe_slope
from marketlake.functions.timecols import ceil_to, elapsed_hours, elapsed_minutes, floor_to
from marketlake.operators.paths import bucket_last, fill_forward, minute_path
from marketlake.operators.quantiles import exact_percentiles, medians_wide


def winner_loser_pairs(markets_outcome: DataFrame, event: str = "game_id", key: str = "market_id",
                       team: str = "side", winner: str = "winner_side") -> DataFrame:
    """Per event the winner's market and the first other market
    (smallest key); events lacking either are skipped."""
    is_w = F.col(team) == F.col(winner)
    return (markets_outcome.filter(F.col(winner).isNotNull())
            .groupBy(event)
            .agg(F.min(F.when(is_w, F.col(key))).alias("winner_market_id"),
                 F.min(F.when(~is_w, F.col(key))).alias("loser_market_id"),
                 F.first(winner).alias(winner))
            .filter(F.col("winner_market_id").isNotNull() & F.col("loser_market_id").isNotNull()))


def _roles(t: DataFrame, pairs: DataFrame, event: str = "game_id", key: str = "market_id") -> DataFrame:
    """Prints of paired markets with role 1 = winner, 0 = loser.  ``pairs``
    has one row per event, so the join is against a small dimension."""
    p = pairs.select(event, "winner_market_id", "loser_market_id")
    return (t.join(p, event, "inner")
            .filter((F.col(key) == F.col("winner_market_id")) | (F.col(key) == F.col("loser_market_id")))
            .withColumn("role", (F.col(key) == F.col("winner_market_id")).cast("int"))
            .drop("winner_market_id", "loser_market_id"))


def pair_path(t: DataFrame, pairs: DataFrame, step: str = "minute", event: str = "game_id",
              key: str = "market_id") -> DataFrame:
    """Winner path and 1 - loser path on common buckets (inner on time),
    each forward filled over its own first..last bucket.

    A filled path has one row per (event, role, bucket), so the inner join
    of the two sides is a conditional aggregate by (event, bucket) that keeps
    buckets where both are present: the path is built and shuffled once."""
    r = _roles(t, pairs, event, key)
    path = minute_path(r, step, key=[event, "role"])
    both = path.groupBy(event, "minute").agg(
        F.max(F.when(F.col("role") == 1, F.col("price"))).alias("winner_price"),
        F.max(F.when(F.col("role") == 0, 1.0 - F.col("price"))).alias("loser_implied"),
        (F.count_if(F.col("role") == 1) > 0).alias("_w"), (F.count_if(F.col("role") == 0) > 0).alias("_l"))
    return both.filter(F.col("_w") & F.col("_l")).drop("_w", "_l")


def with_pair_deltas(pp: DataFrame, event: str = "game_id") -> DataFrame:
    w = Window.partitionBy(event).orderBy("minute")
    return (pp.withColumn("winner_delta", F.col("winner_price") - F.lag("winner_price").over(w))
              .withColumn("loser_delta", F.col("loser_implied") - F.lag("loser_implied").over(w)))


def lagged_pair_corr(pp: DataFrame, lags=range(-10, 11), event: str = "game_id") -> DataFrame:
    """Correlation of winner deltas with loser deltas shifted by -10..10
    rows (positive lag = the loser side follows).  Shifts are lead/lag over
    one window per game, and one aggregate per game holds the statistics of
    all lags, so a path row is never copied per lag; a generator then turns
    the game's row into one row per lag (n = 0 and NULL without a complete
    row).  A game's path is bounded by the minutes of a game."""
    d = with_pair_deltas(pp, event).filter(F.col("winner_delta").isNotNull() & F.col("loser_delta").isNotNull())
    w = Window.partitionBy(event).orderBy("minute")
    lags = list(lags)
    shifted = [F.lead("loser_delta", k).over(w) if k > 0 else
               F.lag("loser_delta", -k).over(w) if k < 0 else F.col("loser_delta") for k in lags]
    wide = d.select(event, "winner_delta", *[c.alias(f"_s{i}") for i, c in enumerate(shifted)])
    stats = []
    for i in range(len(lags)):
        stats += [safe_corr("winner_delta", f"_s{i}").alias(f"_c{i}"), F.count(f"_s{i}").alias(f"_n{i}")]
    cells = [F.struct(F.lit(k).alias("lag_minutes"), F.col(f"_c{i}").alias("delta_corr"), F.col(f"_n{i}").alias("n"))
             for i, k in enumerate(lags)]
    return wide.groupBy(event).agg(*stats).select(event, F.inline(F.array(*cells)))


def best_pair_lag(corrs: DataFrame, event: str = "game_id") -> DataFrame:
    """Lag with the highest correlation, smallest lag on ties; NULL when
    no lag has a correlation."""
    ok = F.col("delta_corr").isNotNull()
    rank_key = F.when(ok, F.struct(F.col("delta_corr"), (-F.col("lag_minutes")).alias("neg_lag")))
    return corrs.groupBy(event).agg(
        F.max_by("lag_minutes", rank_key).alias("best_delta_lag_minutes"),
        F.max(F.when(ok, F.col("delta_corr"))).alias("best_delta_corr"))


def best_lag_distribution(best: DataFrame) -> DataFrame:
    """Games per best lag (NULL kept as its own group)."""
    return best.groupBy("best_delta_lag_minutes").agg(F.count(F.lit(1)).alias("games"))


def pair_gap_summary(pp: DataFrame, lags_df: DataFrame, best: DataFrame, pairs: DataFrame,
                     event: str = "game_id") -> DataFrame:
    """Overlap, level and delta correlation, complement gap, and the
    next-trade lags in both directions (from J8 on the paired prints)."""
    d = with_pair_deltas(pp, event)
    gap = F.abs(F.col("winner_price") - F.col("loser_implied"))
    s = d.groupBy(event).agg(
        F.count(F.lit(1)).alias("overlap_minutes"),
        safe_corr("winner_price", "loser_implied").alias("contemporaneous_level_corr"),
        safe_corr("winner_delta", "loser_delta").alias("contemporaneous_delta_corr"),
        F.avg(gap).alias("mean_abs_complement_gap"),
        F.max(gap).alias("max_abs_complement_gap"))
    shares = lags_df.groupBy(event).agg(
        F.avg(F.when(F.col("from_side") == 1, (F.col("lag_minutes") <= 1).cast("double")))
         .alias("share_winner_followed_within_1m"),
        F.avg(F.when(F.col("from_side") == 0, (F.col("lag_minutes") <= 1).cast("double")))
         .alias("share_loser_followed_within_1m"))
    # the lags are read twice; ``lags_df`` is a stored table
    meds = medians_wide(lags_df, [event], cols={
        "median_minutes_winner_to_loser": F.when(F.col("from_side") == 1, F.col("lag_minutes")),
        "median_minutes_loser_to_winner": F.when(F.col("from_side") == 0, F.col("lag_minutes"))})
    lg = shares.join(meds, event, "left")
    return (pairs.select(event, "winner_market_id", "loser_market_id", "winner_side").join(s, event, "inner")
            .join(best, event, "left").join(lg, event, "left"))


def live_path(t: DataFrame, pairs: DataFrame, step: str = "minute", event: str = "game_id",
              key: str = "market_id", start: str = "game_start") -> DataFrame:
    """Winner-normalised path of a game from its start bucket to the
    bucket after its last live print.

    Each contract's own path is filled over its own buckets, then cut to the
    live grid and filled on; a contract whose prints all precede the grid
    contributes nothing.  The path value is the mean of the present sides.
    """
    r = _roles(t, pairs, event, key)
    # the grid spans the event's live prints on any of its contracts
    grid = (t.join(pairs.select(event), event, "left_semi").groupBy(event)
            .agg(F.first(start).alias("_start"),
                 F.max(F.when(F.col("trade_time") >= F.col(start), F.col("trade_time"))).alias("_last_live"))
            .filter(F.col("_last_live").isNotNull())
            .select(event, floor_to("_start", step).alias("g0"), ceil_to("_last_live", step).alias("g1")))
    b = bucket_last(r, [event, "role"], step).join(grid, event, "inner")
    # the last bucket reaches the grid end only when the contract is still
    # observed at or after the grid start
    until = F.when(F.col("bucket") >= F.col("g0"), F.col("g1"))
    filled = fill_forward(b.select(event, "role", "bucket", "price", "g0", "g1"), [event, "role"], step,
                          "price", until=until, out="minute", extra=("g0", "g1"))
    v = F.when(F.col("role") == 1, F.col("price")).otherwise(1.0 - F.col("price"))
    return (filled.filter((F.col("minute") >= F.col("g0")) & (F.col("minute") <= F.col("g1")))
            .groupBy(event, "minute").agg(F.avg(v).alias("winner_probability")))


def live_game_summary(path: DataFrame, live_trades: DataFrame, games: DataFrame,
                      event: str = "game_id", key: str = "market_id", start: str = "game_start",
                      jump: float = 0.05, big_jump: float = 0.10, min_minutes: float = 15) -> DataFrame:
    """18 columns per game from its live path and live prints; games
    without a path get zero counts and NULL path metrics."""
    w = Window.partitionBy(event).orderBy("minute")
    d = (path.join(games.select(event, F.col(start).alias("_gs")), event, "inner")
         .withColumn("_abs", F.abs(F.col("winner_probability") - F.lag("winner_probability").over(w)))
         .withColumn("_x", elapsed_hours(F.col("_gs"), F.col("minute"))))
    order = F.col("minute")
    ps = d.groupBy(event).agg(
        F.min("minute").alias("_p0"), F.max("minute").alias("_p1"),
        F.min_by("winner_probability", order).alias("winner_prob_first_pitch"),
        F.max_by("winner_probability", order).alias("winner_prob_last_observed"),
        F.sum("_abs").alias("_tot"),
        F.max("_abs").alias("max_1m_abs_move"),
        F.count_if(F.col("_abs") >= jump).alias("jump_count_5c"),
        F.count_if(F.col("_abs") >= big_jump).alias("jump_count_10c"),
        safe_slope("winner_probability", "_x").alias("trend_slope_per_hour"))
    ts = live_trades.groupBy(event).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("size").cast("double").alias("_vol"),
        F.countDistinct(key).alias("_mk"),
        F.min("trade_time").alias("_f"), F.max("trade_time").alias("_l"))
    winner = ["winner_side"] if "winner_side" in games.columns else []
    j = games.select(event, start, *winner).join(ps, event, "left").join(ts, event, "left")
    has = F.col("_p0").isNotNull()
    tot = F.coalesce(F.col("_tot"), F.lit(0.0))
    rep = F.col("winner_prob_last_observed") - F.col("winner_prob_first_pitch")
    out = j.select(
        event, start, *winner,
        F.when(has, F.col("_n")).otherwise(F.lit(0)).cast("bigint").alias("live_trade_count"),
        F.when(has, F.col("_vol")).otherwise(F.lit(0.0)).alias("live_volume"),
        F.when(has, F.col("_mk")).otherwise(F.lit(0)).cast("bigint").alias("live_markets_with_trades"),
        F.when(has, F.col("_f")).alias("first_live_trade_time"),
        F.when(has, F.col("_l")).alias("last_live_trade_time"),
        F.when(has, elapsed_minutes(F.col("_p0"), F.col("_p1"))).otherwise(F.lit(0.0)).alias("live_duration_minutes"),
        "winner_prob_first_pitch", "winner_prob_last_observed",
        rep.alias("live_repricing_to_winner"),
        F.when(has, tot).alias("total_abs_live_move"),
        F.when(has & (tot > 0), F.abs(rep) / tot).alias("path_efficiency"),
        "max_1m_abs_move",
        F.when(has, F.col("jump_count_5c")).alias("jump_count_5c"),
        F.when(has, F.col("jump_count_10c")).alias("jump_count_10c"),
        F.when(has & (tot > 0), F.col("max_1m_abs_move") / tot).alias("largest_jump_share_of_path"),
        F.when(has, F.col("trend_slope_per_hour")).alias("trend_slope_per_hour"))
    return (out.withColumn("has_any_live_trades", F.col("live_trade_count") > 0)
               .withColumn("has_enough_live_coverage", F.col("live_duration_minutes") >= min_minutes))


# Metrics of the output.
LIVE_METRICS = ["live_duration_minutes", "live_trade_count", "winner_prob_first_pitch",
                "winner_prob_last_observed", "live_repricing_to_winner", "total_abs_live_move",
                "path_efficiency", "max_1m_abs_move", "jump_count_5c", "largest_jump_share_of_path"]


def live_distribution(summary: DataFrame, metrics: list[str] = LIVE_METRICS,
                      event: str = "game_id") -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear), max per metric,
    one row per metric (numbers, not describe()'s strings)."""
    long = summary.select(event, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        event, metrics, "metric", "value")
    basic = long.groupBy("metric").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_percentiles(long, ["metric"], "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}).drop("count")
    return basic.join(q, "metric", "left").select("metric", "count", "mean", "std", "min", "p25", "p50", "p75",
                                                  "max")


# Checkpoint names of the output.
LIVE_CHECKPOINTS = [("first_pitch", 0), ("15m_live", 15), ("30m_live", 30), ("60m_live", 60),
                    ("120m_live", 120), ("last_observed", None)]


def live_checkpoint_prices(path: DataFrame, games: DataFrame, checkpoints=LIVE_CHECKPOINTS,
                           event: str = "game_id", start: str = "game_start") -> DataFrame:
    """Path value at start + offset (last point at or before it), skipped
    when the offset is past the path's end; plus the last observed point.

    Points are tagged with the first checkpoint they precede (offsets are
    increasing; points after the last one get one more tag) and reduced to
    the last point per (game, tag) - as in J7, without a cross join.  One
    window over a game's tags (a handful of rows) gives the next tag, the
    path's end and its last value, and one generator emits each tag's
    checkpoints plus the game's last observed point, so the path is read
    once."""
    timed = [(n, o) for n, o in checkpoints if o is not None]
    n_timed = len(timed)
    order_of = {n: i for i, (n, _) in enumerate(checkpoints)}
    last_name = [n for n, o in checkpoints if o is None]
    p = path.join(games.select(event, start), event, "inner")
    tag = F.when(F.col("minute").isNull(), F.lit(None).cast("int"))
    for i, (_, o) in enumerate(timed):
        tag = tag.when(F.col("minute") <= F.col(start) + F.expr(f"interval {o} minutes"), F.lit(i))
    tag = tag.otherwise(F.lit(n_timed))
    tagged = (p.withColumn("_tag", tag)
              .groupBy(event, "_tag").agg(F.max_by("winner_probability", F.col("minute")).alias("_v"),
                                          F.max("minute").alias("_tend"), F.first(start).alias("_start")))
    w = Window.partitionBy(event).orderBy("_tag")
    game = Window.partitionBy(event)
    g = tagged.select("*", F.lead("_tag").over(w).alias("_next"), F.max("_tend").over(game).alias("_end"),
                      F.max_by("_v", F.col("_tend")).over(game).alias("_lastv"))
    # (index, is_last): checkpoint indices this tag covers, then the game's
    # last observed point on its latest tag
    cover = F.when(F.col("_tag") < n_timed,
                   F.sequence(F.col("_tag"), F.coalesce(F.col("_next") - 1, F.lit(n_timed - 1))))
    cells = F.transform(F.coalesce(cover, F.array().cast("array<int>")),
                        lambda i: F.struct(i.alias("_i"), F.lit(False).alias("_last")))
    if last_name:
        cells = F.when(F.col("_next").isNull(),
                       F.concat(cells, F.array(F.struct(F.lit(-1).alias("_i"), F.lit(True).alias("_last"))))
                       ).otherwise(cells)
    x = g.select(event, "_start", "_v", "_end", "_lastv", F.inline(cells))
    cp_time = F.when(F.col("_last"), F.col("_end"))
    name = F.when(F.col("_last"), F.lit(last_name[0] if last_name else None))
    order = F.when(F.col("_last"), F.lit(order_of[last_name[0]] if last_name else None))
    for i, (n, o) in enumerate(timed):
        cp_time = cp_time.when(F.col("_i") == i, F.col("_start") + F.expr(f"interval {o} minutes"))
        name = name.when(F.col("_i") == i, F.lit(n))
        order = order.when(F.col("_i") == i, F.lit(order_of[n]))
    value = F.when(F.col("_last"), F.col("_lastv")).otherwise(F.col("_v"))
    return (x.select(event, name.alias("checkpoint"), order.cast("int").alias("checkpoint_order"),
                     cp_time.alias("checkpoint_time"), value.alias("winner_probability"), "_last", "_end")
             .filter(F.col("_last") | (F.col("checkpoint_time") <= F.col("_end")))
             .drop("_last", "_end"))


def live_checkpoint_summary(c: DataFrame, event: str = "game_id") -> DataFrame:
    """A28."""
    keys = ["checkpoint_order", "checkpoint"]
    means = c.groupBy(*keys).agg(F.countDistinct(event).alias("games"),
                                 F.avg("winner_probability").alias("mean_winner_probability"))
    meds = medians_wide(c, keys, {"median_winner_probability": "winner_probability"})
    return means.join(meds, keys, "left")
