"""Pregame repricing: per-market and per-game summaries, yes/no answers,
checkpoint tables and the final-hour concentration (A8-A16, J12).

Input P = scored prints (winner_probability, brier_score) of one window.
Per-market work is one window (lag) plus one aggregate on the same key, so
Spark reuses the market partitioning and shuffles once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.stats import safe_slope
from marketlake.functions.timecols import elapsed_hours
from marketlake.operators.paths import SLICE, sliced_prev
from marketlake.operators.quantiles import medians_wide

def _order():
    return F.struct("trade_time", "trade_id")


def _winner(df: DataFrame) -> list:
    """The winner of the row's game, where the frame knows it."""
    return [F.min("winner_side").alias("winner_side")] if "winner_side" in df.columns else []


def pregame_market_summary(p: DataFrame, key: str = "market_id", event: str = "game_id",
                           team: str = "side", slice_unit: str = SLICE) -> DataFrame:
    """25 columns per market from its first and last pregame print.
    ``slice_unit``: the time slice a hot market's prints are windowed by."""
    d = sliced_prev(p, key, ("winner_probability",), slice_unit=slice_unit)
    d = d.withColumn("_step", F.abs(F.col("winner_probability") - F.col("prev_winner_probability"))) \
         .withColumn("_x", elapsed_hours(F.col("game_start"), F.col("trade_time")))
    first = lambda c: F.min_by(c, _order())
    last = lambda c: F.max_by(c, _order())
    s = d.groupBy(key).agg(
        first(event).alias(event), first(team).alias(team), *_winner(p),
        first("actual_outcome").alias("actual_outcome"),
        F.min("trade_time").alias("first_trade_time"),
        F.max("trade_time").alias("last_pregame_trade_time"),
        first("game_start").alias("game_start"),
        F.count(F.lit(1)).alias("pregame_trade_count"),
        F.sum("size").cast("bigint").alias("pregame_volume"),
        first("price").alias("open_price"), last("price").alias("first_pitch_price"),
        first("winner_probability").alias("winner_prob_open"),
        last("winner_probability").alias("winner_prob_first_pitch"),
        first("brier_score").alias("brier_open"), last("brier_score").alias("brier_first_pitch"),
        F.coalesce(F.sum("_step"), F.lit(0.0)).alias("total_abs_winner_prob_move"),
        safe_slope("winner_probability", "_x").alias("winner_prob_slope_per_hour"),
    )
    net = F.col("winner_prob_first_pitch") - F.col("winner_prob_open")
    return (s.withColumn("hours_observed_pregame",
                         elapsed_hours(F.col("first_trade_time"), F.col("last_pregame_trade_time")))
             .withColumn("price_change", F.col("first_pitch_price") - F.col("open_price"))
             .withColumn("winner_prob_change", net)
             .withColumn("moved_toward_winner", net > 0)
             .withColumn("brier_improvement", F.col("brier_open") - F.col("brier_first_pitch"))
             .withColumn("forecast_improved", F.col("brier_open") > F.col("brier_first_pitch"))
             .withColumn("path_efficiency",
                         F.when(F.col("total_abs_winner_prob_move") > 0,
                                F.abs(net) / F.col("total_abs_winner_prob_move"))))


def pregame_event_summary(s: DataFrame, event: str = "game_id", key: str = "market_id") -> DataFrame:
    """Market summaries averaged over the contracts of a game."""
    e = s.groupBy(event).agg(
        *_winner(s), F.countDistinct(key).alias("markets"),
        F.sum("pregame_trade_count").alias("pregame_trade_count"),
        F.sum("pregame_volume").alias("pregame_volume"),
        F.avg("winner_prob_open").alias("mean_winner_prob_open"),
        F.avg("winner_prob_first_pitch").alias("mean_winner_prob_first_pitch"),
        F.avg("winner_prob_change").alias("mean_winner_prob_change"),
        F.avg("brier_open").alias("mean_brier_open"),
        F.avg("brier_first_pitch").alias("mean_brier_first_pitch"),
        F.avg("brier_improvement").alias("mean_brier_improvement"),
        F.avg("path_efficiency").alias("mean_path_efficiency"),
    )
    return (e.withColumn("forecast_improved", F.col("mean_brier_improvement") > 0)
             .withColumn("moved_toward_winner", F.col("mean_winner_prob_change") > 0))


def answers(questions: list[tuple]) -> DataFrame:
    """One row per question - yes count, rows in scope, share of
    yes (NULL over no rows).

    A question is ``(text, frame, flag)`` or ``(text, frame, flag, scope)``
    with ``scope`` a boolean column of the frame that limits the rows it
    counts.  All questions over the same frame are answered by one global
    aggregate (partial per task, one row per frame reaches the driver side
    of the plan), so the frame's plan runs once, not once per question."""
    frames: list[tuple[DataFrame, list]] = []
    for i, qn in enumerate(questions):
        q, df, flag = qn[:3]
        scope = qn[3] if len(qn) > 3 else None
        for fr, items in frames:
            if fr is df:
                items.append((i, q, flag, scope))
                break
        else:
            frames.append((df, [(i, q, flag, scope)]))
    parts = []
    for df, items in frames:
        aggs, cells = [], []
        for i, q, flag, scope in items:
            inside = F.lit(True) if scope is None else F.coalesce(F.col(scope), F.lit(False))
            f = F.when(inside, F.col(flag).cast("int"))
            aggs += [F.coalesce(F.sum(f), F.lit(0)).cast("bigint").alias(f"_y{i}"),
                     F.count_if(inside).alias(f"_n{i}"),
                     F.avg(f.cast("double")).alias(f"_s{i}")]
            cells.append(F.struct(F.lit(i).alias("question_order"), F.lit(q).alias("question"),
                                  F.col(f"_y{i}").alias("yes_count"), F.col(f"_n{i}").alias("total"),
                                  F.col(f"_s{i}").alias("share")))
        parts.append(df.agg(*aggs).select(F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, parts)


def contract_sync(s: DataFrame, event: str = "game_id", key: str = "market_id") -> DataFrame:
    """Improving contracts per game and the spread of improvements."""
    return s.groupBy(event).agg(
        *_winner(s), F.sum(F.col("forecast_improved").cast("int")).cast("bigint").alias("improving_contracts"),
        F.countDistinct(key).alias("contracts"),
        F.avg("brier_improvement").alias("mean_brier_improvement"),
        F.min("brier_improvement").alias("min_brier_improvement"),
        F.max("brier_improvement").alias("max_brier_improvement"),
        F.avg("winner_prob_change").alias("mean_winner_prob_change"),
    ).withColumn("game_improved_mean_brier", F.col("mean_brier_improvement") > 0)


def contract_sync_distribution(sync: DataFrame) -> DataFrame:
    """Games per number of improving contracts."""
    return sync.groupBy("improving_contracts").agg(F.count(F.lit(1)).alias("games"))


def checkpoint_summary(c: DataFrame, key: str = "market_id") -> DataFrame:
    """Markets, mean and median probability and Brier per checkpoint
    (exact medians, distributed: see ``quantiles``)."""
    keys = ["checkpoint_order", "checkpoint"]
    means = c.groupBy(*keys).agg(
        F.countDistinct(key).alias("markets"),
        F.avg("winner_probability").alias("mean_winner_probability"),
        F.avg("brier_score").alias("mean_brier_score"))
    meds = medians_wide(c, keys, {"median_winner_probability": "winner_probability",
                                  "median_brier_score": "brier_score"})
    return means.join(meds, keys, "left").select(
        *keys, "markets", "mean_winner_probability", "median_winner_probability", "mean_brier_score",
        "median_brier_score")


def checkpoint_wide(c: DataFrame, value: str, names: list[str], prefix: str,
                    key: str = "market_id") -> DataFrame:
    """Market x checkpoint pivot of one value (names given, so no
    distinct job).  One print per (market, checkpoint), so any() = last."""
    p = c.groupBy(key).pivot("checkpoint", names).agg(F.first(value))
    return p.select(key, *[F.col(n).alias(f"{prefix}{n}") for n in names])


def final_hour_concentration(s: DataFrame, c: DataFrame, names: list[str],
                             key: str = "market_id", event: str = "game_id",
                             team: str = "side") -> DataFrame:
    """J12 + A15: summary LEFT JOIN the Brier and probability pivots; total
    and final-hour improvement; final-hour share when the total is positive."""
    # both values in one pivot (one pass over the checkpoint rows)
    both = c.groupBy(key).pivot("checkpoint", names).agg(F.first("brier_score").alias("b"),
                                                         F.first("winner_probability").alias("p"))
    wide = both.select(key, *[F.col(f"{n}_b").alias(f"brier_{n}") for n in names],
                       *[F.col(f"{n}_p").alias(f"winner_prob_{n}") for n in names])
    winner = ["winner_side"] if "winner_side" in s.columns else []
    j = s.select(key, event, team, *winner, "path_efficiency").join(wide, key, "left")
    tot = F.col("brier_first_observed") - F.col("brier_first_pitch")
    fin = F.col("brier_1h_before") - F.col("brier_first_pitch")
    return (j.withColumn("total_brier_improvement", tot)
             .withColumn("final_hour_brier_improvement", fin)
             .withColumn("final_hour_share_of_positive_improvement", F.when(tot > 0, F.try_divide(fin, tot)))
             .withColumn("total_winner_prob_change",
                         F.col("winner_prob_first_pitch") - F.col("winner_prob_first_observed"))
             .withColumn("final_hour_winner_prob_change",
                         F.col("winner_prob_first_pitch") - F.col("winner_prob_1h_before")))


def concentration_medians(conc: DataFrame) -> DataFrame:
    """Median final-hour share among improving markets; median path
    efficiency over all markets.  One global aggregate, one row."""
    return medians_wide(conc, [], {
        "median_final_hour_share": F.when(F.col("total_brier_improvement") > 0,
                                          F.col("final_hour_share_of_positive_improvement")),
        "median_path_efficiency": "path_efficiency"})
