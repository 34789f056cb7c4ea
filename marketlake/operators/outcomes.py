"""Outcome labelling: market result or winner map, window label, winner
probability and Brier score (P18, P21, P22, J4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.paths import label_window


def normalized_result(col: str = "market_result"):
    r = F.lower(F.trim(F.col(col)))
    return F.when(r.isin("yes", "no"), r)


def market_outcome(markets: DataFrame, winners: DataFrame | None,
                   team_col: str = "side", winner_col: str = "winner_side",
                   event_col: str = "game_id") -> DataFrame:
    """1/0 from a yes/no market result (trimmed, case-folded); else from
    the winner map (team == winner); else NULL.  Adds ``outcome_source``.

    The winner map has one row per event, so it is joined as a small
    dimension (AQE broadcasts it when its runtime size allows)."""
    m = markets.drop(winner_col) if winner_col in markets.columns else markets
    if winners is not None:
        m = m.join(winners.select(event_col, winner_col), event_col, "left")
    else:
        m = m.withColumn(winner_col, F.lit(None))
    res = normalized_result()
    from_result = F.when(res == "yes", F.lit(1.0)).when(res == "no", F.lit(0.0))
    from_map = F.when(F.col(winner_col).isNotNull(),
                      F.when(F.col(team_col) == F.col(winner_col), F.lit(1.0)).otherwise(F.lit(0.0)))
    source = (F.when(res.isNotNull(), F.lit("market_result"))
              .when(F.col(winner_col).isNotNull(), F.lit("winner_map"))
              .otherwise(F.lit("missing")))
    return m.withColumn("actual_outcome", F.coalesce(from_result, from_map)) \
            .withColumn("outcome_source", source)


def labelled_trades(t: DataFrame, markets_with_outcome: DataFrame, boundary: str = "left",
                    key: str = "market_id") -> DataFrame:
    """J4 + P18 + P20: trades INNER JOIN markets (one row per market), drop
    rows lacking time, price or outcome, label pregame / live."""
    carry = [c for c in ("market_result", "winner_side", "actual_outcome") if c in markets_with_outcome.columns]
    m = markets_with_outcome.select(key, *carry)
    j = t.join(m, key, "inner")
    j = drop_incomplete(j, ["trade_time", "price", "actual_outcome"])
    return label_window(j, boundary)


def drop_incomplete(df: DataFrame, cols: list[str]) -> DataFrame:
    """P18."""
    return df.na.drop(subset=cols)


def winner_probability(df: DataFrame, price: str = "price", outcome: str = "actual_outcome") -> DataFrame:
    """Probability the market gave the eventual winner, and Brier score."""
    return (df.withColumn("winner_probability",
                          F.when(F.col(outcome) == 1.0, F.col(price)).otherwise(1.0 - F.col(price)))
              .withColumn("brier_score", F.pow(F.col(price) - F.col(outcome), 2)))
