"""Path operators on small hand-made frames (ties, boundaries, gaps)."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake.operators import paths as PA

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def prints(spark, rows):
    return spark.createDataFrame(
        [(tid, m, m // 2, m % 2, T0 + dt.timedelta(seconds=s), p, z, T0 + dt.timedelta(hours=2))
         for tid, m, s, p, z in rows],
        "trade_id long, market_id long, game_id long, side long, trade_time timestamp_ntz, price double, "
        "size int, game_start timestamp_ntz")


def test_information_score_ties_and_guards(spark):
    t = prints(spark, [(1, 0, 0, 0.50, 1), (2, 0, 0, 0.55, 3), (3, 0, 10, 0.55, 1), (4, 0, 20, 0.40, 0)])
    out = {r.trade_id: r for r in PA.trade_information_score(t).collect()}
    # trade 1 has no previous print, trade 3 did not move: both dropped
    assert set(out) == {2, 4}
    assert abs(out[2].information_score - 0.05 / __import__("math").log(4)) < 1e-12
    assert out[2].move_direction == "yes-favorable shock"
    # size 0 -> no score, still a moving print
    assert out[4].information_score is None and out[4].move_direction == "no-favorable shock"


def test_sliced_prev_matches_plain_lag(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        rows.append((i, rnd.randint(0, 3), rnd.randint(0, 5 * 3600), round(rnd.random(), 4), rnd.randint(1, 9)))
    t = prints(spark, rows)
    got = PA.sliced_prev(t, "market_id", ("price",), running=("size",), slice_unit="hour")
    w = Window.partitionBy("market_id").orderBy("trade_time", "trade_id")
    want = t.select("trade_id", F.lag("price").over(w).alias("p"),
                    F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("r"))
    j = got.join(want, "trade_id")
    bad = j.filter(~F.col("prev_price").eqNullSafe(F.col("p")) | (F.col("run_size") != F.col("r"))).count()
    assert bad == 0



def test_sliced_prev_with_gaps_and_same_instant_ties(spark):
    """Minute slices, long empty stretches between bursts, many prints at the
    same instant (ordered by trade_id): carries cross empty slices."""
    rnd = random.Random(3)
    rows = []
    for i in range(300):
        burst = rnd.choice([0, 7, 8, 300, 301, 2000])           # minutes; big gaps between bursts
        sec = burst * 60 + rnd.choice([0, 0, 0, 5, 59])          # many exact ties
        rows.append((i, rnd.randint(0, 2), sec, round(rnd.random(), 4), rnd.randint(1, 9)))
    t = prints(spark, rows)
    got = PA.sliced_prev(t, "market_id", ("price", "trade_time"), running=("size",), slice_unit="minute")
    w = Window.partitionBy("market_id").orderBy("trade_time", "trade_id")
    want = t.select("trade_id", F.lag("price").over(w).alias("p"), F.lag("trade_time").over(w).alias("pt"),
                    F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("r"))
    j = got.join(want, "trade_id")
    assert j.count() == len(rows)
    bad = j.filter(~F.col("prev_price").eqNullSafe(F.col("p")) | ~F.col("prev_trade_time").eqNullSafe(F.col("pt"))
                   | (F.col("run_size") != F.col("r"))).count()
    assert bad == 0

def test_minute_path_forward_fills_and_keeps_last_duplicate(spark):
    t = prints(spark, [(1, 0, 0, 0.1, 1), (2, 0, 30, 0.2, 1), (3, 0, 30, 0.3, 1), (4, 0, 180, 0.4, 1)])
    got = {r.minute: r.price for r in PA.minute_path(t, "minute").collect()}
    assert got == {T0: 0.3, T0 + dt.timedelta(minutes=1): 0.3, T0 + dt.timedelta(minutes=2): 0.3,
                   T0 + dt.timedelta(minutes=3): 0.4}


def test_label_window_boundary_rules(spark):
    t = prints(spark, [(1, 0, 7200, 0.5, 1), (2, 0, 7199, 0.5, 1)])
    left = {r.trade_id: r.window for r in PA.label_window(t, "left").collect()}
    right = {r.trade_id: r.window for r in PA.label_window(t, "right").collect()}
    assert left == {1: "live", 2: "pregame"}
    assert right == {1: "pregame", 2: "pregame"}


def test_checkpoint_prices_inclusive_and_missing(spark):
    # start at T0+2h; prints at -3h (none), -1h exactly, -30m, 0
    t = prints(spark, [(1, 0, 3600, 0.1, 1), (2, 0, 5400, 0.2, 1), (3, 0, 7200, 0.3, 1)])
    cps = [("first_observed", None), ("3h_before", "3 hours"), ("1h_before", "1 hour"), ("first_pitch", "0 seconds")]
    got = {r.checkpoint: r.price for r in PA.checkpoint_prices(t, cps).collect()}
    assert got == {"first_observed": 0.1, "1h_before": 0.1, "first_pitch": 0.3}


def test_next_trade_lag_strictly_later(spark):
    # side 0 at 0s and 60s; side 1 at 60s and 120s (tie at 60s is not 'later')
    rows = [(1, 0, 0, 0.5, 1), (2, 0, 60, 0.5, 1), (3, 1, 60, 0.5, 1), (4, 1, 120, 0.5, 1)]
    got = {r.trade_id: r.lag_minutes for r in PA.next_trade_lag(prints(spark, rows), slice_unit="minute").collect()}
    assert got == {1: 1.0, 2: 1.0}


def test_next_trade_lag_matches_pandas(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.randint(0, 1), rnd.randint(0, 4 * 3600), 0.5, 1) for i in range(300)]
    got = {r.trade_id: r.lag_micros for r in PA.next_trade_lag(prints(spark, rows)).collect()}
    df = pd.DataFrame(rows, columns=["trade_id", "market", "sec", "p", "z"])
    want = {}
    for _, r in df.iterrows():
        later = df[(df.market != r.market) & (df.sec > r.sec)]
        if len(later):
            want[r.trade_id] = int((later.sec.min() - r.sec) * 1_000_000)
    assert got == want


def test_recent_trades_keeps_latest_n(spark):
    t = prints(spark, [(i, 0, i, 0.5, 1) for i in range(10)])
    assert sorted(r.trade_id for r in PA.recent_trades(t, 3).collect()) == [7, 8, 9]


def test_checkpoint_prices_match_brute_force(spark):
    rnd = random.Random(21)
    rows = [(i, rnd.randint(0, 5), rnd.choice([0, 1800, 3600, 3600, 6300, 7200, 7300, rnd.randint(0, 7200)]),
             round(rnd.random(), 4), 1) for i in range(250)]
    offsets = [("first_observed", None), ("6h_before", "6 hours"), ("1h_before", "1 hour"),
               ("15m_before", "15 minutes"), ("first_pitch", "0 seconds")]
    secs = {"6h_before": 6 * 3600, "1h_before": 3600, "15m_before": 900, "first_pitch": 0}
    got = {(r.market_id, r.checkpoint): (r.observed_trade_time, r.price, r.checkpoint_order)
           for r in PA.checkpoint_prices(prints(spark, rows), offsets).collect()}
    want = {}
    start = T0 + dt.timedelta(hours=2)
    for m in {r[1] for r in rows}:
        mine = sorted((T0 + dt.timedelta(seconds=s), tid, p) for tid, mm, s, p, _ in rows if mm == m)
        want[(m, "first_observed")] = (mine[0][0], mine[0][2], 0)
        for k, (name, _) in enumerate(offsets[1:], start=1):
            cp = start - dt.timedelta(seconds=secs[name])
            ok = [x for x in mine if x[0] <= cp]
            if ok:
                want[(m, name)] = (ok[-1][0], ok[-1][2], k)
    assert got == want


def test_live_checkpoint_prices_match_brute_force(spark):
    from marketlake.operators import pairs as PR
    rnd = random.Random(4)
    start = T0 + dt.timedelta(hours=2)
    pts = set()
    for g in range(6):
        lo, hi = rnd.choice([(-30, 10), (0, 40), (5, 200), (-5, 130), (20, 25)])
        for m in rnd.sample(range(lo, hi + 1), min(12, hi - lo + 1)):
            pts.add((g, m))
    rows = [(g, start + dt.timedelta(minutes=m), round(rnd.random(), 4)) for g, m in sorted(pts)]
    path = spark.createDataFrame(rows, "game_id long, minute timestamp_ntz, winner_probability double")
    games = spark.createDataFrame([(g, start) for g in range(6)], "game_id long, game_start timestamp_ntz")
    got = {(r.game_id, r.checkpoint): (r.checkpoint_time, r.winner_probability, r.checkpoint_order)
           for r in PR.live_checkpoint_prices(path, games).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        mine = sorted((m, v) for gg, m, v in rows if gg == g)
        end = mine[-1][0]
        for k, (name, off) in enumerate(PR.LIVE_CHECKPOINTS):
            if off is None:
                want[(g, name)] = (end, mine[-1][1], k)
                continue
            cp = start + dt.timedelta(minutes=off)
            ok = [x for x in mine if x[0] <= cp]
            if ok and cp <= end:
                want[(g, name)] = (cp, ok[-1][1], k)
    assert got == want
