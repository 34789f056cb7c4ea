"""Price-path operators over trade prints.

T(market_id, game_id, side, trade_id, trade_time, price, size, ...).
Every window is partitioned by market or game and ordered by
(trade_time, trade_id) so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.timecols import elapsed_micros, floor_to, second_boundaries

ORDER = ("trade_time", "trade_id")


def _by_market(key="market_id", order=ORDER):
    return Window.partitionBy(key).orderBy(*order)


SLICE = "hour"


def sliced_prev(df: DataFrame, key, values: tuple[str, ...], running: tuple[str, ...] = (),
                order: tuple[str, ...] = ORDER, time_col: str = "trade_time",
                slice_unit: str = SLICE) -> DataFrame:
    """Previous row's values (``prev_<v>``) and running sums (``run_<v>``)
    within ``key`` in ``order``, without putting a whole key in one task.

    A key's rows are windowed per (key, time slice), so one very hot market
    spreads over as many tasks as it has slices.  The first row of a slice
    takes its previous values from the last row of the key's previous
    non-empty slice, and running sums add the totals of earlier slices.
    Both come from a per-slice summary - a hash aggregate over the rows
    (``max_by`` on the ordering, ``sum``), partially aggregated before its
    shuffle - and a window over slices, joined back on (key, slice).  The
    rows themselves are shuffled once, by the window; only the summary (one
    row per slice) moves besides, and AQE broadcasts it when small.

    ``order`` columns are ascending (the last row of a slice is the one
    with the largest ordering struct)."""
    keys = [key] if isinstance(key, str) else list(key)
    d = df.withColumn("_slice", floor_to(time_col, slice_unit))
    w = Window.partitionBy(*keys, "_slice").orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = d.select("*", F.row_number().over(w).alias("_rn"),
                     *[F.lag(v).over(w).alias(f"_lp_{v}") for v in values],
                     *[F.sum(v).over(run).alias(f"_lr_{v}") for v in running])
    # one row per slice: its last row's values and its totals
    summ = d.groupBy(*keys, "_slice").agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_last"),
                                          *[F.sum(v).alias(f"_tot_{v}") for v in running])
    ws = Window.partitionBy(*keys).orderBy("_slice")
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select(*keys, "_slice", F.lag("_last").over(ws).alias("_pl"),
                        *[F.sum(f"_tot_{v}").over(before).alias(f"_off_{v}") for v in running])
    j = local.join(carry, [*keys, "_slice"], "left")
    first = F.col("_rn") == 1
    return j.select(*df.columns,
                    *[F.when(first, F.col(f"_pl.{v}")).otherwise(F.col(f"_lp_{v}")).alias(f"prev_{v}")
                      for v in values],
                    *[(F.col(f"_lr_{v}") + F.coalesce(F.col(f"_off_{v}"), F.lit(0))).alias(f"run_{v}")
                      for v in running])


def trade_price_path(t: DataFrame, key: str = "market_id", slice_unit: str = SLICE) -> DataFrame:
    """Delta to the previous print, whole seconds since it (boundary count,
    as the warehouse's datediff), running volume (windows per ``slice_unit``)."""
    p = sliced_prev(t, key, ("price", "trade_time"), running=("size",), slice_unit=slice_unit)
    return p.select(
        *t.columns,
        (F.col("price") - F.col("prev_price")).alias("price_delta"),
        second_boundaries(F.col("prev_trade_time"), F.col("trade_time")).alias("seconds_since_prev"),
        F.col("run_size").alias("cumulative_volume"),
    )


# The two labels of a price move, by its sign.
MOVE_LABELS = {1: "yes-favorable shock", -1: "no-favorable shock"}


def trade_information_score(t: DataFrame, key: str = "market_id", slice_unit: str = SLICE) -> DataFrame:
    """What a print moved the price by, over the log of its size plus one;
    only prints that moved it.  A size of zero or less has no score.
    ``slice_unit``: the time slice a hot market's prints are windowed by."""
    moved = (sliced_prev(t, key, ("price",), slice_unit=slice_unit)
             .withColumn("price_delta", F.col("price") - F.col("prev_price")).where("price_delta <> 0"))
    label = F.element_at(F.create_map(*[F.lit(x) for pair in MOVE_LABELS.items() for x in pair]),
                         F.signum("price_delta").cast("int"))
    return moved.withColumns({
        "information_score": F.abs("price_delta") / F.ln(F.when(F.col("size") > 0, F.col("size") + 1)),
        "move_direction": label})


def top_movers(scored: DataFrame, k: int = 30) -> DataFrame:
    """O1: the k highest scores (TakeOrderedAndProject: per-partition top-k,
    then a k-row merge; never a full sort)."""
    return scored.orderBy(F.col("information_score").desc_nulls_last(), F.col("trade_id")).limit(k)


def path_deltas(df: DataFrame, key, order, value: str, name: str = "delta") -> DataFrame:
    """Difference to the previous row and its absolute value."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    d = F.col(value) - F.lag(value).over(w)
    return df.withColumn(name, d).withColumn(f"abs_{name}", F.abs(F.col(name)))


def first_last_trade(t: DataFrame, key: str = "market_id") -> DataFrame:
    """First and last print per market (ties broken by trade_id)."""
    order = F.struct("trade_time", "trade_id")
    return t.groupBy(key).agg(
        F.min_by("trade_id", order).alias("first_trade_id"),
        F.min("trade_time").alias("first_trade_time"),
        F.min_by("price", order).alias("first_price"),
        F.max_by("trade_id", order).alias("last_trade_id"),
        F.max("trade_time").alias("last_trade_time"),
        F.max_by("price", order).alias("last_price"),
    )


def _step_interval(step: str) -> Column:
    return F.expr(f"interval 1 {step}")


def bucket_last(t: DataFrame, key, step: str = "minute", value: str = "price",
                time_col: str = "trade_time") -> DataFrame:
    """Last value per (key, time bucket); same-instant duplicates keep the
    higher trade_id (pandas keep='last' after a stable sort)."""
    keys = [key] if isinstance(key, str) else list(key)
    return (t.withColumn("bucket", floor_to(time_col, step))
            .groupBy(*keys, "bucket")
            .agg(F.max_by(value, F.struct(time_col, "trade_id")).alias(value)))


def fill_forward(buckets: DataFrame, key, step: str, value: str = "price",
                 until: Column | None = None, out: str = "minute", extra: tuple = ()) -> DataFrame:
    """Forward fill a sparse (key, bucket, value) series onto a regular grid.

    Each observed bucket emits the grid points up to (not including) the next
    observed bucket, so no grid table is built and joined: one window over the
    already aggregated buckets plus a generator.  ``until`` optionally extends
    the last bucket of each key to a per-row end time.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy("bucket")
    nxt = F.lead("bucket").over(w)
    step_i = _step_interval(step)
    last_point = F.col("bucket") if until is None else F.coalesce(F.greatest(F.col("bucket"), until),
                                                                   F.col("bucket"))
    stop = F.coalesce(F.col("_next") - step_i, last_point)
    return (buckets.withColumn("_next", nxt)
            .select(*keys, F.explode(F.sequence(F.col("bucket"), stop, step_i)).alias(out), value, *extra))


def minute_path(t: DataFrame, step: str = "minute", key: str = "market_id",
                value: str = "price") -> DataFrame:
    """Last price per step bucket over each market's first..last bucket,
    forward filled."""
    return fill_forward(bucket_last(t, key, step, value), key, step, value)


def label_window(t: DataFrame, boundary: str = "left", start: str = "game_start",
                 time_col: str = "trade_time") -> DataFrame:
    """P20: pregame / live.  ``left``: a print exactly at the start is live
    (slate analysis); ``right``: right-closed bins, a print at the start is
    pregame (single-market walkthrough)."""
    if boundary == "left":
        pre = F.col(time_col) < F.col(start)
    elif boundary == "right":
        pre = F.col(time_col) <= F.col(start)
    else:
        raise ValueError("boundary must be 'left' or 'right'")
    return t.withColumn("window", F.when(pre, F.lit("pregame")).otherwise(F.lit("live")))


def checkpoint_prices(t: DataFrame, offsets: list[tuple[str, str | None]],
                      key: str = "market_id", start: str = "game_start",
                      carry: tuple[str, ...] = ("price",)) -> DataFrame:
    """As-of backward, inclusive.  For each checkpoint ``start - offset``
    the last print at or before it; ``None`` offset = first observed print.

    Checkpoints are nested in time, so each print is tagged with the first
    checkpoint it precedes (prints after the last one get one more tag),
    the last and first print per (market, tag) are kept, and each kept last
    print is spread forward over the checkpoints up to the next tag; the
    first observed print is the earliest of the per-tag firsts.  No cross
    join; the prints are aggregated once, by (market, tag).
    """
    timed = [(n, o) for n, o in offsets if o is not None]
    # checkpoints ordered by time: larger offsets first
    order_of = {n: i for i, (n, _) in enumerate(offsets)}
    tag = F.when(F.col("trade_time").isNull(), F.lit(None).cast("int"))
    for i, (n, o) in enumerate(timed):
        tag = tag.when(F.col("trade_time") <= F.col(start) - F.expr(f"interval {o}"), F.lit(i))
    tag = tag.otherwise(F.lit(len(timed)))
    payload = F.struct("trade_time", "trade_id", *carry)
    ordering = F.struct("trade_time", "trade_id")
    tagged = (t.withColumn("_tag", tag).groupBy(key, "_tag")
              .agg(F.max_by(payload, ordering).alias("_p"), F.min_by(payload, ordering).alias("_f"),
                   F.first(start).alias("_start")))
    firsts = [n for n, o in offsets if o is None]
    n_timed = len(timed)
    # one window over a market's tags (a handful of rows): the next tag, and
    # the earliest print over all tags for the first-observed row
    w = Window.partitionBy(key).orderBy("_tag")
    g = tagged.select(key, "_tag", "_start", F.lead("_tag").over(w).alias("_next"),
                      F.col("_p.trade_time").alias("_obs"), *[F.col(f"_p.{c}").alias(f"_c_{c}") for c in carry],
                      *([F.min("_f").over(Window.partitionBy(key)).alias("_first")] if firsts else []))
    if firsts:
        g = g.select("*", F.col("_first.trade_time").alias("_fobs"),
                     *[F.col(f"_first.{c}").alias(f"_fc_{c}") for c in carry]).drop("_first")
    # (index, is_first): checkpoints this tag covers, then the market's
    # first observed print on its latest tag row
    cover = F.when(F.col("_tag") < n_timed,
                   F.sequence(F.col("_tag"), F.coalesce(F.col("_next") - 1, F.lit(n_timed - 1))))
    cells = F.transform(F.coalesce(cover, F.array().cast("array<int>")),
                        lambda i: F.struct(i.alias("_i"), F.lit(False).alias("_isf")))
    if firsts:
        cells = F.when(F.col("_next").isNull(),
                       F.concat(cells, F.array(F.struct(F.lit(-1).alias("_i"), F.lit(True).alias("_isf"))))
                       ).otherwise(cells)
    x = g.select("*", F.inline(cells))
    isf = F.col("_isf")
    name = F.when(isf, F.lit(firsts[0] if firsts else None))
    order_col = F.when(isf, F.lit(order_of[firsts[0]] if firsts else None))
    cp_time = F.when(isf, F.col("_fobs") if firsts else F.lit(None))
    for i, (n, o) in enumerate(timed):
        name = name.when(F.col("_i") == i, F.lit(n))
        order_col = order_col.when(F.col("_i") == i, F.lit(order_of[n]))
        cp_time = cp_time.when(F.col("_i") == i, F.col("_start") - F.expr(f"interval {o}"))
    pick = (lambda c: F.when(isf, F.col(f"_fc_{c}")).otherwise(F.col(f"_c_{c}"))) if firsts else \
        (lambda c: F.col(f"_c_{c}"))
    obs = F.when(isf, F.col("_fobs")).otherwise(F.col("_obs")) if firsts else F.col("_obs")
    return x.select(key, name.alias("checkpoint"), order_col.cast("int").alias("checkpoint_order"),
                    cp_time.alias("checkpoint_time"), obs.alias("observed_trade_time"),
                    *[pick(c).alias(c) for c in carry])


def _micros(c) -> Column:
    return elapsed_micros(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(c) if isinstance(c, str) else c)


def next_trade_lag(t: DataFrame, group: str = "game_id", side: str = "side",
                   time_col: str = "trade_time", slice_unit: str = SLICE) -> DataFrame:
    """As-of forward, strict.  For each print, minutes to the next strictly
    later print on the other side of the same game; unmatched prints dropped.

    Descending windows per (game, time slice): RANGE ... 1 PRECEDING on a
    microsecond key is 'strictly later', and UNBOUNDED PRECEDING keeps the
    frame incremental (an UNBOUNDED FOLLOWING frame would be quadratic).
    Prints with no match in their slice take the first opposite print of a
    later slice from a per-slice summary, so a hot game is not one task.
    """
    us = _micros(time_col)
    d = t.select(group, side, "trade_id", time_col, us.alias("_us"),
                 floor_to(time_col, slice_unit).alias("_slice"))
    # within a (game, slice): strictly later prints of each side
    w = (Window.partitionBy(group, "_slice").orderBy(F.col("_us").desc())
         .rangeBetween(Window.unboundedPreceding, -1))
    local0 = F.min(F.when(F.col(side) == 0, F.col("_us"))).over(w)
    local1 = F.min(F.when(F.col(side) == 1, F.col("_us"))).over(w)
    # across slices: first print of each side in any later slice of the game
    summ = d.groupBy(group, "_slice").agg(F.min(F.when(F.col(side) == 0, F.col("_us"))).alias("_f0"),
                                          F.min(F.when(F.col(side) == 1, F.col("_us"))).alias("_f1"))
    later = Window.partitionBy(group).orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select(group, "_slice", F.min("_f0").over(later).alias("_c0"), F.min("_f1").over(later).alias("_c1"))
    j = d.select("*", local0.alias("_l0"), local1.alias("_l1")).join(carry, [group, "_slice"], "left")
    other_next = F.when(F.col(side) == 0, F.coalesce("_l1", "_c1")).otherwise(F.coalesce("_l0", "_c0"))
    return (j.withColumn("_next", other_next)
            .filter(F.col("_next").isNotNull())
            .select(group, F.col(side).alias("from_side"), "trade_id", time_col,
                    (F.col("_next") - F.col("_us")).alias("lag_micros"),
                    ((F.col("_next") - F.col("_us")) / 6e7).alias("lag_minutes")))


def recent_trades(t: DataFrame, n: int = 1000, key: str = "market_id", slice_unit: str = SLICE, fan_in: int = 60) -> DataFrame:
    """The latest n prints per market (the API's one-page 'recent' mode).

    Prints are counted per (market, slice), reduced before the shuffle.  Running counts from a market's latest slice
    back tell the slice its n-th latest print lies in, and only that slice and later ones are read on.  What lies
    later is fewer than n prints; the border slice may hold any number, so its prints are ranked in ``fan_in`` parts
    first.  At most n x fan_in + n prints of a market meet in a task, and none of its older ones is shuffled
    where the borders are small enough to be broadcast.  Prints without a time are the earliest."""
    at = F.coalesce(floor_to("trade_time", slice_unit), F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))
    t = t.withColumn("_slice", at)
    back = Window.partitionBy(key).orderBy(F.col("_slice").desc())
    slices = t.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("_c"))
    borders = (slices.withColumn("_later", F.sum("_c").over(back) - F.col("_c")).where(F.col("_later") < n)
               .groupBy(F.col(key).alias("_k")).agg(F.min("_slice").alias("_border")))
    few = t.join(borders, (F.col(key) == F.col("_k")) & (F.col("_slice") >= F.col("_border")))
    latest = [F.col("trade_time").desc(), F.col("trade_id").desc()]
    part = F.when(F.col("_slice") == F.col("_border"), F.pmod(F.xxhash64("trade_id", "trade_time"), F.lit(fan_in))).otherwise(-1)
    parts = Window.partitionBy(key, "_part").orderBy(*latest)
    few = (few.withColumn("_part", part).withColumn("_rn", F.row_number().over(parts)).filter(F.col("_rn") <= n)
           .drop("_rn", "_part", "_slice", "_border", "_k"))
    return (few.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*latest)))
            .filter(F.col("_rn") <= n).drop("_rn"))


def row_shift(df: DataFrame, key, order, value: str, lags=range(-10, 11)) -> DataFrame:
    """Shifted copies of ``value`` by -10..10 rows, long form (lag, shifted)."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    lags = list(lags)
    wide = df.select("*", *[(F.lead(value, k).over(w) if k > 0 else
                             F.lag(value, -k).over(w) if k < 0 else F.col(value)).alias(f"_s{i}")
                            for i, k in enumerate(lags)])
    arr = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"_s{i}").alias("shifted"))
                    for i, k in enumerate(lags)])
    return wide.select(*df.columns, F.explode(arr).alias("_s")).select(
        *df.columns, F.col("_s.lag").alias("lag"), F.col("_s.shifted").alias("shifted"))
