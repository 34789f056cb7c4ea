"""Exact percentiles and ranks without holding a group in one task and without sorting its rows.

``percentile`` / ``median`` buffer every distinct value of a group in one aggregation buffer, and a rank window keeps
a group in one task; a very large group (a hot game, or "all markets" at one checkpoint) meets its limit in both.
Here a group is narrowed by a histogram: its values are counted (a hash aggregate, reduced before the shuffle, so a
value that a third of the rows share is a row per task), the counts are summed by cell, and running sums over a
group's cells tell how many values lie before each.  Cells are fixed slices of the number line, narrow in proportion
to the value, so a value's cell needs no look at its group.  Only within a cell are distinct values put in order: for
percentiles in the few cells that hold a wanted rank, for ranks in all of them, a cell at a time.  Nothing is sampled,
range-partitioned or numbered by place, so nothing needs a checkpoint for its numbers to hold; the counts' shuffle is
read by both steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.session import materialize

#: cells per factor e of magnitude, from a millionth up
CELLS = 20_000


def cell(v: Column) -> Column:
    """The slice of the number line a value lies in: a whole number that never falls as the value rises.  NaN lies
    above all."""
    d = v.cast("double")
    size = F.when(F.abs(d) > 1e300, F.lit(1 << 40)).otherwise(F.floor(F.log1p(F.abs(d) * 1e6) * CELLS))
    return F.when(F.isnan(d), F.lit(1 << 41)).when(d < 0, -size).otherwise(size).cast("long")


def value_counts(df: DataFrame, keys: list[str], value: str) -> tuple[DataFrame, DataFrame]:
    """(counts, cells): counts has (keys, value, _c, _cell) per distinct value; cells has (keys, _cell, _before: the
    group's rows in lower cells, _in: its rows in the cell, _n: all its rows)."""
    counts = (df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
              .withColumn("_cell", cell(F.col(value))))
    group = Window.partitionBy(*keys)
    cells = counts.groupBy(*keys, "_cell").agg(F.sum("_c").alias("_in"))
    return counts, cells.withColumn("_before", F.sum("_in").over(group.orderBy("_cell")) - F.col("_in")).withColumn("_n", F.sum("_in").over(group))


def _ordered(counts: DataFrame, cells: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The counts of the cells given, with ``_lower``: the group's rows below the value."""
    within = Window.partitionBy(*keys, "_cell").orderBy(value)
    return (counts.join(cells.select(*keys, "_cell", "_before", "_n"), [*keys, "_cell"])
            .withColumn("_lower", F.col("_before") + F.sum("_c").over(within) - F.col("_c")))


def average_rank(df: DataFrame, keys: list[str], value: str, out: str = "rank", checkpoint: bool = True) -> DataFrame:
    """1-based rank of ``value`` within ``keys`` with ties averaged (pandas ``rank(method='average')``), for rows
    where ``value`` is not NULL.

    A value's rank is what lies below it and half of its own count.  Rows take theirs in a join on (keys, value),
    whose skew AQE splits.  ``df`` is read for the counts and for the rows: it is checkpointed unless it is a stored
    table already (``checkpoint=False``)."""
    d = materialize(df) if checkpoint else df
    counts, cells = value_counts(d, keys, value)
    ranks = _ordered(counts, cells, keys, value).select(*keys, value, (F.col("_lower") + (F.col("_c") + 1) / 2.0).alias(out))
    return d.filter(F.col(value).isNotNull()).join(ranks, [*keys, value], "inner")


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """One row per group: ``count`` of non-NULL values and one column per entry of ``probs`` (name -> probability in
    [0, 1]), interpolated linearly between the two values its position lies between (the numpy / pandas / Spark
    ``percentile`` rule)."""
    counts, cells = value_counts(df.select(*keys, F.col(value).cast("double").alias("_v")), keys, "_v")
    # the 0-based ranks each probability needs: floor and ceil of (n - 1) * p
    at = {name: (F.col("_n") - 1) * F.lit(float(p)) for name, p in probs.items()}
    holds = lambda rank, lower, n: (lower <= rank) & (rank < lower + n)
    need = F.lit(False)
    for pos in at.values():
        need = need | holds(F.floor(pos), F.col("_before"), F.col("_in")) | holds(F.ceil(pos), F.col("_before"), F.col("_in"))
    few = _ordered(counts, cells.where(need), keys, "_v")
    aggs = [F.max("_n").alias("count")]
    for name, pos in at.items():
        lo, hi = (F.max(F.when(holds(rank, F.col("_lower"), F.col("_c")), F.col("_v"))) for rank in (F.floor(pos), F.ceil(pos)))
        frac = F.max(pos - F.floor(pos))
        aggs.append(F.when(frac == 0, lo).otherwise((1 - frac) * lo + frac * hi).alias(name))
    return few.groupBy(*keys).agg(*aggs)


def medians_wide(df: DataFrame, keys: list[str], cols: dict[str, object]) -> DataFrame:
    """Exact medians of several columns per group, one output column each
    (``cols``: output name -> column name or Column).  The columns are
    stacked into (metric, value) so one distributed pass serves all."""
    names = list(cols)
    stacked = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(n).alias("_metric"),
                 (F.col(c) if isinstance(c, str) else c).cast("double").alias("_val"))
        for n, c in cols.items()])).alias("_s")).select(*keys, "_s._metric", "_s._val")
    med = exact_percentiles(stacked, [*keys, "_metric"], "_val", {"_p50": 0.5})
    wide = med.groupBy(*keys).pivot("_metric", names).agg(F.first("_p50"))
    return wide
