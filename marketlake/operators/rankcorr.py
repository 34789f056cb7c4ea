"""Rank correlations.

Inputs are summaries (one row per market or game).  Ranks are computed in
long form with the distributed ``average_rank`` (counted by value and cell, ties
averaged by an aggregate), so no (metric, feature) pair or column is one
task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.stats import safe_corr
from marketlake.operators.quantiles import average_rank
from marketlake.session import materialize


def _finite(c):
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def rank_corr(df: DataFrame, metrics: list[str], features: list[str]) -> DataFrame:
    """Spearman per (metric, feature) over pairwise-complete rows:
    infinities -> NULL, drop rows missing either side, average ranks, then a
    guarded Pearson (NULL if n < 3 or a side is constant).  Pairs whose
    columns are absent are skipped.

    A column's ranks within a pair are its own ranks wherever the other side
    drops none of its rows; one aggregate (a count per column and per pair)
    tells where.  So every column is ranked once, and once more only for a
    partner with other gaps.  The rows are stored once, ranked in one
    distributed pass, and all pairs come from one aggregate."""
    ms = [m for m in metrics if m in df.columns]
    fs = [f for f in features if f in df.columns]
    pairs = [(m, f) for m in ms for f in fs]
    cols = list(dict.fromkeys([*ms, *fs]))
    d = materialize(df.select(*[_finite(F.col(c).cast("double")).alias(c) for c in cols])
                    .withColumn("_row", F.monotonically_increasing_id()))
    both = lambda m, f: F.col(m).isNotNull() & F.col(f).isNotNull()
    seen = d.agg(*[F.count(c).alias(c) for c in cols],
                 *[F.count_if(both(m, f)).alias(f"{m}|{f}") for m, f in pairs]).first()
    if not pairs:
        return df.sparkSession.createDataFrame([], "metric string, feature string, spearman_corr double, n long")
    # the ranking a column takes in a pair: its own, or among its partner's rows
    ranking = lambda c, other, n: c if seen[c] == n else f"{c}|within|{other}"
    used, wanted = {}, {}
    for m, f in pairs:
        n = seen[f"{m}|{f}"]
        used[m, f] = (ranking(m, f, n), ranking(f, m, n))
        wanted[used[m, f][0]], wanted[used[m, f][1]] = (m, f), (f, m)
    cells = [F.struct(F.lit(name).alias("k"), (F.col(c) if name == c else F.when(both(c, o), F.col(c))).alias("v"))
             for name, (c, o) in wanted.items()]
    ranked = average_rank(d.select("_row", F.inline(F.array(*cells))), ["k"], "v", "r", checkpoint=False)
    at = {name: f"r{i}" for i, name in enumerate(wanted)}
    wide = ranked.groupBy("_row").agg(*[F.max(F.when(F.col("k") == name, F.col("r"))).alias(a) for name, a in at.items()])
    corrs = [safe_corr(at[used[p][0]], at[used[p][1]]).alias(f"c{i}") for i, p in enumerate(pairs)]
    out = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(f).alias("feature"), F.col(f"c{i}").alias("spearman_corr"),
                             F.lit(seen[f"{m}|{f}"]).cast("long").alias("n")) for i, (m, f) in enumerate(pairs)])
    return wide.agg(*corrs).select(F.inline(out))


def rank_corr_matrix(df: DataFrame, cols: list[str], id_col: str) -> DataFrame:
    """Rank each column over its own non-NULL values, keep columns with
    at least 3 values and 2 distinct ones, then Pearson on every pair of
    kept columns over the rows where both are present (pandas
    ``rank().corr()``: no minimum beyond 2 rows).  Long output (a, b, corr).

    Ranks are computed in long form partitioned by column, pivoted back to
    one row per id, and all pairs are reduced in one global aggregate (no
    self-join, no pair rows)."""
    cs = [c for c in cols if c in df.columns]
    long = (df.select(id_col, *[_finite(F.col(c).cast("double")).alias(c) for c in cs])
              .unpivot(id_col, cs, "col", "v").filter(F.col("v").isNotNull()))
    ranked = average_rank(long, ["col"], "v", "r")
    wide = ranked.groupBy(id_col).pivot("col", cs).agg(F.first("r"))
    aggs = []
    for c in cs:
        aggs.append((F.count(c) >= 3) & (F.min(c) < F.max(c)))
    keep = {c: aggs[i] for i, c in enumerate(cs)}
    exprs = []
    for a in cs:
        for b in cs:
            exprs.append(F.when(keep[a] & keep[b], safe_corr(a, b, min_n=2)).alias(f"{a}||{b}"))
            exprs.append((keep[a] & keep[b]).alias(f"k:{a}||{b}"))
    one = wide.agg(*exprs)
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                               F.col(f"`{a}||{b}`").alias("corr"), F.col(f"`k:{a}||{b}`").alias("kept"))
                      for a in cs for b in cs])
    return one.select(F.explode(cells).alias("_c")).filter("_c.kept").select("_c.a", "_c.b", "_c.corr")
