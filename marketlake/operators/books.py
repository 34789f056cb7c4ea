"""Order-book operators.

A book is one JSON document per market.  It is parsed once with
``from_json`` and every statistic is computed with higher-order array
functions inside the row, so no levels are exploded or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOOK_SCHEMA = "struct<yes_dollars: array<array<string>>, no_dollars: array<array<string>>>"


def parse_books(b: DataFrame, col: str = "orderbook") -> DataFrame:
    """Adds ``yes`` and ``no`` ladders (array<array<string>>); a NULL or
    unparseable document gives NULL ladders.  A VARIANT document is read by
    path, JSON text is parsed."""
    if b.schema[col].dataType.simpleString() == "variant":
        ladder = lambda side: F.try_variant_get(F.col(col), f"$.{side}_dollars", "array<array<string>>")
        return b.select("*", ladder("yes").alias("yes"), ladder("no").alias("no"))
    parsed = F.from_json(F.col(col), BOOK_SCHEMA)
    return b.withColumn("_book", parsed).select(
        *[c for c in b.columns], F.col("_book.yes_dollars").alias("yes"), F.col("_book.no_dollars").alias("no"))


def _price(level: Column) -> Column:
    return F.try_element_at(level, F.lit(1)).cast("double")


def _size(level: Column) -> Column:
    return F.try_element_at(level, F.lit(2)).cast("double")


def _depth(side: Column) -> Column:
    with_size = F.filter(F.coalesce(side, F.array().cast("array<array<string>>")), lambda l: F.size(l) > 1)
    return F.aggregate(with_size, F.lit(0.0), lambda acc, l: acc + _size(l))


def _best(side: Column) -> Column:
    levels = F.filter(F.coalesce(side, F.array().cast("array<array<string>>")), lambda l: F.size(l) > 0)
    return F.array_max(F.transform(levels, _price))


def orderbook_depth(b: DataFrame, key: str = "market_id") -> DataFrame:
    """YES, NO and total resting depth and the best bid per side.
    A missing book gives NULLs; an empty side gives depth 0 and no best bid."""
    p = parse_books(b)
    present = F.col("orderbook").isNotNull() & (F.col("yes").isNotNull() | F.col("no").isNotNull())
    yes_d, no_d = _depth(F.col("yes")), _depth(F.col("no"))
    return p.select(
        key,
        F.when(present, yes_d).alias("orderbook_yes_depth_contracts"),
        F.when(present, no_d).alias("orderbook_no_depth_contracts"),
        F.when(present, yes_d + no_d).alias("orderbook_total_depth_contracts"),
        F.when(present, _best(F.col("yes"))).alias("best_yes_bid"),
        F.when(present, _best(F.col("no"))).alias("best_no_bid"))


def orderbook_implied_std(b: DataFrame, key: str = "market_id") -> DataFrame:
    """Size-weighted population std of YES-implied level prices
    (1 - p on the NO side; a level without a size weighs 1).  No levels ->
    NULL, one level -> 0; non-finite or non-positive total weight ->
    unweighted population std."""
    p = parse_books(b)
    empty = F.array().cast("array<array<string>>")

    def pts(side: Column, flip: bool) -> Column:
        lv = F.filter(F.coalesce(side, empty), lambda l: F.size(l) > 0)
        return F.transform(lv, lambda l: F.struct(
            (F.lit(1.0) - _price(l) if flip else _price(l)).alias("p"),
            F.coalesce(_size(l), F.lit(1.0)).alias("w")))

    arr = F.concat(pts(F.col("yes"), False), pts(F.col("no"), True))
    d = p.select(key, F.col("orderbook"), arr.alias("_x"))
    n = F.size("_x")
    sw = F.aggregate("_x", F.lit(0.0), lambda a, x: a + x["w"])
    swp = F.aggregate("_x", F.lit(0.0), lambda a, x: a + x["w"] * x["p"])
    sp = F.aggregate("_x", F.lit(0.0), lambda a, x: a + x["p"])
    d = d.select(key, "orderbook", "_x", n.alias("_n"), sw.alias("_sw"), swp.alias("_swp"), sp.alias("_sp"))
    wmean = F.try_divide(F.col("_swp"), F.col("_sw"))
    umean = F.try_divide(F.col("_sp"), F.col("_n"))
    d = d.withColumn("_wm", wmean).withColumn("_um", umean)
    wvar = F.try_divide(F.aggregate("_x", F.lit(0.0),
                                    lambda a, x: a + x["w"] * (x["p"] - F.col("_wm")) * (x["p"] - F.col("_wm"))),
                        F.col("_sw"))
    uvar = F.try_divide(F.aggregate("_x", F.lit(0.0), lambda a, x: a + (x["p"] - F.col("_um")) * (x["p"] - F.col("_um"))),
                        F.col("_n"))
    finite_w = F.forall("_x", lambda x: ~F.isnan(x["w"]) & (F.abs(x["w"]) != F.lit(float("inf"))))
    std = (F.when(F.col("orderbook").isNull() | (F.col("_n") == 0), F.lit(None).cast("double"))
           .when(F.col("_n") == 1, F.lit(0.0))
           .when(~finite_w | (F.col("_sw") <= 0), F.sqrt(uvar))
           .otherwise(F.sqrt(wvar)))
    return d.select(key, std.alias("orderbook_yes_implied_std"))


def orderbook_levels(b: DataFrame, key: str = "market_id") -> DataFrame:
    """Levels and total resting size per side."""
    p = parse_books(b)
    return p.select(
        key,
        F.coalesce(F.size("yes"), F.lit(0)).alias("yes_levels"),
        F.coalesce(F.size("no"), F.lit(0)).alias("no_levels"),
        _depth(F.col("yes")).alias("yes_resting_size"),
        _depth(F.col("no")).alias("no_resting_size"))


def nonempty_books(b: DataFrame, key: str = "market_id") -> DataFrame:
    """Books with at least one level and a key."""
    p = parse_books(b)
    n = F.coalesce(F.size("yes"), F.lit(0)) + F.coalesce(F.size("no"), F.lit(0))
    return p.filter(F.col(key).isNotNull() & (n > 0)).select(*b.columns)


def ladder_counts(b: DataFrame) -> DataFrame:
    """Level counts and flags used by the order-book fact."""
    p = parse_books(b)
    yc = F.coalesce(F.size("yes"), F.lit(0))
    nc = F.coalesce(F.size("no"), F.lit(0))
    return p.select(*b.columns, yc.alias("yes_level_count"), nc.alias("no_level_count"),
                    (yc > 0).alias("has_yes_orders"), (nc > 0).alias("has_no_orders"))
