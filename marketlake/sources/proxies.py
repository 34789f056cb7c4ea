"""Proxy views that give the generic test tables the shapes this package
works on (trade prints, markets, order-book levels, raw load rows and the
series -> events -> markets -> trades hierarchy).

Each view is a plain projection / aggregation of a scanned table, so
Catalyst prunes columns and pushes filters into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade prints T(trade_id, market_id, game_id, side, trade_time, price,
    size, game_start, series_ticker, taker_side) from ``events``.

    A market is a user; two neighbouring markets are the two contracts of one
    game; the game's start hour varies by game.
    """
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("trade_id"),
        F.col("user_id").alias("market_id"),
        F.expr("user_id div 2").alias("game_id"),
        F.expr("user_id % 2").alias("side"),
        F.col("ts").alias("trade_time"),
        F.expr("floor(value * 10000 / (value + 20)) / 10000").alias("price"),
        (F.get_json_object("props", "$.k").cast("int") + 1).alias("size"),
        F.expr("timestamp_ntz'2024-01-16 00:00:00' + "
               "make_dt_interval(0, cast((user_id div 2) % 24 as int))").alias("game_start"),
        F.concat(F.lit("SERIES-"), F.expr("cast((user_id div 2) % 3 as string)")).alias("series_ticker"),
        F.col("event_type").alias("taker_side"),
    )


def near_time(col: str = "trade_time"):
    """A time drawn sixty times closer to 2024-01-16 00:00: the month of
    prints becomes half a day, an hour a minute."""
    us = f"timestampdiff(MICROSECOND, timestamp_ntz'2000-01-01 00:00:00', {col})"
    anchor = "timestampdiff(MICROSECOND, timestamp_ntz'2000-01-01 00:00:00', timestamp_ntz'2024-01-16 00:00:00')"
    n = f"({anchor} + ({us} div 60) - ({anchor} div 60))"
    return F.expr(f"timestamp_ntz'2000-01-01 00:00:00' + make_dt_interval(0, 0, 0, "
                  f"cast(cast({n} as decimal(20,0)) / 1000000 as decimal(18,6)))")


def near_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``trades`` with times drawn together (``near_time``), for operators on
    one-minute grids; two thirds of the starts are not on a full minute."""
    t = trades(spark, sf_dir)
    start = F.expr("timestamp_ntz'2024-01-16 00:00:00' + make_dt_interval(0, 0, cast(game_id % 24 as int), "
                   "cast(game_id % 3 * 20 as decimal(18,6)))")
    return t.withColumn("trade_time", near_time()).withColumn("game_start", start)


def edge_trades(t: DataFrame) -> DataFrame:
    """Prints with the cases the labels and the completeness filter are for:
    some without a price, some exactly at the start."""
    return (t.withColumn("price", F.when(F.col("trade_id") % 53 != 0, F.col("price")))
             .withColumn("trade_time", F.when(F.col("trade_id") % 59 == 0, F.col("game_start"))
                         .otherwise(F.col("trade_time"))))


def market_context(t: DataFrame) -> DataFrame:
    """What the market table says beside the outcome: title, status, last
    price, volume, liquidity (some unknown) and the best quotes."""
    m = t.groupBy("market_id").agg(F.max_by("price", F.struct("trade_time", "trade_id")).alias("p"),
                                   F.sum("size").cast("double").alias("volume_fp"),
                                   F.round(F.sum(F.col("size") * F.col("price")), 4).alias("liq"))
    k = F.col("market_id")
    return m.select(
        "market_id", F.concat(F.lit("Market "), k.cast("string")).alias("market_title"),
        F.when(k % 4 == 0, F.lit("open")).otherwise(F.lit("settled")).alias("market_status"),
        F.col("p").alias("last_price_dollars"), "volume_fp",
        F.when(k % 11 != 0, F.col("liq")).alias("liquidity_dollars"),
        (F.col("p") - 0.01).alias("yes_bid_dollars"), (F.col("p") + 0.01).alias("yes_ask_dollars"),
        (k % 13 + 1).cast("double").alias("yes_bid_size_fp"), (k % 7 + 1).cast("double").alias("yes_ask_size_fp"))


def markets(spark: SparkSession, sf_dir: str, trades_df: DataFrame | None = None) -> DataFrame:
    """One row per market; a third of the games have no stated result, so
    their outcome must come from the winner map."""
    t = trades_df if trades_df is not None else trades(spark, sf_dir)
    return (t.groupBy("market_id")
            .agg(F.min("game_id").alias("game_id"), F.min("side").alias("side"),
                 F.min("game_start").alias("game_start"))
            .select("market_id", "game_id", "side", "game_start",
                    F.when(F.col("game_id") % 3 == 0, F.lit(None).cast("string"))
                     .when(F.col("side") == F.col("game_id") % 2, F.lit(" Yes"))
                     .otherwise(F.lit("no")).alias("market_result"),
                    (F.col("game_id") % 2).alias("winner_side")))


def winners(markets_df: DataFrame) -> DataFrame:
    """Winner map: game -> winning side (one row per game; every ninth game
    is missing, and its markets have no stated result either)."""
    return markets_df.filter(F.col("game_id") % 9 != 0).groupBy("game_id").agg(F.min("winner_side").alias("winner_side"))


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-book levels (market_id, side, price, size) from ``lineitem``."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("market_id"),
        F.when(F.col("l_linenumber") % 2 == 1, F.lit("yes")).otherwise(F.lit("no")).alias("side"),
        ((F.col("l_partkey") % 99 + 1) / F.lit(100.0)).alias("price"),
        F.col("l_quantity").alias("size"),
    )


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON text an order book arrives as: one document per market,
    ``{"yes_dollars": [[price, size], ..], "no_dollars": [..]}``.

    A ladder has one entry per price level, so resting size is first summed
    per (market, side, price): a document holds at most 99 levels a side
    however many orders rest, and the collect below is bounded."""
    lv = levels(spark, sf_dir).groupBy("market_id", "side", "price").agg(F.sum("size").alias("size"))
    pair = F.struct(F.col("price"), F.col("size"))
    as_text = lambda arr: F.transform(F.sort_array(arr, asc=False),
                                      lambda x: F.array(x["price"].cast("string"), x["size"].cast("string")))
    return (lv.groupBy("market_id")
            .agg(F.collect_list(F.when(F.col("side") == "yes", pair)).alias("yes"),
                 F.collect_list(F.when(F.col("side") == "no", pair)).alias("no"))
            .select("market_id", F.to_json(F.struct(as_text(F.col("yes")).alias("yes_dollars"),
                                                    as_text(F.col("no")).alias("no_dollars"))).alias("orderbook")))


def load_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw load-table rows to rank and merge, from ``events``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("ticker"),
        F.when(F.col("event_id") % 50 == 0, F.lit("bad"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("updated_time"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.date_trunc("HOUR", "ts").cast("timestamp_ntz")).alias("ingested_at"),
        F.concat("event_type", F.lit(".jsonl")).alias("source_file"),
        F.col("event_id").alias("source_row_number"),
        F.col("value"),
        F.col("ts").alias("event_time"),
    )


# hierarchy: series = nation, events = customer, markets = orders, trades = lineitem
def h_series(spark, sf_dir):
    return table(spark, sf_dir, "nation")


def h_events(spark, sf_dir):
    return table(spark, sf_dir, "customer")


def h_markets(spark, sf_dir):
    return table(spark, sf_dir, "orders")


def h_trades(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


# ---- raw (text-typed) current-state tables, for staging and facts ----

def _iso(col: str):
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def raw_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    return n.select(
        F.concat(F.lit("KXS"), k.cast("string")).alias("ticker"),
        F.when(F.col("n_regionkey") < 3, F.lit("Sports")).otherwise(F.lit("Economics")).alias("category"),
        F.when(k % 7 == 0, F.lit("Pro Baseball Spread")).when(k % 7 == 1, F.lit("Pro Baseball Hits"))
         .when(k % 7 == 2, F.lit("First 5 Innings Winner")).otherwise(F.col("n_name")).alias("title"),
        F.when(k % 3 == 0, F.array(F.lit("Baseball"), F.lit("Sports")))
         .when(k % 3 == 1, F.array(F.lit("BaseBall")))
         .otherwise(F.array(F.lit("Basketball"))).alias("tags"),
        F.lit("daily").alias("frequency"),
        F.col("n_regionkey").cast("decimal(38,0)").alias("fee_multiplier"),
        F.lit("quadratic").alias("fee_type"),
        F.concat(F.lit("2024-01-0"), (F.col("n_regionkey") + 1).cast("string"), F.lit("T00:00:00Z"))
         .alias("last_updated_ts"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        F.concat(F.lit("EVT-"), k.cast("string")).alias("event_ticker"),
        F.concat(F.lit("KXS"), F.col("c_nationkey").cast("string")).alias("series_ticker"),
        F.col("c_mktsegment").alias("category"),
        F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("sub_title"),
        (F.col("c_acctbal") > 0).alias("available_on_brokers"),
        (F.col("c_nationkey") % 2 == 0).alias("mutually_exclusive"),
        F.lit("binary").alias("collateral_return_type"),
        F.when(k % 10 == 0, F.lit("bad"))
         .otherwise(_iso(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
                         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), k.cast("decimal(18,6)"))))
         .alias("last_updated_ts"),
        F.lit(None).cast("string").alias("product_metadata"))


def raw_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.concat(F.lit("MKT-"), k.cast("string")).alias("ticker"),
        F.concat(F.lit("EVT-"), F.col("o_custkey").cast("string")).alias("event_ticker"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderstatus") == "F", F.lit("yes")).when(F.col("o_orderstatus") == "P", F.lit("no"))
         .otherwise(F.lit("")).alias("result"),
        F.col("o_orderpriority").alias("yes_sub_title"),
        F.when(k % 3 == 0, F.col("o_orderpriority")).otherwise(F.lit("other")).alias("no_sub_title"),
        _iso("o_orderdate").alias("close_time"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("liquidity_dollars"),
        F.col("o_custkey").cast("string").alias("volume_fp"),
        (k % 2 == 0).alias("can_close_early"))


def raw_markets_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markets with every column of the load contract and its kinds of values
    (``MARKET_LOAD``), by one rule per kind; every column is NULL in some rows,
    and some numbers are no numbers."""
    from marketlake.schemas import MARKET_LOAD

    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    base = {"ticker": F.concat(F.lit("MKT-"), k.cast("string")),
            "event_ticker": F.concat(F.lit("EVT-"), F.col("o_custkey").cast("string")),
            "title": F.col("o_orderpriority")}
    cols = []
    for i, (name, kind) in enumerate(MARKET_LOAD):
        text = F.concat(F.lit(f"{name}-"), (k % 97).cast("string"))
        value = {"string": text, "boolean": (k + i) % 2 == 0, "time": _iso("o_orderdate"),
                 "price": ((k + i) % 100 / 100).cast("decimal(18,4)").cast("string"),
                 "size": ((k + i) % 1000).cast("string"),
                 "number": F.when(k % 4 == 0, F.lit("n/a")).otherwise((k % 3600).cast("string")),
                 "object": F.struct((k % 50).alias("floor")),
                 "array": F.array(F.struct((k % 5).cast("string").alias("start"))),
                 "timestamp": F.col("o_orderdate").cast("timestamp_ntz")}[kind]
        cols.append((base[name] if name in base else F.when((k + i) % 5 != 0, value)).alias(name))
    return o.select(*cols)


def load_entity(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Raw load rows of events (customers), order books (suppliers) or series
    (parts): several rows per key, unknown ingest times, equal ingest times
    with different load times."""
    name, n, key, value, groups = {
        "events": ("customer", "c_custkey", "event_ticker", "c_name", 40),
        "orderbooks": ("supplier", "s_suppkey", "market_ticker", "s_name", 7),
        "series": ("part", "p_partkey", "ticker", "p_name", 60)}[entity]
    k = F.col(n)
    hours = lambda e: F.make_dt_interval(F.lit(0), e.cast("int"))
    return table(spark, sf_dir, name).select(
        F.concat(F.lit("K-"), (k % groups).cast("string")).alias(key), F.col(value).alias("title"),
        F.when(k % 7 != 0, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + hours(k % 3)).alias("ingested_at"),
        (F.lit("2024-02-01 00:00:00").cast("timestamp_ntz") + hours(k % 2)).alias("loaded_at"),
        F.concat(F.lit("f"), (k % 4).cast("string"), F.lit(".jsonl")).alias("source_file"), k.cast("bigint").alias("source_row_number"))


def raw_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trades(spark, sf_dir)
    return t.select(
        F.col("trade_id").cast("string").alias("trade_id"),
        F.col("market_id").cast("string").alias("ticker"),
        F.when(F.col("trade_id") % 97 == 0, F.lit("n/a")).otherwise(F.col("size").cast("string")).alias("count_fp"),
        F.col("taker_side"),
        # now and then the two prices miss 1 by two cents
        (1 - F.col("price") + F.when(F.col("trade_id") % 101 == 0, F.lit(0.02)).otherwise(F.lit(0.0)))
        .cast("decimal(18,4)").cast("string").alias("no_price_dollars"),
        F.col("price").cast("decimal(18,4)").cast("string").alias("yes_price_dollars"),
        _iso("trade_time").alias("created_time"))


def raw_orderbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = books(spark, sf_dir)
    return b.select(F.concat(F.lit("MKT-"), F.col("market_id").cast("string")).alias("market_ticker"), "orderbook")


def game_tickers(spark: SparkSession, sf_dir: str, trades_df: DataFrame | None = None) -> DataFrame:
    """One event ticker per game in the exchange's shape:
    SERIES-yyMMMddHHmm(Eastern start)TEAMS, plus one market ticker per side."""
    t = trades_df if trades_df is not None else trades(spark, sf_dir)
    g = t.groupBy("game_id", "side").agg(F.min("game_start").alias("game_start"))
    local = F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), F.col("game_start"))
    ev = F.concat(F.lit("KXGAME-"), F.upper(F.date_format(local, "yyMMMddHHmm")),
                  F.lit("H"), F.col("game_id").cast("string"), F.lit("A"), F.col("game_id").cast("string"))
    return g.select("game_id", "side", "game_start", ev.alias("event_ticker"),
                    F.concat(ev, F.lit("-S"), F.col("side").cast("string")).alias("market_ticker"))


def team_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team payload snapshots: one team per nation, one snapshot per supplier
    of that nation (an append-only history), as the nested JSON the teams
    API returns."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    payload = F.to_json(F.struct(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
        F.lower(F.substring("n_name", 1, 3)).alias("teamCode"), F.upper(F.substring("n_name", 1, 3)).alias("abbreviation"),
        F.col("n_name").alias("teamName"), F.col("r_name").alias("locationName"),
        F.lit("1884").alias("firstYearOfPlay"),
        F.struct(F.lit(1).alias("id"), F.lit("Major League Baseball").alias("name")).alias("sport"),
        F.struct(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")).alias("league"),
        F.struct((F.col("n_regionkey") * 100 + F.col("n_nationkey")).alias("id"),
                 F.concat(F.col("r_name"), F.lit(" "), F.col("n_name")).alias("name")).alias("division"),
        F.struct(F.col("s_suppkey").alias("id"), F.concat(F.lit("Park "), F.col("s_suppkey").cast("string"))
                 .alias("name")).alias("venue"),
        (F.col("s_suppkey") % 2 == 0).alias("active")))
    ing = F.when(F.col("s_suppkey") % 9 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        + F.make_dt_interval(F.lit(0), (F.col("s_suppkey") % 48).cast("int")))
    return j.select(payload.alias("payload"), ing.alias("ingested_at"),
                    F.concat(F.lit("teams_"), (F.col("s_suppkey") % 4).cast("string"), F.lit(".jsonl")).alias("source_file"),
                    F.col("s_suppkey").alias("source_row_number"),
                    (F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
                     + F.make_dt_interval(F.lit(0), (F.col("s_suppkey") % 5).cast("int"))).alias("loaded_at"))
