"""Registered queries: JSONL landing and scanning, table writes, schema
inference, incremental state and streaming (S1-S16, P23-P26, T1-T11, J13, A34).

These write to fresh folders under the session's shared checkpoint folder
(``spark.checkpoint.dir``) and read the result back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators import incremental as I
from marketlake.operators import marts as M
from marketlake.operators import schema_ops as SO
from marketlake.operators import staging as ST
from marketlake.operators.books import BOOK_SCHEMA
from marketlake.operators.paths import recent_trades
from marketlake.plans import common as C
from marketlake.plans.registry import register
from marketlake.plans.staging_queries import FCT_MARKETS_FULL, FCT_ORDERBOOKS_SQL, STG_EVENTS_SQL, STG_SERIES_SQL, STG_TRADES_SQL, some_events
from marketlake.plans.state_queries import MARKETS_ORDER_SQL, latest_sql
from marketlake.plans.views import with_views
from marketlake.schemas import MARKET_SPEC, order_for
from marketlake.session import BASE_CONF, materialize, shared_dir
from marketlake.sources import jsonl as J
from marketlake.sources import proxies as P
from marketlake.sources import tables as TB
from marketlake.streaming import ingest as SI

UTC = dt.timezone.utc
RUN1 = dt.datetime(2024, 1, 16, tzinfo=UTC)
RUN2 = dt.datetime(2024, 1, 31, tzinfo=UTC)
E1, E2 = int(RUN1.timestamp()), int(RUN2.timestamp())
CUT = "2024-01-16T00:00:00Z"
COMPILED = "spark.sql.codegen.hugeMethodLimit"

TRADE_SPEC = [("$.trade_id", "trade_id", "string"), ("$.ticker", "ticker", "string"),
              ("$.count_fp", "count_fp", "string"), ("$.taker_side", "taker_side", "string"),
              ("$.no_price_dollars", "no_price_dollars", "string"),
              ("$.yes_price_dollars", "yes_price_dollars", "string"), ("$.created_time", "created_time", "string")]
RAW_TRADE_COLS = [c for _, c, _ in TRADE_SPEC]


def _land_two_runs(spark, df, name, time_col=None):
    """Land ``df`` as two runs (split by ``time_col`` at the cut) plus one
    non-JSON line; returns the landing prefix."""
    root = shared_dir(spark, name)
    if time_col is None:
        J.land(df, root, name, RUN1, compression="gzip")
    else:
        J.land(df.filter(F.col(time_col) < CUT), root, name, RUN1, compression="gzip")
        J.land(df.filter(F.col(time_col) >= CUT), root, name, RUN2, compression="gzip")
    spark.range(1).select(F.lit("not json {").alias("value")).write.mode("append").text(
        J.landing_path(root, "exchange", name, RUN2))
    return root


@register("scan_trades_jsonl", with_views(f"select {', '.join(RAW_TRADE_COLS)} from raw_trades", "raw_trades"))
def q_scan_trades_jsonl(spark, d):
    """S1 + S6: land raw trades as JSONL in two runs, scan them back typed."""
    root = _land_two_runs(spark, P.raw_trades(spark, d), "trades", "created_time")
    good, _bad = J.scan_jsonl(spark, root, TRADE_SPEC)
    return good.select(*RAW_TRADE_COLS)


@register("scan_bad_lines", with_views("select 1 bad_lines, count(*) good_lines from raw_trades", "raw_trades"))
def q_scan_bad_lines(spark, d):
    """Bad lines come back as their own frame, good lines are all kept."""
    root = _land_two_runs(spark, P.raw_trades(spark, d), "trades_bad")
    good, bad = J.scan_jsonl(spark, root, TRADE_SPEC)
    both = bad.select(F.lit(True).alias("b")).unionAll(good.select(F.lit(False)))
    return both.agg(F.count_if("b").alias("bad_lines"), F.count_if(~F.col("b")).alias("good_lines"))


@register("load_audit_columns", with_views("select count(*) rows, true numbered_from_one from raw_trades",
                                           "raw_trades"))
def q_load_audit_columns(spark, d):
    """Per-file row numbers run 1..n in every landed file."""
    root = _land_two_runs(spark, P.raw_trades(spark, d), "trades_audit", "created_time")
    good, _ = J.scan_jsonl(spark, root, TRADE_SPEC)
    per_file = good.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"),
                                               F.sum("source_row_number").alias("s"),
                                               F.countDistinct("source_row_number").alias("k"))
    ok = (F.col("s") == F.col("n") * (F.col("n") + 1) / 2) & (F.col("k") == F.col("n"))
    return per_file.agg(F.sum("n").alias("rows"), F.bool_and(ok).alias("numbered_from_one"))


@register("scan_markets_jsonl", with_views(
    "select * replace (try_cast(settlement_timer_seconds as decimal(38,0)) as settlement_timer_seconds) from raw_markets_full",
    "raw_markets_full"))
def q_scan_markets_jsonl(spark, d):
    """The whole load contract; numbers that are none are NULL, nested values stay JSON."""
    root = _land_two_runs(spark, P.raw_markets_full(spark, d), "markets")
    return J.scan_jsonl(spark, root, MARKET_SPEC)[0].select(*[c for _, c, _ in MARKET_SPEC])


SERIES_SPEC = [("$.ticker", "ticker", "string"), ("$.category", "category", "string"),
               ("$.title", "title", "string"), ("$.tags", "tags", "array<string>"),
               ("$.frequency", "frequency", "string"), ("$.fee_multiplier", "fee_multiplier", "decimal(38,0)"),
               ("$.fee_type", "fee_type", "string"), ("$.last_updated_ts", "last_updated_ts", "string")]


@register("scan_series_jsonl", with_views("select * from raw_series", "raw_series"))
def q_scan_series_jsonl(spark, d):
    """S8 (tags as an array, fee multiplier as a number)."""
    root = _land_two_runs(spark, P.raw_series(spark, d), "series")
    return J.scan_jsonl(spark, root, SERIES_SPEC)[0].select(*[c for _, c, _ in SERIES_SPEC])


EVENT_SPEC = [("$.event_ticker", "event_ticker", "string"), ("$.series_ticker", "series_ticker", "string"),
              ("$.category", "category", "string"), ("$.title", "title", "string"),
              ("$.sub_title", "sub_title", "string"), ("$.available_on_brokers", "available_on_brokers", "boolean"),
              ("$.mutually_exclusive", "mutually_exclusive", "boolean"),
              ("$.collateral_return_type", "collateral_return_type", "string"),
              ("$.last_updated_ts", "last_updated_ts", "string"),
              ("$.product_metadata", "product_metadata", "string")]


@register("scan_events_jsonl", with_views("select * from raw_events", "raw_events"))
def q_scan_events_jsonl(spark, d):
    """S7."""
    root = _land_two_runs(spark, P.raw_events(spark, d), "events")
    return J.scan_jsonl(spark, root, EVENT_SPEC)[0].select(*[c for _, c, _ in EVENT_SPEC])


@register("scan_orderbooks_jsonl", with_views("select market_id, orderbook from book_text", "book_text"))
def q_scan_orderbooks_jsonl(spark, d):
    """The ladders land as a nested object and come back as its JSON text."""
    nested = P.books(spark, d).withColumn("orderbook", F.from_json("orderbook", BOOK_SCHEMA))
    root = _land_two_runs(spark, nested, "orderbooks")
    good, _ = J.scan_jsonl(spark, root, [("$.market_id", "market_id", "bigint"), ("$.orderbook", "orderbook", "json")])
    # a VARIANT orders an object's keys by name; the text is compared in the order it was written in
    parts = F.from_json("orderbook", BOOK_SCHEMA)
    return good.select("market_id", F.to_json(parts).alias("orderbook"))


@register("landing_envelope", with_views(
    "select trade_id, market_id, timestamp '2024-01-16 00:00:00' ingested_at, trade_id payload_trade_id, "
    "price payload_price from trades", "trades"), doubles=("payload_price",))
def q_landing_envelope(spark, d):
    """Envelope then read the payload back."""
    t = C.trades(spark, d).select("trade_id", "market_id", "price")
    e = J.envelope(t, RUN1.replace(microsecond=123456))
    return e.select("trade_id", "market_id", "ingested_at",
                    F.get_json_object("raw_payload", "$.trade_id").cast("bigint").alias("payload_trade_id"),
                    F.get_json_object("raw_payload", "$.price").cast("double").alias("payload_price"))


@register("event_partition_cache", with_views(
    "select game_id, trade_id, market_id, trade_time, price from labelled", "labelled"), doubles=("price",))
def q_event_partition_cache(spark, d):
    """Write labelled prints partitioned by game, read all back."""
    path = shared_dir(spark, "cache") + "/trades"
    TB.cache_write(C.labelled(spark, d).select("game_id", "trade_id", "market_id", "trade_time", "price"),
                   path, "game_id")
    return TB.cache_read(spark, path, "game_id").select("game_id", "trade_id", "market_id", "trade_time", "price")


@register("cache_missing_entities", with_views("""
select g.game_id, e.entity from (select distinct game_id from trades) g
cross join (select unnest(['markets', 'orderbooks', 'trades']) entity) e
where not (e.entity = 'orderbooks' and g.game_id in (select distinct market_id // 2 from levels))
  and e.entity = 'orderbooks'""", "trades", "levels"))
def q_cache_missing_entities(spark, d):
    """(game, entity) pairs without a cached partition; order books are
    cached only for games that have one."""
    root = shared_dir(spark, "cache2")
    t = C.trades(spark, d)
    TB.cache_write(t.select("game_id", "trade_id"), f"{root}/trades", "game_id")
    TB.cache_write(P.markets(spark, d, t).select("game_id", "market_id"), f"{root}/markets", "game_id")
    TB.cache_write(P.books(spark, d).withColumn("game_id", F.expr("market_id div 2")), f"{root}/orderbooks", "game_id")
    entities = ("markets", "orderbooks", "trades")
    # every game expects one partition per entity: a generator, not a join
    expected = t.select("game_id").distinct().select(
        "game_id", F.explode(F.array(*[F.lit(e) for e in entities])).alias("entity"))
    present = None
    for e in entities:
        p = TB.cache_read(spark, f"{root}/{e}", "game_id").select("game_id", F.lit(e).alias("entity"))
        present = p if present is None else present.unionByName(p)
    return TB.cache_missing(expected, present, ["game_id", "entity"])


KEYED_SQL = with_views("""
select *, cast(null as varchar) note from m12 where ticker not in (select ticker from src3)
union all select *, 'late ' || ticker note from src3""", "load", extra={
    "b1": "select * from load where event_time < timestamp '2024-01-16 00:00:00'",
    "b2": "select * from load where event_time >= timestamp '2024-01-16 00:00:00'",
    "b3": "select * from load where source_row_number % 40 = 0",
    "tgt": latest_sql("b1", MARKETS_ORDER_SQL), "src": latest_sql("b2", MARKETS_ORDER_SQL),
    "m12": "select * from tgt where ticker not in (select ticker from src) union all select * from src",
    "src3": latest_sql("b3", MARKETS_ORDER_SQL)})


@register("keyed_load", KEYED_SQL, doubles=("value",))
def q_keyed_load(spark, d):
    """S13 / U2 on storage: two batches upserted into a bucketed table, the
    second one replayed (which changes nothing), then a third that brings a
    new column."""
    name = TB.fresh_name("keyed")
    ld = P.load_rows(spark, d)
    order = order_for("markets", ld.columns)
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    b1, b2 = ld.filter(F.col("event_time") < cut), ld.filter(F.col("event_time") >= cut)
    b3 = ld.filter(F.col("source_row_number") % 40 == 0).withColumn("note", F.concat(F.lit("late "), "ticker"))
    for token, batch in (("b1", b1), ("b2", b2), ("b2", b2), ("b3", b3)):
        TB.keyed_load(spark, batch, name, ["ticker"], order, token, buckets=16)
    return TB.current(spark, name).select(*ld.columns, "note")


DELTA_PARTS = {"first": "select trade_id, market_id, trade_time, price, 1 as version from trades where trade_time < timestamp '2024-01-16 00:00:00'",
               "second": "select trade_id, market_id, trade_time, price + 1, 2 from trades "
                         "where trade_time >= timestamp '2024-01-16 00:00:00' or trade_id % 3 = 0",
               "third": "select trade_id, market_id, trade_time, price + 2, 3 from trades where trade_id % 10 = 0 "
                        "and trade_time >= timestamp '2024-01-20 00:00:00' and trade_time < timestamp '2024-01-22 00:00:00'"}


@register("latest_trades_delta", with_views("""
select trade_id, market_id, trade_time, price, version from (
  select *, row_number() over (partition by trade_id order by version desc) rn
  from (select * from first union all select * from second union all select * from third) v) x where rn = 1""",
    "trades", extra=DELTA_PARTS), doubles=("price",))
def q_latest_trades_delta(spark, d):
    """W3c / U1 for prints by id: three batches appended to the folders of their days, the days with several files
    compacted between the second and the third, the latest version of every print resolved on read."""
    t = C.trades(spark, d).select("trade_id", "market_id", "trade_time", "price")
    at, cut = F.col("trade_time"), F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    lo, hi = (F.lit(f"2024-01-{x} 00:00:00").cast("timestamp_ntz") for x in (20, 22))
    batches = [t.filter(at < cut), t.filter((at >= cut) | (F.col("trade_id") % 3 == 0)),
               t.filter((F.col("trade_id") % 10 == 0) & (at >= lo) & (at < hi))]
    name, order = TB.fresh_name("prints"), [("version", "desc_nulls_last")]
    for i, batch in enumerate(batches):
        rows = batch.withColumn("price", F.col("price") + i).withColumn("version", F.lit(i + 1))
        TB.append_delta(spark, rows, name, ["trade_id"], "trade_time")
        if i == 1:
            TB.compact_delta(spark, name, order)
    return TB.resolve_delta(spark, name, order)


@register("keyless_dump", with_views(
    "select event_time, ingested_at, source_file, source_row_number, ticker, updated_time, value from load", "load"),
    doubles=("value",))
def q_keyless_dump(spark, d):
    """Two appends to an unkeyed table, columns sorted by name."""
    path = shared_dir(spark, "dump")
    ld = P.load_rows(spark, d)
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    TB.keyless_dump(ld.filter(F.col("event_time") < cut), path)
    TB.keyless_dump(ld.filter(F.col("event_time") >= cut).select(*reversed(ld.columns)), path)
    return spark.read.parquet(path)


@register("flatten_records", with_views("select trade_id, market_id, price from trades", "trades"),
          doubles=("price",))
def q_flatten_records(spark, d):
    """Pages of at most 1,000 prints arrive as one JSON array each
    (plus a non-object item); flatten back to one row per print."""
    t = C.trades(spark, d)
    pages = (t.groupBy(F.expr("trade_id div 1000").alias("page"), "market_id")
             .agg(F.to_json(F.collect_list(F.struct("trade_id", "market_id", "price"))).alias("doc"))
             .select(F.concat(F.lit("["), F.expr("substr(doc, 2, length(doc) - 2)"), F.lit(", 7]")).alias("doc")))
    recs = J.flatten_records(pages, "doc")
    return recs.select(F.try_variant_get("record", "$.trade_id", "bigint").alias("trade_id"),
                       F.try_variant_get("record", "$.market_id", "bigint").alias("market_id"),
                       F.try_variant_get("record", "$.price", "double").alias("price"))


@register("table_columns", with_views("""
select c.column_name, c.data_type, c.column_name = 'ticker' is_key,
       case c.column_name when 'ticker' then n.ticker when 'updated_time' then n.updated_time when 'ingested_at' then n.ingested_at
            when 'source_file' then n.source_file when 'source_row_number' then n.source_row_number when 'value' then n.value else n.event_time end filled_rows
from (values ('ticker', 'string'), ('updated_time', 'string'), ('ingested_at', 'timestamp_ntz'), ('source_file', 'string'),
             ('source_row_number', 'bigint'), ('value', 'double'), ('event_time', 'timestamp_ntz')) c(column_name, data_type)
join (select count(ticker) ticker, count(updated_time) updated_time, count(ingested_at) ingested_at, count(source_file) source_file,
             count(source_row_number) source_row_number, count(value) "value", count(event_time) event_time
      from (select *, row_number() over (partition by ticker order by source_row_number desc) rn from load) x where rn = 1) n on true""", "load"))
def q_table_columns(spark, d):
    """Columns, types, keys and filled rows of a stored keyed table."""
    name = TB.fresh_name("cols")
    ld = P.load_rows(spark, d)
    TB.keyed_load(spark, ld, name, ["ticker"], [("source_row_number", "desc_nulls_last"), *order_for("markets", ld.columns)], "all", buckets=4)
    return TB.table_columns(spark, name)


@register("schema_tables", with_views("""
select t table_name, c column_name, ty data_type, c = k is_key from (
  select 'markets' t, 'ticker' k, unnest(['ticker', 'updated_time', 'ingested_at', 'source_file', 'source_row_number', 'value', 'event_time']) c,
         unnest(['string', 'string', 'timestamp_ntz', 'string', 'bigint', 'double', 'timestamp_ntz']) ty
  union all select 'prints', 'trade_id', unnest(['trade_id', 'market_id', 'trade_time', 'price']), unnest(['bigint', 'bigint', 'timestamp_ntz', 'double'])) x
where (select count(*) from load) > 0""", "load"))
def q_schema_tables(spark, d):
    """S16 over a schema: the tables that loads have made in it, and their columns."""
    schema = TB.fresh_name("lake")
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{shared_dir(spark, schema)}'")
    ld = P.load_rows(spark, d)
    TB.keyed_load(spark, ld, f"{schema}.markets", ["ticker"], order_for("markets", ld.columns), "all", buckets=4)
    TB.append_delta(spark, C.trades(spark, d).select("trade_id", "market_id", "trade_time", "price"), f"{schema}.prints", ["trade_id"], "trade_time")
    return TB.schema_tables(spark, schema)


def _docs(spark, d):
    t = C.trades(spark, d)
    mixed = F.when(F.col("trade_id") % 3 == 0, F.concat(F.lit('"'), F.col("taker_side"), F.lit('"'))) \
             .otherwise(F.col("size").cast("string"))
    big = (F.col("trade_id") * 1000000).cast("string")
    return t.select(F.concat(
        F.lit('{"trade_id":'), F.col("trade_id").cast("string"),
        F.lit(',"size":'), F.col("size").cast("string"),
        F.lit(',"price":'), F.col("price").cast("decimal(18,4)").cast("string"),
        F.lit(',"taker_side":"'), F.col("taker_side"), F.lit('"'),
        F.lit(',"mixed":'), mixed,
        F.lit(',"big":'), big,
        F.lit(',"num":'), F.when(F.col("trade_id") % 2 == 0, F.col("size").cast("string"))
                           .otherwise(F.col("price").cast("decimal(18,4)").cast("string")),
        F.lit(',"flag":'), F.when(F.col("side") == 0, F.lit("true")).otherwise(F.lit("false")),
        F.lit(',"nested":{"k":1},"empty":null}')).alias("doc"))


@register("infer_column_types", with_views("""
select column_name, case
  when count(kind) = 0 then 'VARCHAR'
  when count(distinct kind) = 1 and min(kind) = 'int' and min(iv) >= -32768 and max(iv) <= 32767 then 'SMALLINT'
  when count(distinct kind) = 1 and min(kind) = 'int' and min(iv) >= -2147483648 and max(iv) <= 2147483647 then 'INTEGER'
  when count(distinct kind) = 1 and min(kind) = 'int' then 'BIGINT'
  when count(distinct kind) = 1 and min(kind) = 'float' then 'FLOAT'
  when count(distinct kind) = 1 and min(kind) = 'str' then 'VARCHAR'
  when count(distinct kind) = 1 and min(kind) = 'bool' then 'BOOLEAN'
  when count(distinct kind) = 1 and min(kind) in ('dict', 'list') then 'VARIANT'
  when bool_and(kind in ('int', 'float')) then 'FLOAT'
  else 'VARCHAR' end data_type
from (select k column_name,
             case json_type(doc, '$.' || k) when 'BIGINT' then 'int' when 'UBIGINT' then 'int'
                  when 'DOUBLE' then 'float' when 'VARCHAR' then 'str' when 'BOOLEAN' then 'bool'
                  when 'OBJECT' then 'dict' when 'ARRAY' then 'list' end kind,
             case when json_type(doc, '$.' || k) in ('BIGINT', 'UBIGINT')
                  then cast(json_extract_string(doc, '$.' || k) as hugeint) end iv
      from (select doc, unnest(json_keys(doc)) k from docs) x) y
group by column_name""", "trades", extra={"docs": """
select '{"trade_id":' || trade_id || ',"size":' || size || ',"price":' || cast(cast(price as decimal(18,4)) as varchar)
  || ',"taker_side":"' || taker_side || '"' || ',"mixed":'
  || case when trade_id % 3 = 0 then '"' || taker_side || '"' else cast(size as varchar) end
  || ',"big":' || cast(trade_id * 1000000 as varchar)
  || ',"num":' || case when trade_id % 2 = 0 then cast(size as varchar) else cast(cast(price as decimal(18,4)) as varchar) end
  || ',"flag":' || case when side = 0 then 'true' else 'false' end
  || ',"nested":{"k":1},"empty":null}' doc from trades"""}))
def q_infer_column_types(spark, d):
    """P23 over JSON objects built from the prints (mixed kinds per key)."""
    return SO.infer_column_types(_docs(spark, d), "doc")


# the same text in both dialects: one key per arm of the type lattice
_DAY = "'2024-01-' || lpad(cast(1 + trade_id % 28 as string), 2, '0')"
_CLOCK = "lpad(cast(trade_id % 24 as string), 2, '0') || ':' || lpad(cast(trade_id % 60 as string), 2, '0') || ':07'"
_SMALL, _PRICE = "cast(trade_id % 1000 as string)", "cast(cast(price as decimal(18, 4)) as string)"
_ONE_OF = lambda a, b: f"case when trade_id % 5 = 0 then {a} else {b} end"
_TEXT = lambda x: f"'\"' || {x} || '\"'"
_UUID = "'00000000-0000-4000-8000-' || lpad(cast(trade_id as string), 12, '0')"
ARMS = {"small": _SMALL, "int32": "cast(trade_id + 100000 as string)", "int64": "cast(trade_id + 3000000000 as string)",
        "below": "'-' || cast(trade_id + 40000 as string)", "huge": "'1' || lpad(cast(trade_id as string), 20, '0')",
        "fraction": _PRICE, "number": _ONE_OF(_SMALL, _PRICE), "text": _TEXT("'n' || " + _SMALL), "text_or_number": _ONE_OF(_TEXT("'x'"), _PRICE),
        "flag": "case when trade_id % 2 = 0 then 'true' else 'false' end", "flag_or_int": _ONE_OF("'true'", _SMALL),
        "object": "'{\"a\":' || " + _SMALL + " || '}'", "list": "'[' || " + _SMALL + " || ']'", "object_or_list": _ONE_OF("'{}'", "'[]'"),
        "nothing": "'null'", "day": _TEXT(_DAY), "day_or_text": _ONE_OF(_TEXT("'soon'"), _TEXT(_DAY)), "day_or_null": _ONE_OF("'null'", _TEXT(_DAY)),
        "no_day": _TEXT("'2024-02-3' || cast(trade_id % 10 as string)"), "clock": _TEXT(_CLOCK), "clock_or_text": _ONE_OF(_TEXT("'noon'"), _TEXT(_CLOCK)),
        "instant": _TEXT(_DAY + " || 'T' || " + _CLOCK + " || 'Z'"), "instant_or_text": _ONE_OF(_TEXT("'now'"), _TEXT(_DAY + " || ' ' || " + _CLOCK)),
        "instant_or_day": _ONE_OF(_TEXT(_DAY), _TEXT(_DAY + " || 'T' || " + _CLOCK)), "day_or_int": _ONE_OF(_SMALL, _TEXT(_DAY)), "id": _TEXT(_UUID)}
ARMS_DOC = "'{' || " + " || ',' || ".join(f"'\"{k}\":' || {v}" for k, v in ARMS.items()) + " || '}'"


@register("infer_column_types_lattice", with_views(r"""
select column_name, case
  when count(kind) = 0 then 'VARCHAR'
  when bool_and(kind = 'int') then case when min(iv) >= -32768 and max(iv) <= 32767 then 'SMALLINT'
                                        when min(iv) >= -2147483648 and max(iv) <= 2147483647 then 'INTEGER' else 'BIGINT' end
  when bool_and(kind in ('int', 'float')) then 'FLOAT'
  when bool_and(kind in ('str', 'int', 'float')) then 'VARCHAR'
  when bool_and(kind = 'bool') then 'BOOLEAN'
  when bool_and(kind = 'dict') or bool_and(kind = 'list') then 'VARIANT'
  when bool_and(kind = 'uuid') then 'VARCHAR(36)'
  when bool_and(kind in ('datetime', 'str')) then 'TIMESTAMP_NTZ'
  when bool_and(kind in ('date', 'str')) then 'DATE'
  when bool_and(kind in ('time', 'str')) then 'TIME'
  else 'VARCHAR' end data_type
from (select column_name, case
        when raw is null or raw = 'null' then null when raw in ('true', 'false') then 'bool'
        when raw[1] = '{' then 'dict' when raw[1] = '[' then 'list'
        when regexp_full_match(raw, '-?[0-9]+') then 'int' when raw[1] <> '"' then 'float'
        when regexp_full_match(raw, '"[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9:]+Z?"') and try_cast(trim(raw, '"') as timestamp) is not null then 'datetime'
        when regexp_full_match(raw, '"[0-9]{4}-[0-9]{2}-[0-9]{2}"') and try_cast(trim(raw, '"') as date) is not null then 'date'
        when regexp_full_match(raw, '"[0-9]{2}:[0-9]{2}:[0-9]{2}"') and try_cast(trim(raw, '"') as time) is not null then 'time'
        when try_cast(trim(raw, '"') as uuid) is not null then 'uuid' else 'str' end kind,
        case when regexp_full_match(raw, '-?[0-9]+') then cast(raw as hugeint) end iv
      from (select k column_name, cast(json_extract(doc, '$.' || k) as varchar) raw from (select doc, unnest(json_keys(doc)) k from docs) x) y) z
group by column_name""", "trades", extra={"docs": f"select {ARMS_DOC} doc from trades"}))
def q_infer_column_types_lattice(spark, d):
    """P23, every arm: one key per mix of kinds, temporal kinds spelt as text, integers beyond 64 bit."""
    return SO.infer_column_types(C.trades(spark, d).select(F.expr(ARMS_DOC).alias("doc")), "doc")


@register("union_columns", with_views("""
select market_id, price, null::varchar side, null::double size from trades
union all select market_id, null, side, size from levels""", "trades", "levels"), doubles=("price", "size"))
def q_union_columns(spark, d):
    """Prints and book levels unioned by name, absent -> NULL."""
    a = C.trades(spark, d).select("market_id", "price")
    b = P.levels(spark, d).select("market_id", "side", "size")
    return SO.union_columns([a, b]).select("market_id", "price", "side", "size")


@register("add_missing_columns", with_views("""
select ticker, updated_time, null::timestamp loaded_at, null::varchar raw_payload, ingested_at
from load""", "load"))
def q_add_missing_columns(spark, d):
    """Declared load columns the rows lack become typed NULLs."""
    target = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("updated_time", T.StringType()),
                           T.StructField("loaded_at", T.TimestampNTZType()),
                           T.StructField("raw_payload", T.StringType())])
    ld = P.load_rows(spark, d).select("ticker", "updated_time", "ingested_at")
    return SO.add_missing_columns(ld, target)


# ---- incremental state ----

def _raw(spark, d):
    return P.raw_trades(spark, d)


def _state1(spark, d):
    """The watermark state after the first run: a stored table in the
    pipeline, so it is written once per query (checkpoint) and read by
    every branch."""
    def build():
        raw = _raw(spark, d)
        b1 = raw.filter(F.col("created_time") < CUT)
        latest = I.latest_trade_watermarks(b1)
        checked = b1.select(F.col("ticker").alias("market_ticker")).distinct()
        return materialize(I.merge_watermark_state(None, latest, checked, E1, CUT))
    return C.shared(("state1", d), build)


SEC = "floor(epoch(try_cast(created_time as timestamp)))::bigint"
WM_SQL = f"""
select market_ticker, arg_max(sec, (sec, trade_id)) last_seen_trade_ts,
       strftime(make_timestamp(arg_max(sec, (sec, trade_id)) * 1000000), '%Y-%m-%dT%H:%M:%SZ') last_seen_trade_time,
       arg_max(trade_id, (sec, trade_id)) last_seen_trade_id
from (select nullif(ticker, '') market_ticker, {SEC} sec, trade_id from raw_trades {{where}}) x
where market_ticker is not null and sec is not null group by market_ticker"""
STATE1_SQL = f"""
select 1 version, w.market_ticker, w.last_seen_trade_ts, w.last_seen_trade_time, w.last_seen_trade_id,
       {E1}::bigint checked_through_ts, strftime(make_timestamp({E1}::bigint * 1000000), '%Y-%m-%dT%H:%M:%SZ')
         checked_through_time, '{CUT}' updated_at
from (select distinct ticker market_ticker from raw_trades where created_time < '{CUT}') c
left join ({WM_SQL.format(where=f"where created_time < '{CUT}'")}) w on w.market_ticker = c.market_ticker"""


@register("latest_trade_watermarks", with_views(WM_SQL.format(where=""), "raw_trades"))
def q_latest_trade_watermarks(spark, d):
    return I.latest_trade_watermarks(_raw(spark, d))


@register("plan_trade_windows", with_views(f"""
select m.market_ticker, true all_pages,
       cast(case when s.checked_through_ts is not null then greatest(0, s.checked_through_ts - 60)
                 else {E2 - 24 * 3600} end as bigint) min_ts, {E2}::bigint max_ts
from (select distinct cast(market_id as varchar) market_ticker from markets) m
left join st s on s.market_ticker = m.market_ticker and cast(s.market_ticker as bigint) % 3 <> 0""", "raw_trades", "markets", extra={"st": STATE1_SQL}))
def q_plan_trade_windows(spark, d):
    """Incremental windows for a run at the end of the span, from the
    state left by a run at the cut; a third of the markets have no state."""
    m = P.markets(spark, d).select(F.col("market_id").cast("string").alias("market_ticker"))
    return I.plan_trade_windows(m, _some_state(spark, d), "incremental", E2)


def _some_state(spark, d):
    return _state1(spark, d).filter(F.col("market_ticker").cast("bigint") % 3 != 0)


@register("plan_trade_windows_modes", with_views(f"""
select market_ticker, mode, true all_pages, case when mode = 'backfill' then {E1}::bigint end min_ts,
       case when mode = 'backfill' then {E2}::bigint end max_ts
from (select distinct cast(market_id as varchar) market_ticker from trades) m
join (values ('backfill'), ('full_history')) v(mode) on true""", "trades"))
def q_plan_trade_windows_modes(spark, d):
    """T5: the modes without state; ``recent`` plans no window."""
    m = P.markets(spark, d).select(F.col("market_id").cast("string").alias("market_ticker"))
    plans = [I.plan_trade_windows(m, None, "backfill", E2, lo=E1, hi=E2).withColumn("mode", F.lit("backfill")),
             I.plan_trade_windows(m, None, "full_history", E2).withColumn("mode", F.lit("full_history")),
             I.plan_trade_windows(m, None, "recent", E2).withColumn("mode", F.lit("recent"))]
    return plans[0].unionByName(plans[1]).unionByName(plans[2])


@register("plan_windows_from_settings", with_views(f"""
select m.market_ticker, true all_pages, case when s.checked_through_ts is not null then greatest(0, s.checked_through_ts - 300)
       else {E2 - 6 * 3600}::bigint end min_ts, {E2}::bigint max_ts, true writes_state
from (select distinct cast(market_id as varchar) market_ticker from trades) m
left join st s on s.market_ticker = m.market_ticker and cast(s.market_ticker as bigint) % 3 <> 0""", "trades", "raw_trades", extra={"st": STATE1_SQL}))
def q_plan_windows_from_settings(spark, d):
    """T5 / T8 from a job's settings as text, with the state of an earlier run."""
    m = P.markets(spark, d).select(F.col("market_id").cast("string").alias("market_ticker"))
    settings = {"TRADE_MODE": " incremental ", "TRADE_LOOKBACK_HOURS": "6", "TRADE_OVERLAP_SECONDS": "300", "TRADE_MIN_TS": "", "WRITE_TRADE_STATE": "yes"}
    plan, writes = I.windows_from_settings(m, _some_state(spark, d), settings, E2)
    return plan.withColumn("writes_state", F.lit(writes))


@register("trade_fetch_window", with_views(f"""
select t.* from raw_trades t
left join st s on s.market_ticker = t.ticker and cast(s.market_ticker as bigint) % 3 <> 0
where {SEC.replace('created_time', 't.created_time')}
  between case when s.checked_through_ts is not null then greatest(0, s.checked_through_ts - 60)
               else {E2 - 24 * 3600} end and {E2}""",
    "raw_trades", extra={"st": STATE1_SQL}))
def q_trade_fetch_window(spark, d):
    """Prints inside each market's planned window; markets without
    state look back a day."""
    raw = _raw(spark, d).withColumn("market_ticker", F.col("ticker"))
    win = I.plan_trade_windows(raw.select("market_ticker"), _some_state(spark, d), "incremental", E2)
    return I.trade_fetch_window(raw, win, I.epoch_seconds("created_time")).drop("market_ticker")


@register("trade_fetch_pruned", with_views(f"""
select trade_id, market_id, trade_time, price from (
  select t.trade_id, t.market_id, t.trade_time, t.price + 1 price, epoch(t.trade_time) sec, s.checked_through_ts c
  from trades t left join st s on s.market_ticker = cast(t.market_id as varchar) and t.market_id % 3 <> 0) x
where floor(sec) between case when c is not null then greatest(0, c - 60) else {E2 - 24 * 3600} end and {E2}""",
    "trades", "raw_trades", extra={"st": STATE1_SQL}), doubles=("price",))
def q_trade_fetch_pruned(spark, d):
    """J13 / T5 over prints laid out by day: the planned windows prune the day folders at run time; every print was
    appended twice, its later version counts."""
    t = C.trades(spark, d).select("trade_id", "market_id", "trade_time", "price")
    name = TB.fresh_name("fetch")
    for version in (0, 1):
        TB.append_delta(spark, t.withColumns({"price": F.col("price") + version, "version": F.lit(version)}), name, ["trade_id"], "trade_time")
    markets = t.select(F.col("market_id").cast("string").alias("market_ticker"))
    win = I.plan_trade_windows(markets, _some_state(spark, d), "incremental", E2).withColumn("market_id", F.col("market_ticker").cast("bigint"))
    sec = F.floor(F.unix_micros(F.col("trade_time").cast("timestamp")) / 1000000)
    return TB.fetch_delta(spark, name, win, sec, [("version", "desc_nulls_last")], "market_id").select("trade_id", "market_id", "trade_time", "price")


@register("landing_run_counts", with_views("""
select 'trades' entity, count(*) rows_written from raw_trades union all select 'markets', count(*) from raw_markets_full
union all select 'series', count(*) from raw_series union all select 'events', count(*) from raw_events""", "raw_trades", "raw_markets_full", "raw_series", "raw_events"))
def q_landing_run_counts(spark, d):
    """Q13 written with the run: rows per entity, observed on the landing writes."""
    return J.land_run({"trades": P.raw_trades(spark, d), "markets": P.raw_markets_full(spark, d), "series": P.raw_series(spark, d),
                       "events": P.raw_events(spark, d)}, shared_dir(spark, "run"), RUN2, compression="gzip")


@register("merge_watermark_state", with_views(f"""
select 1 version, coalesce(s.market_ticker, n.market_ticker) market_ticker,
       case when n.last_seen_trade_ts is not null and (s.last_seen_trade_ts is null
                 or n.last_seen_trade_ts >= s.last_seen_trade_ts) then n.last_seen_trade_ts else s.last_seen_trade_ts end
         last_seen_trade_ts,
       case when n.last_seen_trade_ts is not null and (s.last_seen_trade_ts is null
                 or n.last_seen_trade_ts >= s.last_seen_trade_ts) then n.last_seen_trade_time else s.last_seen_trade_time end
         last_seen_trade_time,
       case when n.last_seen_trade_ts is not null and (s.last_seen_trade_ts is null
                 or n.last_seen_trade_ts >= s.last_seen_trade_ts) then n.last_seen_trade_id else s.last_seen_trade_id end
         last_seen_trade_id,
       {E2}::bigint checked_through_ts, strftime(make_timestamp({E2}::bigint * 1000000), '%Y-%m-%dT%H:%M:%SZ')
         checked_through_time, '2024-01-31T00:00:00Z' updated_at
from st s full join (select c.market_ticker, w.last_seen_trade_ts, w.last_seen_trade_time, w.last_seen_trade_id
                     from (select distinct ticker market_ticker from raw_trades) c
                     left join ({WM_SQL.format(where=f"where created_time >= '{CUT}'")}) w
                       on w.market_ticker = c.market_ticker) n on n.market_ticker = s.market_ticker""",
    "raw_trades", extra={"st": STATE1_SQL}))
def q_merge_watermark_state(spark, d):
    """The second run advances every market it checked."""
    raw = _raw(spark, d)
    latest = I.latest_trade_watermarks(raw.filter(F.col("created_time") >= CUT))
    checked = raw.select(F.col("ticker").alias("market_ticker")).distinct()
    return I.merge_watermark_state(_state1(spark, d), latest, checked, E2, "2024-01-31T00:00:00Z")


@register("recent_trades", with_views("""
select * exclude (rn) from (select *, row_number() over (partition by market_id
  order by trade_time desc, trade_id desc) rn from trades) x where rn <= 20""", "trades"), doubles=("price",))
def q_recent_trades(spark, d):
    """The latest 20 prints per market (a page is smaller than the markets here)."""
    return recent_trades(C.trades(spark, d), 20)


@register("dedupe_overlap", with_views("select * from raw_trades", "raw_trades"))
def q_dedupe_overlap(spark, d):
    """Two overlapping fetch windows; the key merge leaves each print once."""
    raw = _raw(spark, d)
    sec = I.epoch_seconds("created_time")
    a = raw.filter(sec <= E1 + 3600)
    b = raw.filter(sec >= E1 - 3600)
    return I.dedupe_overlap(a.unionByName(b), [("created_time", "desc_nulls_last")])


# ---- streaming ----

LOAD_SPEC = [("$.ticker", "ticker", "string"), ("$.updated_time", "updated_time", "string"),
             ("$.ingested_at", "ingested_at", "timestamp_ntz"), ("$.source_file", "source_file", "string"),
             ("$.source_row_number", "source_row_number", "bigint"), ("$.value", "value", "double"),
             ("$.event_time", "event_time", "timestamp_ntz")]
LOAD_COLS = [c for _, c, _ in LOAD_SPEC]


def _stream_load(spark, d, name, until=None):
    """Lands the load rows in two runs (the second only without ``until``),
    an empty run, and a run of lines that are no objects, and streams them."""
    root = shared_dir(spark, name)
    _land_load(spark, d, root, first=True)
    if until is None:
        _land_load(spark, d, root, first=False)
    spark.createDataFrame([("not json {",), ("[1]",)], "value string").coalesce(1).write.text(
        J.landing_path(root + "/landing", "exchange", "load", RUN2) + "/broken")
    SI.stream_ingest(spark, root + "/landing", root + "/load", root + "/ckpt_ingest", LOAD_SPEC)
    # a second run over the same checkpoint loads nothing new
    SI.stream_ingest(spark, root + "/landing", root + "/load", root + "/ckpt_ingest", LOAD_SPEC)
    return root


def _land_load(spark, d, root, first):
    ld = P.load_rows(spark, d)
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    J.land(ld.filter(F.col("event_time") < cut if first else F.col("event_time") >= cut), root + "/landing", "load",
           RUN1 if first else RUN2, compression="gzip")
    # an empty landing run adds nothing
    J.land(ld.limit(0), root + "/landing", "load", RUN2 + dt.timedelta(hours=1))


def _loaded(spark, path):
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


@register("stream_ingest", with_views(
    f"select {', '.join(LOAD_COLS)}, true numbered from load", "load"), doubles=("value",))
def q_stream_ingest(spark, d):
    """Every landed object appended to the load table exactly once, with its place in its file."""
    rows = _loaded(spark, _stream_load(spark, d, "stream1") + "/load")
    places = Window.partitionBy("landing_file")
    ok = (F.count(F.lit(1)).over(places) == F.max("landing_row_number").over(places)) & (F.col("landing_row_number") > 0)
    return rows.select(*LOAD_COLS, ok.alias("numbered"))


@register("stream_bad_lines", with_views("select 2 bad_lines, count(*) good_lines from load", "load"))
def q_stream_bad_lines(spark, d):
    """Lines that are no JSON object are kept apart."""
    root = _stream_load(spark, d, "stream3")
    both = _loaded(spark, root + "/load_bad").select(F.lit(True).alias("b")).unionAll(
        _loaded(spark, root + "/load").select(F.lit(False)))
    return both.agg(F.count_if("b").alias("bad_lines"), F.count_if(~F.col("b")).alias("good_lines"))


@register("stream_merge_latest", with_views(
    "select * exclude (rn) from (select *, row_number() over (partition by ticker order by "
    "try_cast(updated_time as timestamp) desc nulls last, ingested_at desc nulls last, "
    "source_file desc nulls first, source_row_number desc nulls first) rn from "
    f"(select {', '.join(LOAD_COLS)} from load) l) x where rn = 1", "load"), doubles=("value",))
def q_stream_merge_latest(spark, d):
    """Micro-batches of the load table merged into current state, with
    the recency guard.  The checkpoint is lost between two runs: the second
    starts over with a new one and must still take what came in between."""
    root = _stream_load(spark, d, "stream2", until=RUN2)
    schema = _loaded(spark, root + "/load").select(*LOAD_COLS).schema
    order = order_for("markets", LOAD_COLS)
    now = TB.fresh_name("market_now")
    SI.stream_merge_latest(spark, root + "/load", schema, now, root + "/ckpt_merge", ["ticker"], order, guard=True, buckets=16)
    _land_load(spark, d, root, first=False)
    SI.stream_ingest(spark, root + "/landing", root + "/load", root + "/ckpt_ingest", LOAD_SPEC)
    SI.stream_merge_latest(spark, root + "/load", schema, now, root + "/ckpt_merge2", ["ticker"], order)
    return TB.current(spark, now).select(*LOAD_COLS)


@register("landing_to_fact", FCT_MARKETS_FULL)
def q_landing_to_fact(spark, d):
    """The whole way in two runs: land, stream into the load table, merge the
    batches into current state, stage, join to the fact.  The first run lands
    an early version of every market, the second the final one."""
    # for sessions that others have built, and for the fact, which runs after this call
    spark.conf.set(COMPILED, BASE_CONF[COMPILED])
    root = shared_dir(spark, "way")
    m = P.raw_markets_full(spark, d)
    early = m.withColumns({"updated_time": F.lit("2000-01-01T00:00:00Z"), "status": F.lit("early")})
    names = [c for _, c, _ in MARKET_SPEC]
    order = order_for("markets", [*names, "loaded_at", "source_file", "source_row_number"])
    now = TB.fresh_name("market_way")
    for run, rows in ((RUN1, early), (RUN2, m)):
        J.land(rows, root + "/landing", "markets", run, compression="gzip")
        SI.stream_ingest(spark, root + "/landing", root + "/load", root + "/ckpt_ingest", MARKET_SPEC)
        schema = _loaded(spark, root + "/load").schema
        SI.stream_merge_latest(spark, root + "/load", schema, now, root + "/ckpt_merge", ["ticker"],
                               [("loaded_at", "desc_nulls_last"), *order], guard=True)
    current = TB.current(spark, now).select(*names)
    return M.fct_markets(ST.stg_markets(current), some_events(spark, d))


def _land_and_merge(spark, entity, spec, keys, early, final, day=None):
    """Two landing runs of an entity (an early version of its rows, then the final one), streamed into its load table
    and on into its current table: keyed, or by ``day`` for insert-mostly entities."""
    root, now = shared_dir(spark, f"way-{entity}"), TB.fresh_name(f"{entity}_way")
    order = None
    for run, rows in ((RUN1, early), (RUN2, final)):
        J.land(rows, root + "/landing", entity, run, compression="gzip")
        SI.stream_ingest(spark, root + "/landing", root + "/load", root + "/ckpt_ingest", spec)
        schema = _loaded(spark, root + "/load").schema
        order = [("loaded_at", "desc_nulls_last"), *order_for(entity, schema.names)]
        if day is None:
            SI.stream_merge_latest(spark, root + "/load", schema, now, root + "/ckpt_merge", keys, order, progress="loaded_at")
        else:
            SI.stream_append_delta(spark, root + "/load", schema, now, root + "/ckpt_merge", keys, day)
    return TB.current(spark, now) if day is None else TB.resolve_delta(spark, now, order)


@register("landing_to_trades", with_views(STG_TRADES_SQL, "raw_trades"))
def q_landing_to_trades(spark, d):
    """The whole way for prints by id: land, stream, append to the days' folders, resolve on read, stage."""
    t = P.raw_trades(spark, d)
    early = t.filter(F.col("trade_id").cast("bigint") % 2 == 0).withColumn("count_fp", F.lit("0"))
    return ST.stg_trades(_land_and_merge(spark, "trades", TRADE_SPEC, ["trade_id"], early, t, F.expr("try_cast(created_time as timestamp_ntz)")))


@register("landing_to_events", with_views(STG_EVENTS_SQL, "raw_events"))
def q_landing_to_events(spark, d):
    """The whole way for events: land, stream, merge, stage."""
    e = P.raw_events(spark, d)
    early = e.withColumns({"title": F.lit("early"), "sub_title": F.lit(None).cast("string")})
    return ST.stg_events(_land_and_merge(spark, "events", EVENT_SPEC, ["event_ticker"], early, e))


SERIES_VARIANT = [(p, c, "variant" if c == "tags" else t) for p, c, t in SERIES_SPEC]


@register("landing_to_series", with_views(STG_SERIES_SQL, "raw_series"))
def q_landing_to_series(spark, d):
    """The whole way for series; the tags stay VARIANT from the load table to the staging model."""
    r = P.raw_series(spark, d)
    early = r.withColumns({"title": F.lit("early"), "tags": F.array(F.lit("x"))})
    s = ST.stg_series(_land_and_merge(spark, "series", SERIES_VARIANT, ["ticker"], early, r))
    return s.withColumn("tags", F.try_variant_get("tags", "$", "array<string>"))


@register("landing_to_orderbooks", FCT_ORDERBOOKS_SQL)
def q_landing_to_orderbooks(spark, d):
    """The whole way for order books: land, stream, merge, stage, join to the fact; the ladders stay VARIANT and are
    read by path (the last step spells them for the comparison)."""
    b = P.raw_orderbooks(spark, d).withColumn("orderbook", F.from_json("orderbook", BOOK_SCHEMA))
    early = b.withColumn("orderbook", F.from_json(F.lit('{"yes_dollars": [["0.01", "1"]], "no_dollars": []}'), BOOK_SCHEMA))
    spec = [("$.market_ticker", "market_ticker", "string"), ("$.orderbook", "orderbook", "variant")]
    now = _land_and_merge(spark, "orderbooks", spec, ["market_ticker"], early, b)
    fact = M.fct_orderbooks(ST.stg_orderbooks(now), ST.stg_markets(P.raw_markets(spark, d)), ST.stg_events(P.raw_events(spark, d)))
    side = lambda x: F.try_variant_get("orderbook", f"$.{x}_dollars", "array<array<string>>").alias(f"{x}_dollars")
    return fact.withColumn("orderbook", F.to_json(F.struct(side("yes"), side("no"))))


@register("minute_bars_stream", with_views("""
select market_id, window_start, window_end, price, trades from (
  select market_id, date_trunc('minute', trade_time) window_start,
         date_trunc('minute', trade_time) + interval 1 minute window_end,
         arg_max(price, (trade_time, trade_id)) price, count(*) trades
  from trades group by 1, 2) b
where window_end <= (select max(trade_time) from trades) - interval 60 second""", "trades", trades="near_trades"), doubles=("price",), near=True)
def q_minute_bars_stream(spark, d):
    """One-minute tumbling bars from a file stream of the prints; append
    mode emits a bar once the 60 s watermark has passed its end."""
    root = shared_dir(spark, "bars")
    src = d.rstrip("/")
    schema = spark.read.parquet(f"{src}/events.parquet").schema
    ev = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(src)
    t = ev.select(F.col("event_id").alias("trade_id"), F.col("user_id").alias("market_id"),
                  P.near_time("ts").cast("timestamp").alias("event_time"),
                  F.expr("floor(value * 10000 / (value + 20)) / 10000").alias("price"))
    bars = SI.minute_bars_stream(t, step="1 minute", delay="60 seconds")
    q = (bars.writeStream.outputMode("append").format("parquet").option("checkpointLocation", root + "/ckpt")
         .trigger(availableNow=True).start(root + "/out"))
    q.awaitTermination()
    return spark.read.parquet(root + "/out")


@register("dedupe_stream", with_views("select trade_id, market_id, trade_time from trades", "trades"))
def q_dedupe_stream(spark, d):
    """T10 in-stream: two overlapping fetches of the prints, each print passes once."""
    root = shared_dir(spark, "dedupe")
    t = C.trades(spark, d).select("trade_id", "market_id", F.col("trade_time").cast("timestamp").alias("event_time"))
    t.write.parquet(root + "/in/all")
    t.filter(F.col("trade_id") % 3 == 0).write.parquet(root + "/in/again")
    stream = spark.readStream.schema(t.schema).option("recursiveFileLookup", "true").parquet(root + "/in")
    q = (SI.dedupe_stream(stream, "event_time", "trade_id", "60 days").writeStream.format("parquet")
         .option("checkpointLocation", root + "/ckpt").trigger(availableNow=True).start(root + "/out"))
    q.awaitTermination()
    return spark.read.parquet(root + "/out").select("trade_id", "market_id", F.col("event_time").cast("timestamp_ntz").alias("trade_time"))
