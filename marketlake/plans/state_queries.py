"""Registered queries: latest row per key, upsert, duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators import latest as L
from marketlake.plans.registry import register
from marketlake.plans.views import with_views
from marketlake.schemas import order_for
from marketlake.sources import proxies as P

LOAD_COLS = "ticker, updated_time, ingested_at, source_file, source_row_number, value, event_time"
MARKETS_ORDER_SQL = ("try_cast(updated_time as timestamp) desc nulls last, ingested_at desc nulls last, "
                     "source_file desc nulls first, source_row_number desc nulls first")
TEAMS_ORDER_SQL = "ingested_at desc nulls first, source_file desc nulls first, source_row_number desc nulls first"
SPLIT = "timestamp '2024-01-16 00:00:00'"


def latest_sql(src: str, order_sql: str, key: str = "ticker") -> str:
    return (f"select {LOAD_COLS} from (select *, row_number() over (partition by {key} "
            f"order by {order_sql}) rn from {src} where {key} is not null) x where rn = 1")


def entity_sql(entity: str, key: str) -> str:
    """The latest row per key of an entity's load rows."""
    order = ("ingested_at desc nulls last, loaded_at desc nulls last, source_file desc nulls first, "
             "source_row_number desc nulls first")
    return (f"select * exclude (rn) from (select *, row_number() over (partition by {key} order by {order}) rn "
            f"from load_{entity}) x where rn = 1")


def _load(spark, d):
    return P.load_rows(spark, d)


@register("latest_markets", with_views(latest_sql("load", MARKETS_ORDER_SQL), "load"), doubles=("value",))
def q_latest_markets(spark, d):
    df = _load(spark, d)
    return L.latest_per_key(df, ["ticker"], order_for("markets", df.columns))


@register("latest_events", with_views(entity_sql("events", "event_ticker"), "load_events"))
def q_latest_events(spark, d):
    df = P.load_entity(spark, d, "events")
    return L.latest_per_key(df, ["event_ticker"], order_for("events", df.columns))


@register("latest_teams", with_views(latest_sql("load", TEAMS_ORDER_SQL), "load"), doubles=("value",))
def q_latest_teams(spark, d):
    df = _load(spark, d)
    return L.latest_per_key(df, ["ticker"], order_for("teams", df.columns))


def _batches(spark, d):
    df = _load(spark, d)
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return df, df.filter(F.col("event_time") < cut), df.filter(F.col("event_time") >= cut)


def merge_sql(first: str, second: str, guard: bool = False) -> str:
    extra = {
        "b1": f"select * from load where event_time < {SPLIT}",
        "b2": f"select * from load where event_time >= {SPLIT}",
        "tgt": latest_sql(first, MARKETS_ORDER_SQL),
        "src": latest_sql(second, MARKETS_ORDER_SQL),
    }
    if guard:
        extra["allrows"] = "select * from tgt union all select * from src"
        body = latest_sql("allrows", MARKETS_ORDER_SQL)
    else:
        body = ("select * from tgt where ticker not in (select ticker from src) "
                "union all select * from src")
    return with_views(body, "load", extra=extra)


@register("merge_latest", merge_sql("b1", "b2"), doubles=("value",))
def q_merge_latest(spark, d):
    df, b1, b2 = _batches(spark, d)
    order = order_for("markets", df.columns)
    target = L.latest_per_key(b1, ["ticker"], order)
    return L.merge_latest(target, b2, ["ticker"], order)


@register("merge_latest_late_batch", merge_sql("b2", "b1"), doubles=("value",))
def q_merge_latest_late(spark, d):
    """Older batch arriving last overwrites newer rows (no recency guard)."""
    df, b1, b2 = _batches(spark, d)
    order = order_for("markets", df.columns)
    target = L.latest_per_key(b2, ["ticker"], order)
    return L.merge_latest(target, b1, ["ticker"], order)


@register("merge_latest_guarded", merge_sql("b2", "b1", guard=True), doubles=("value",))
def q_merge_latest_guarded(spark, d):
    df, b1, b2 = _batches(spark, d)
    order = order_for("markets", df.columns)
    target = L.latest_per_key(b2, ["ticker"], order)
    return L.merge_latest(target, b1, ["ticker"], order, guard=True)


@register("duplicate_rows", with_views(
    "select ticker, ingested_at, count(*) n from load group by ticker, ingested_at having count(*) > 1",
    "load"))
def q_duplicate_rows(spark, d):
    return L.duplicate_rows(_load(spark, d), ["ticker", "ingested_at"])


@register("distinct_rows", with_views(
    "select * exclude (rn) from (select *, row_number() over (partition by ticker, source_file "
    "order by source_row_number) rn from load) x where rn = 1", "load"), doubles=("value",))
def q_distinct_rows(spark, d):
    """U4: first row per (ticker, file) by an explicit order (not dropDuplicates)."""
    df = _load(spark, d)
    neg = (-F.col("source_row_number"))
    return L.latest_per_key(df, ["ticker", "source_file"], [(neg, "desc_nulls_last")],
                            drop_null_keys=False)


@register("union_all", with_views(
    "select ticker, source_row_number, value, null::double other_value from load where event_type_file = 'view.jsonl' "
    "union all select ticker, source_row_number, null::double value, value other_value from load "
    "where event_type_file <> 'view.jsonl'", "load").replace("event_type_file", "source_file"),
    doubles=("value", "other_value"))
def q_union_all(spark, d):
    """Per-source row sets with different columns, concatenated by name."""
    df = _load(spark, d)
    a = df.filter(F.col("source_file") == "view.jsonl").select("ticker", "source_row_number", "value")
    b = df.filter(F.col("source_file") != "view.jsonl").select(
        "ticker", "source_row_number", F.col("value").alias("other_value"))
    return L.union_all([a, b]).select("ticker", "source_row_number", "value", "other_value")
