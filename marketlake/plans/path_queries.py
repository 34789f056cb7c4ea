"""Registered queries: price paths, as-of lookups, lags."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators import paths as PA
from marketlake.plans import common as C
from marketlake.plans.registry import register
from marketlake.plans.views import with_views

W2_COLS = ["market_id", "trade_id", "trade_time", "size", "taker_side", "prev_price", "price",
           "price_delta", "move_direction", "information_score"]

W2_SQL_BODY = """
select market_id, trade_id, trade_time, size, taker_side, prev_price, price, price - prev_price price_delta,
       if(price > prev_price, 'yes', 'no') || '-favorable shock' move_direction,
       if(size > 0, abs(price - prev_price) / ln(1 + size), null) information_score
from (select *, lag(price) over (partition by market_id order by trade_time, trade_id) prev_price from trades) t
where price is distinct from prev_price and price is not null and prev_price is not null"""


@register("trade_information_score",
          with_views(W2_SQL_BODY, "trades"),
          doubles=("prev_price", "price", "price_delta", "information_score"))
def q_trade_information_score(spark, d):
    return PA.trade_information_score(C.trades(spark, d)).select(*W2_COLS)


@register("top_movers",
          with_views(f"select * from ({W2_SQL_BODY}) s order by information_score desc nulls last, "
                     "trade_id limit 30", "trades"),
          doubles=("prev_price", "price", "price_delta", "information_score"))
def q_top_movers(spark, d):
    return PA.top_movers(PA.trade_information_score(C.trades(spark, d)).select(*W2_COLS), 30)


@register("trade_price_path", with_views("""
select market_id, trade_id, trade_time, price, size,
       price - lag(price) over w price_delta,
       date_diff('second', lag(trade_time) over w, trade_time) seconds_since_prev,
       sum(size) over (w rows between unbounded preceding and current row) cumulative_volume
from trades window w as (partition by market_id order by trade_time, trade_id)""", "trades"),
          doubles=("price", "price_delta"))
def q_trade_price_path(spark, d):
    t = C.trades(spark, d).select("market_id", "trade_id", "trade_time", "price", "size")
    return PA.trade_price_path(t).withColumn("cumulative_volume", F.col("cumulative_volume").cast("bigint"))


@register("minute_path", with_views("""
select g.market_id, g.minute, last_value(b.price ignore nulls) over
         (partition by g.market_id order by g.minute rows between unbounded preceding and current row) price
from (select market_id, unnest(generate_series(min(bucket), max(bucket), interval 1 minute)) as minute
      from b0 group by market_id) g
left join b0 b on b.market_id = g.market_id and b.bucket = g.minute
""", "trades", extra={"b0": """select market_id, date_trunc('minute', trade_time) bucket,
        arg_max(price, (trade_time, trade_id)) price from trades group by 1, 2"""}, trades="near_trades"),
          doubles=("price",), near=True)
def q_minute_path(spark, d):
    return PA.minute_path(C.trades(spark, d), step="minute")
