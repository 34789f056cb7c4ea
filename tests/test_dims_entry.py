"""Dimensions and the driver contract."""

import datetime as dt

from marketlake.operators import dims as D
from tests.conftest import SF001


def test_dim_dates_fixed_range(spark):
    d = D.dim_dates(spark)
    assert d.count() == 5844 and len(d.columns) == 35
    r = {x.the_date: x for x in d.filter("the_date in ('2024-02-29', '2021-01-03', '2026-12-31')").collect()}
    a = r[dt.date(2024, 2, 29)]
    assert (a.the_day_suffix, a.the_day_name, a.the_day_of_week, a.is_leap_year, a.style_103) == \
        ("th", "Thursday", 4, True, "29/02/2024")
    b = r[dt.date(2021, 1, 3)]
    # Sunday: ISO day 7, ISO week 53 of 2020, US week 2 of 2021
    assert (b.the_day_of_week, b.the_iso_week, b.the_iso_year, b.the_week, b.is_weekend) == (7, 53, 2020, 2, True)
    assert b.the_first_of_week == dt.date(2020, 12, 28)


def test_dim_times(spark):
    t = D.dim_times_from(spark.range(1440).withColumnRenamed("id", "minute_of_day"))
    assert t.count() == 1440
    r = {x.time_key: x for x in t.filter("time_key in (0, 725, 1439)").collect()}
    assert (r[0].the_hour_12, r[0].am_pm, r[0].portion_of_day) == (12, "AM", "overnight")
    assert (r[725].the_time, r[725].portion_of_day, r[725].style_hhmm_12) == ("12:05:00", "noon", "12:05 PM")
    assert r[1439].portion_of_day == "night"


def test_entry_and_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 30
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 100


def test_some_queries_run_at_smallest_scale(spark):
    import __spark_entry__ as E
    q = E.queries()
    for name in ("pregame_market_summary", "live_game_summary", "lagged_pair_corr", "orderbook_implied_std",
                 "fct_markets", "infer_column_types"):
        assert q[name](spark, SF001).count() >= 0
