"""Derived dimensions are built once per registered query call."""

from tests.conftest import SF001

from marketlake.plans import common as C


def test_markets_dimension_is_shared_within_a_query_only(spark):
    with C.query_scope():
        a = C.markets_outcome(spark, SF001)
        assert C.markets_outcome(spark, SF001) is a
    assert C.markets_outcome(spark, SF001) is not a


def test_live_summary_reads_the_prints_a_few_times(spark):
    import __spark_entry__ as E
    df = E.queries()["live_game_summary"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the dimension comes from its checkpoint; the prints are scanned for
    # the live path, the live prints and the grid only (it was 30 scans when
    # every branch re-derived markets, winners, pairs and games)
    assert plan.count("events.parquet") <= 4
