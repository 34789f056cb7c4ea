"""Time zone, tag matching, scope keys, ticker parsing, drift."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake.functions.timecols import to_eastern
from marketlake.operators import schema_ops as SO
from marketlake.operators import scope as S


def test_eastern_dst(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 5, 10, 23, 20),), (dt.datetime(2026, 1, 10, 23, 20),)],
                               "t timestamp_ntz")
    got = [r.e for r in df.select(to_eastern("t").alias("e")).collect()]
    assert got == [dt.datetime(2026, 5, 10, 19, 20), dt.datetime(2026, 1, 10, 18, 20)]


def test_tags_match_all_case_folded(spark):
    df = spark.createDataFrame([(1, ["baseball"]), (2, ["BaseBall", "Sports"]), (3, ["BasketBall"]), (4, None)],
                               "id int, tags array<string>")
    assert sorted(r.id for r in S.tags_match_all(df, ["BaseBall"]).collect()) == [1, 2]


def test_scope_keys_distinct_non_empty(spark):
    df = spark.createDataFrame([("EVT-1",), ("EVT-2",), ("EVT-1",), (None,), ("",)], "event_ticker string")
    assert sorted(r.event_ticker for r in S.scope_keys(df, "event_ticker").collect()) == ["EVT-1", "EVT-2"]


def test_scope_filter_requires_one_scope(spark):
    df = spark.createDataFrame([("M1", "E1")], "market_ticker string, event_ticker string")
    with pytest.raises(ValueError):
        S.scope_filter(df, market="M1", event="E1")
    assert S.scope_filter(df, event=["E1", "E2"]).count() == 1
    with pytest.raises(ValueError):
        S.status_filter(df, "all", scoped=False)


def test_parse_event_ticker(spark):
    df = spark.createDataFrame([("KXMLBGAME-26MAY201305CINPHI",)], "event_ticker string")
    r = S.parse_event_ticker(df).collect()[0]
    assert (r.series_code, r.date_code, r.start_hhmm, r.team_codes) == ("KXMLBGAME", "26MAY20", "1305", "CINPHI")
    assert r.game_start_et == dt.datetime(2026, 5, 20, 13, 5)
    assert r.game_start_utc == dt.datetime(2026, 5, 20, 17, 5)
    t = spark.createDataFrame([("KXMLBGAME-26MAY201305CINPHI-CIN",)], "market_ticker string")
    assert t.select(S.contract_team_code().alias("c")).collect()[0].c == "CIN"
    assert df.select(S.ticker_date(F.col("event_ticker")).alias("d")).collect()[0].d == dt.date(2026, 5, 20)


def test_schema_drift(spark):
    df = spark.createDataFrame([(1, "x")], "market_id long, orderbook string")
    assert SO.schema_drift(df, ["market_ticker", "orderbook"]) == [("market_id", "added"), ("market_ticker", "removed")]
    assert SO.schema_drift(df, ["MARKET_ID", "orderbook"]) == []


def test_infer_column_types_lattice(spark):
    docs = ['{"a": 1, "b": 1.5, "c": "x", "d": 70000, "e": true, "f": {"k": 1}, "g": null, "h": 1}',
            '{"a": 2, "b": 2, "c": 3, "d": 5000000000, "e": false, "f": [1], "g": null, "h": "y"}']
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    got = {r.column_name: r.data_type for r in SO.infer_column_types(df, "doc").collect()}
    assert got == {"a": "SMALLINT", "b": "FLOAT", "c": "VARCHAR", "d": "BIGINT", "e": "BOOLEAN",
                   "f": "VARCHAR", "g": "VARCHAR", "h": "VARCHAR"}
