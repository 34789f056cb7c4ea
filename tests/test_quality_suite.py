import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake.operators import quality as Q
from marketlake.operators import schema_ops as SO
from marketlake.operators.incremental import plan_trade_windows, windows_from_settings
from marketlake.operators.paths import recent_trades
from marketlake.session import shared_dir
from marketlake.sources import jsonl as J
from marketlake.sources import tables as TB

RUN = dt.datetime(2024, 1, 16, 12, 0, tzinfo=dt.timezone.utc)


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_suite_counts_what_single_rules_find(spark):
    markets = rows(spark, [(1, "a", 5.0), (2, "b", None), (2, None, 7.0), (None, "z", -1.0), (None, "z", 0.0)], "id long, status string, v double")
    trades = rows(spark, [(10, 1), (11, 2), (11, 9), (12, None), (None, 9)], "trade_id long, id long")
    tables = {"markets": markets, "trades": trades}
    rules = [Q.Rule("markets", "unique", ("id",)), Q.Rule("markets", "not_null", ("status", "v")), Q.Rule("markets", "accepted_values", ("status",), values=("a", "b")),
             Q.Rule("markets", "accepted_range", ("v",), lo=0), Q.Rule("markets", "holds", condition="v <> 7"), Q.Rule("markets", "unique", ("id", "status")),
             Q.Rule("trades", "relationship", ("id",), parent="markets", parent_column="id"), Q.Rule("trades", "unique", ("trade_id",))]
    got = {r.rule: (r.checked_rows, r.failing) for r in Q.run_suite(tables, rules).collect()}
    for rule in rules:
        assert got[rule.name] == (5, Q.failing_rows(tables, rule).count()), rule.name
    assert [got[r.name][1] for r in rules] == [1, 2, 2, 1, 1, 0, 2, 1]


def test_suite_of_empty_tables(spark):
    empty = rows(spark, [], "id long, v double")
    rules = [Q.Rule("t", "unique", ("id",)), Q.Rule("t", "not_null", ("v",)), Q.Rule("t", "relationship", ("id",), parent="p", parent_column="id")]
    assert sorted(tuple(r) for r in Q.run_suite({"t": empty, "p": empty}, rules).collect()) == sorted((r.name, 0, 0) for r in rules)


def test_suite_scans_each_table_once(spark):
    path = shared_dir(spark, "t-suite")
    spark.range(100).select("id", (F.col("id") % 3).alias("v")).write.parquet(path)
    rules = [Q.Rule("t", "unique", ("id",)), Q.Rule("t", "unique", ("v",)), Q.Rule("t", "not_null", ("v",)), Q.Rule("t", "holds", condition="v < 2")]
    facts = Q.scan_rules(spark.read.parquet(path), rules)
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    assert {r.rule: r.failing for r in Q.run_suite({"t": spark.read.parquet(path)}, rules).collect()} == {
        "t.unique(id)": 0, "t.unique(v)": 3, "t.not_null(v)": 0, "t.holds(v < 2)": 33}


@pytest.mark.parametrize("values,want", [
    ([], "VARCHAR"), (["null"], "VARCHAR"), (["1", "-32768", "32767"], "SMALLINT"), (["32768"], "INTEGER"), (["-2147483649"], "BIGINT"),
    (["100000000000000000000"], "BIGINT"), (["1", "100000000000000000000", "2.5"], "FLOAT"), (["1.5", "null"], "FLOAT"), (["5.0"], "FLOAT"), (["1e20"], "FLOAT"),
    (["true"], "BOOLEAN"), (["true", "1"], "VARCHAR"), (['{"a":1}'], "VARIANT"), (["[1]"], "VARIANT"), (["[1]", "{}"], "VARCHAR"), (['"x"', "1", "2.5"], "VARCHAR"),
    (['"2024-02-29"'], "DATE"), (['"2023-02-29"'], "VARCHAR"), (['"2024-02-29"', '"x"'], "DATE"), (['"10:20"', '"10:20:30.25"'], "TIME"), (['"25:20"'], "VARCHAR"),
    (['"2024-02-29T10:20:30Z"', '"2024-02-29 10:20:30.123456+02:00"'], "TIMESTAMP_NTZ"), (['"2024-02-29T10:20"', '"soon"', "null"], "TIMESTAMP_NTZ"),
    (['"2024-02-29"', '"2024-02-29T10:20:30"'], "VARCHAR"), (['"2024-02-29"', "1"], "VARCHAR"), (['"00000000-0000-4000-8000-0123456789ab"'], "VARCHAR(36)"),
    (['"00000000-0000-4000-8000-0123456789ab"', '"x"'], "VARCHAR")])
def test_type_lattice(spark, values, want):
    docs = rows(spark, [(f'{{"k":{v},"other":1}}',) for v in values] or [('{"k":null}',)], "doc string")
    assert {r.column_name: r.data_type for r in SO.infer_column_types(docs, "doc").collect()}["k"] == want


def test_texts_stay_texts_without_temporal_kinds(spark):
    docs = rows(spark, [('{"k":"2024-02-29"}',)], "doc string")
    assert [r.data_type for r in SO.infer_column_types(docs, "doc", temporal=False).collect()] == ["VARCHAR"]


def test_a_run_counts_its_rows_as_it_lands_them(spark):
    root = shared_dir(spark, "t-run")
    frames = {"events": spark.range(7).selectExpr("cast(id as string) k"), "series": spark.range(0).selectExpr("cast(id as string) k")}
    for _ in range(2):   # landing the run again replaces files and counts
        assert {r.entity: r.rows_written for r in J.land_run(frames, root, RUN).collect()} == {"events": 7, "series": 0}
    assert J.scan_jsonl(spark, J.landing_path(root, "exchange", "events", RUN), [("$.k", "k", "string")])[0].count() == 7


def day_rows(spark, data):
    return rows(spark, [(i, m, dt.datetime(2024, 1, d, h), v) for i, m, d, h, v in data], "id long, m string, at timestamp_ntz, v long")


def test_fetch_reads_only_the_days_windows_reach(spark):
    name = TB.fresh_name("t_fetch")
    TB.append_delta(spark, day_rows(spark, [(d * 10 + k, "ab"[k], d, 12, 1) for d in range(1, 8) for k in (0, 1)]), name, ["id"], "at")
    TB.append_delta(spark, day_rows(spark, [(51, "b", 5, 12, 2)]), name, ["id"], "at")
    at = lambda d, h: int(dt.datetime(2024, 1, d, h, tzinfo=dt.timezone.utc).timestamp())
    sec, order = F.unix_seconds(F.col("at").cast("timestamp")), [("v", "desc_nulls_last")]
    win = rows(spark, [("a", at(3, 13), at(4, 12)), ("b", at(5, 0), at(5, 23))], "m string, min_ts long, max_ts long")
    fetched = TB.fetch_delta(spark, name, win, sec, order, "m")
    assert "dynamicpruning" in fetched._jdf.queryExecution().executedPlan().toString()
    # files of the days no window reaches are made unreadable: whoever opens one fails
    for f in TB.read_table(spark, name).inputFiles():
        if not any(f"_day=2024-01-0{d}/" in f for d in (3, 4, 5)):
            with open(f.removeprefix("file://").removeprefix("file:"), "wb") as fh:
                fh.write(b"not parquet")
    assert sorted((r.id, r.v) for r in fetched.collect()) == [(40, 1), (51, 2)]


def test_fetch_of_open_windows_reads_all_days(spark):
    name = TB.fresh_name("t_open")
    TB.append_delta(spark, day_rows(spark, [(d, "a", d, 12, 1) for d in range(1, 5)]), name, ["id"], "at")
    markets = rows(spark, [("a",), ("z",)], "m string")
    win = plan_trade_windows(markets, None, "full_history", 0, key="m")
    sec = F.unix_seconds(F.col("at").cast("timestamp"))
    assert TB.fetch_delta(spark, name, win, sec, [("v", "desc_nulls_last")], "m").count() == 4
    half = rows(spark, [("a", None, int(dt.datetime(2024, 1, 2, 23, tzinfo=dt.timezone.utc).timestamp()))], "m string, min_ts long, max_ts long")
    assert TB.fetch_delta(spark, name, half, sec, [("v", "desc_nulls_last")], "m").count() == 2


def test_recent_trades_of_hot_and_cold_markets(spark):
    base = dt.datetime(2024, 1, 1)
    data = [(i, "hot", base + dt.timedelta(seconds=i % 4000)) for i in range(6000)]          # many to a slice, with ties
    data += [(10_000 + i, "slow", base + dt.timedelta(hours=7 * i)) for i in range(50)]      # a print now and then
    data += [(20_000 + i, "few", base + dt.timedelta(minutes=i)) for i in range(3)] + [(30_000, "few", None), (30_001, None, base)]
    t = rows(spark, data, "trade_id long, market_id string, trade_time timestamp_ntz")
    for n in (1, 20, 1000):
        got = {}
        for r in recent_trades(t, n).collect():
            got.setdefault(r.market_id, set()).add(r.trade_id)
        for m in ("hot", "slow", "few"):
            own = sorted((x for x in data if x[1] == m), key=lambda x: (x[2] or dt.datetime.min, x[0]), reverse=True)[:n]
            assert got[m] == {x[0] for x in own}


def test_windows_from_settings(spark):
    markets = rows(spark, [("a",)], "market_ticker string")
    one = lambda settings: [tuple(r) for r in windows_from_settings(markets, None, settings, 100_000)[0].collect()]
    assert one({}) == [("a", True, 100_000 - 86_400, 100_000)]
    assert one({"TRADE_LOOKBACK_HOURS": "0.5", "TRADE_MODE": "incremental"}) == [("a", True, 98_200, 100_000)]
    assert one({"TRADE_MODE": "backfill", "TRADE_MIN_TS": "5", "TRADE_MAX_TS": "9"}) == [("a", True, 5, 9)]
    assert windows_from_settings(markets, None, {}, 1)[1] and not windows_from_settings(markets, None, {"TRADE_MODE": "full_history"}, 1)[1]
    assert not windows_from_settings(markets, None, {"WRITE_TRADE_STATE": "off"}, 1)[1]
    for bad in ({"TRADE_MODE": "sometimes"}, {"TRADE_LOOKBACK_HOURS": "soon"}, {"TRADE_OVERLAP_SECONDS": "1.5"}, {"TRADE_OVERLAP_SECONDS": "-1"},
                {"TRADE_MIN_TS": "5"}, {"WRITE_TRADE_STATE": "maybe"}, {"TRADE_MODE": "backfill", "TRADE_MIN_TS": "9", "TRADE_MAX_TS": "5"}):
        with pytest.raises(ValueError):
            windows_from_settings(markets, None, bad, 1)
