"""Landing, scanning, team flattening, keyed and key-less loads, caches."""

import datetime as dt
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from marketlake.operators import staging as ST
from marketlake.session import shared_dir
from marketlake.sources import jsonl as J
from marketlake.sources import tables as TB
from marketlake.streaming import ingest as SI

RUN = dt.datetime(2026, 5, 14, 13, 30, 45, tzinfo=dt.timezone.utc)
# key names are the payload's (fixed values), the team is invented
TEAM = {"id": 7, "name": "Harbour City Gulls", "teamCode": "hcg", "abbreviation": "HCG", "teamName": "Gulls",
        "locationName": "Harbour City", "firstYearOfPlay": "1931", "sport": {"id": 3, "name": "Rounders"},
        "league": {"id": 12, "name": "Coast League"}, "division": {"id": 40, "name": "North"},
        "venue": {"id": 55, "name": "Pier Ground"}, "active": True}


def test_landing_path_and_envelope(spark):
    assert J.landing_path("raw", "exchange", "events", RUN) == "raw/exchange/events/ingested_date=2026-05-14"
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    r = J.envelope(df, RUN.replace(microsecond=5)).collect()[0]
    assert r.ingested_at == dt.datetime(2026, 5, 14, 13, 30, 45)
    assert json.loads(r.raw_payload) == {"id": 1, "v": "a"}


def test_flatten_team(spark):
    bad = dict(TEAM, id=8, sport="rounders")
    df = spark.createDataFrame([(json.dumps(TEAM),), (json.dumps(bad),)], "payload string")
    rows = {r.team_id: r for r in J.flatten_team(df).collect()}
    r = rows[7]
    assert (r.sport_id, r.league_name, r.venue_name, r.active) == (3, "Coast League", "Pier Ground", True)
    assert len(J.flatten_team(df).columns) == 17
    assert rows[8].sport_id is None and rows[8].league_id == 12


def test_jsonl_round_trip_with_bad_lines_and_row_numbers(spark):
    root = shared_dir(spark, "t-jsonl")
    df = spark.range(500).select(F.col("id").cast("string").alias("trade_id"), F.lit("M").alias("ticker"))
    J.land(df.repartition(3), root, "trades", RUN)
    spark.range(1).select(F.lit("{broken").alias("value")).write.mode("append").text(
        J.landing_path(root, "exchange", "trades", RUN) + "/broken")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        good, bad = J.scan_jsonl(spark, root, [("$.trade_id", "trade_id", "string"),
                                               ("$.market_ticker", "market_ticker", "string")],
                                 key_alias=("key", "$.ticker", "$.market_ticker"))
        assert good.count() == 500 and bad.count() == 1
        per = good.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.max("source_row_number").alias("m"),
                                              F.countDistinct("source_row_number").alias("k")).collect()
        assert all(r.n == r.m == r.k for r in per)
        assert good.filter(F.col("key") != "M").count() == 0
        # numbers follow the order of lines in each file, across splits
        got = {}
        for r in good.select("source_file", "source_row_number", "trade_id").collect():
            got.setdefault(r.source_file, {})[r.source_row_number] = r.trade_id
        assert len(got) >= 3
        for f, by_row in got.items():
            with open(f.removeprefix("file:")) as fh:
                ids = [json.loads(line)["trade_id"] for line in fh if line.strip()]
            assert [by_row[i] for i in range(1, len(ids) + 1)] == ids
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


ORDER = [("v", "desc_nulls_last")]


def state(spark, name):
    return {r.k: r.v for r in TB.current(spark, name).collect()}


def files(spark, name):
    """The data files of a table by partition folder."""
    out = {}
    for f in TB.read_table(spark, name).inputFiles():
        out.setdefault(f.split("/")[-2], set()).add(f)
    return out


def test_keyed_vs_unkeyed_load(spark):
    name = TB.fresh_name("t_keyed")
    b1 = spark.createDataFrame([("a", 1, ""), ("b", 1, "x")], "k string, v long, s string")
    b2 = spark.createDataFrame([("a", 2, "y")], "k string, v long, s string")
    for batch in (b1, b2, b2):      # a replay changes nothing
        TB.keyed_load(spark, batch, name, ["k"], ORDER, "b")
    assert {r.k: (r.v, r.s) for r in TB.current(spark, name).collect()} == {"a": (2, "y"), "b": (1, "x")}
    n2 = TB.fresh_name("t_append")
    for token, batch in (("b1", b1), ("b2", b2), ("b2", b2)):
        TB.keyed_load(spark, batch, n2, None, ORDER, token)
    got = TB.current(spark, n2)
    assert got.count() == 3 and got.filter(F.col("s").isNull()).count() == 1   # '' -> NULL
    wide = spark.createDataFrame([("z", 9, "w", 1.5)], "k string, v long, s string, extra double")
    TB.keyed_load(spark, wide, n2, None, ORDER, "b3")
    assert [r.extra for r in TB.current(spark, n2).filter("k = 'z'").collect()] == [1.5] and TB.current(spark, n2).count() == 4


def test_bucket_count_and_keys_are_the_tables_own(spark):
    name = TB.fresh_name("t_buckets")
    keys = [(f"k{i}", 1) for i in range(50)]
    TB.upsert(spark, spark.createDataFrame(keys, "k string, v long"), name, ["k"], ORDER, buckets=8)
    more = spark.createDataFrame([("k7", 5)], "k string, v long")
    for bad in ({"keys": ["k"], "buckets": 16}, {"keys": ["v"]}):
        with pytest.raises(ValueError):
            TB.upsert(spark, more, name, order=ORDER, **bad)
    TB.upsert(spark, more, name, ["k"], ORDER)
    assert TB.properties(spark, name)["buckets"] == "8"
    assert state(spark, name) == {**dict(keys), "k7": 5}


def test_merged_through_is_the_greatest_progress_of_all_batches(spark):
    name = TB.fresh_name("t_progress")
    one = lambda k, day: spark.createDataFrame([(k, 1, day)], "k string, v long, day string")
    for k, day in (("a", "2024-01-02"), ("b", "2024-01-05"), ("c", "2024-01-03")):   # out of order
        TB.upsert(spark, one(k, day), name, ["k"], ORDER, progress="day")
    assert state(spark, name) == {"a": 1, "b": 1, "c": 1}
    assert TB.properties(spark, name)["merged_through"] == "2024-01-05"


def test_new_and_missing_columns_of_a_batch(spark):
    name = TB.fresh_name("t_drift")
    merge = lambda rows, schema, **o: TB.upsert(spark, spark.createDataFrame(rows, schema), name, ["k"], ORDER, **o)
    merge([(f"k{i}", 1, "old") for i in range(20)], "k string, v long, s string", buckets=4)
    merge([("k1", 2, "new", 7.5)], "k string, v long, s string, x double")
    merge([("k2", 3)], "k string, v long", guard=True)
    cur = {r.k: (r.v, r.s, r.x) for r in TB.current(spark, name).collect()}
    assert len(cur) == 20
    assert (cur["k1"], cur["k2"], cur["k3"]) == ((2, "new", 7.5), (3, None, None), (1, "old", None))
    assert [(r.column_name, r.data_type, r.is_key, r.filled_rows) for r in TB.table_columns(spark, name).collect()] == [
        ("k", "string", True, 20), ("v", "bigint", False, 20), ("s", "string", False, 19), ("x", "double", False, 1)]
    assert TB.table_columns(spark, "no_such_table").count() == 0


def test_an_upsert_overwrites_the_buckets_it_touches_and_prunes_the_rest(spark):
    name = TB.fresh_name("t_touched")
    TB.upsert(spark, spark.createDataFrame([(f"k{i}", 1) for i in range(200)], "k string, v long"), name, ["k"], ORDER, buckets=8)
    first = files(spark, name)
    assert len(first) == 8 and all(len(f) == 1 for f in first.values())
    TB.upsert(spark, spark.createDataFrame([("k3", 5), ("new", 7)], "k string, v long"), name, ["k"], ORDER)
    second = files(spark, name)
    rewritten = {b for b in second if second[b] != first.get(b)}
    assert 1 <= len(rewritten) <= 2
    cur = state(spark, name)
    assert len(cur) == 201 and cur["k3"] == 5 and cur["new"] == 7 and cur["k4"] == 1


def test_a_failed_upsert_leaves_the_table_as_it_was(spark):
    name = TB.fresh_name("t_failed")
    TB.upsert(spark, spark.createDataFrame([("a", 1), ("b", 1)], "k string, v long"), name, ["k"], ORDER, buckets=2)
    broken = spark.createDataFrame([("a", 2)], "k string, v long").withColumn("v", F.expr("if(v = 2, cast(raise_error('lost') as bigint), v)"))
    with pytest.raises(Exception):
        TB.upsert(spark, broken, name, ["k"], ORDER)
    assert state(spark, name) == {"a": 1, "b": 1}


def test_delta_batches_touch_their_own_days_only(spark):
    name = TB.fresh_name("t_delta")
    rows = lambda *r: spark.createDataFrame([(i, dt.datetime(2024, 1, d, 5), v) for i, d, v in r], "id long, at timestamp_ntz, v long")
    TB.append_delta(spark, rows((1, 1, 1), (2, 2, 1), (3, 3, 1)), name, ["id"], "at")
    first = files(spark, name)
    TB.append_delta(spark, rows((2, 2, 5), (4, 3, 1)), name, ["id"], "at")
    second = files(spark, name)
    day = lambda d: f"_day=2024-01-0{d}"
    assert second[day(1)] == first[day(1)] and all(second[day(d)] > first[day(d)] for d in (2, 3))
    read = lambda **o: {r.id: r.v for r in TB.resolve_delta(spark, name, ORDER, **o).collect()}
    assert read() == {1: 1, 2: 5, 3: 1, 4: 1}
    assert read(days=("2024-01-02", "2024-01-02")) == {2: 5}
    assert TB.compact_delta(spark, name, ORDER) == ["2024-01-02", "2024-01-03"]
    third = files(spark, name)
    assert third[day(1)] == first[day(1)] and all(len(third[day(d)]) == 1 for d in (1, 2, 3))
    assert read() == {1: 1, 2: 5, 3: 1, 4: 1} and TB.compact_delta(spark, name, ORDER) == []


def test_stream_merge_after_a_lost_checkpoint(spark):
    root, now = shared_dir(spark, "t-reset"), TB.fresh_name("t_reset")
    rows = lambda r: spark.createDataFrame(r, "k string, v long")
    rows([("a", 1), ("b", 1)]).write.parquet(root + "/load/one")
    schema = rows([]).schema
    merge = lambda ck: SI.stream_merge_latest(spark, root + "/load", schema, now, root + ck, ["k"], ORDER)
    merge("/ck1")
    rows([("c", 1), ("a", 4)]).write.parquet(root + "/load/two")
    merge("/ck2")
    assert state(spark, now) == {"a": 4, "b": 1, "c": 1}


def test_stream_and_batch_scan_agree_on_good_and_bad_lines(spark):
    root = shared_dir(spark, "t-lines")
    for name, text in (("a.jsonl", '{"k": "x", "v": 1}\n[1]\n{broken'), ("b.txt", '{"market_ticker": "y", "raw_payload": "own"}\n7')):
        path = f"{root}/in/{name}".removeprefix("file:")
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(text)
    spec, alias = [("$.v", "v", "bigint")], ("key", "$.k", "$.market_ticker")
    good, bad = J.scan_jsonl(spark, root + "/in", spec, key_alias=alias)
    SI.stream_ingest(spark, root + "/in", root + "/load", root + "/ck", spec, key_alias=alias)
    read = lambda p: spark.read.option("recursiveFileLookup", "true").parquet(p)
    cols = ["key", "v", "raw_payload", "source_file", "source_row_number"]
    batch = sorted(map(tuple, good.select(*cols).collect()), key=str)
    assert batch == sorted(map(tuple, read(root + "/load").select(*cols).collect()), key=str)
    assert [(r[0], r[1], r[4]) for r in batch] == [("x", 1, 1), ("y", None, 1)] and batch[1][2] == "own"
    lost = sorted((r.value, r.source_row_number) for r in bad.collect())
    assert lost == sorted((r.value, r.source_row_number) for r in read(root + "/load_bad").collect())
    assert lost == [("7", 2), ("[1]", 2), ("{broken", 3)]


def test_landing_a_run_again_replaces_it(spark):
    root = shared_dir(spark, "t-land")
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    later = RUN + dt.timedelta(minutes=5)
    for run in (RUN, RUN, later):
        J.land(df, root, "events", run)
    good, bad = J.scan_jsonl(spark, root, [("$.k", "k", "string")])
    assert good.count() == 4 and bad.count() == 0


def _bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path.removeprefix("file:")) for f in fs)


def test_compressed_landing_is_small_and_reads_the_same_without_a_shuffle_of_lines(spark):
    plain, packed = shared_dir(spark, "t-plain"), shared_dir(spark, "t-packed")
    text = F.concat(F.lit("some value of the row "), F.col("id") % 97)
    df = spark.range(5000).select(F.col("id").alias("k"), *[text.alias(f"a_column_with_a_long_name_{i}") for i in range(12)])
    J.land(df.coalesce(1), plain, "rows", RUN)
    J.land(df.coalesce(1), packed, "rows", RUN, compression="gzip", rows_per_file=1000)
    assert _bytes(packed) < _bytes(plain) / 8
    spec = [("$.k", "k", "bigint"), ("$.a_column_with_a_long_name_3", "v", "string")]
    good, bad = J.scan_jsonl(spark, packed, spec)
    assert good.select("k", "v").exceptAll(J.scan_jsonl(spark, plain, spec)[0].select("k", "v")).isEmpty() and bad.isEmpty()
    per = good.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.max("source_row_number").alias("m"), F.countDistinct("source_row_number").alias("d")).collect()
    assert len(per) == 5 and all(r.n == r.m == r.d == 1000 for r in per)
    assert "SortMergeJoin" not in good._jdf.queryExecution().executedPlan().toString()


def test_a_landing_run_lands_compressed(spark):
    root = shared_dir(spark, "t-run")
    counts = J.land_run({"a": spark.range(7).select(F.col("id").alias("k")), "b": spark.range(0).select(F.col("id").alias("k"))}, root, RUN, compression="gzip")
    assert {r.entity: r.rows_written for r in counts.collect()} == {"a": 7, "b": 0}
    landed = [f for d, _, fs in os.walk(root.removeprefix("file:") + "/exchange/a") for f in fs if f.startswith("part-")]
    assert landed and all(f.endswith(".json.gz") for f in landed)


def test_a_guarded_upsert_shuffles_once_and_deals_large_buckets(spark, monkeypatch):
    name, seen = TB.fresh_name("t_once"), []
    latest = TB.latest_per_key
    monkeypatch.setattr(TB, "latest_per_key", lambda *a, **o: seen.append(latest(*a, **o)) or seen[-1])
    rows = lambda v, lo, hi: spark.range(lo, hi).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(v).alias("v"))
    merge = lambda df, **o: TB.upsert(spark, df, name, ["k"], ORDER, guard=True, rows_per_task=50, **o)
    merge(rows(2, 0, 300).unionByName(rows(1, 0, 300)), buckets=2)
    merge(rows(1, 200, 400).unionByName(rows(3, 0, 10)).unionByName(spark.createDataFrame([(None, 9)], "k string, v int")))
    assert state(spark, name) == {f"k{i}": 3 if i < 10 else 2 if i < 300 else 1 for i in range(400)}
    assert TB.current(spark, name).count() == 400
    for new in seen:   # the rows are dealt once, and reduced where they lie; other exchanges hold bucket numbers
        dealt = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", new._jdf.queryExecution().executedPlan().toString())
        assert len([x for x in dealt if "_task" in x or "k#" in x]) == 1
    assert len(seen) == 2


def test_a_line_is_parsed_once_whatever_its_columns(spark):
    lines = ['{"a": 1.50, "n": "x", "j": {"z": 1, "b": [2]}, "t": "2024-01-02T00:00:00Z"}', ' \t{"A": 5, "a": "6", "n": "7", "deep": {"k": [1, 2]}}', "{}",
             '{"a": 1, "a": 2}', "[1]", "{broken", "null", None]
    df = spark.createDataFrame([(x, "f", i) for i, x in enumerate(lines)], "value string, source_file string, source_row_number long")
    spec = [("$.a", "a", "string"), ("$.a", "as_number", "double"), ("$.A", "upper", "int"), ("$.n", "n", "number"), ("$.j", "j", "json"), ("$.t", "t", "time"),
            ("$.deep.k[1]", "deep", "int"), ("$.none", "none", "array<string>")]
    good, bad = J.parse_lines(df, spec)
    rows = [tuple(r)[:8] for r in good.orderBy("source_row_number").collect()]
    assert rows == [("1.5", 1.5, None, None, '{"b":[2],"z":1}', dt.datetime(2024, 1, 2), None, None), ("6", 6.0, 5, 7, None, None, 2, None), (None,) * 8]
    assert sorted(r.source_row_number for r in bad.collect()) == [3, 4, 5, 6, 7]
    good, _ = J.parse_lines(df, [(f"$.c{i}", f"c{i}", "string") for i in range(40)])
    for plan in (good, good.select("c1"), good.filter("c1 = 'x'")):
        assert plan._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_a_stored_batch_is_merged_without_a_copy(spark, monkeypatch):
    name, left = TB.fresh_name("t_stored"), []
    drop = TB.delete
    monkeypatch.setattr(TB, "delete", lambda s, path: left.append(s.read.parquet(path)) or left[-1].count() and drop(s, path))
    for rows in ([("a", 1, "d1"), ("b", 1, "d1"), ("a", 3, "d2"), (None, 9, "d3")], [("a", 2, "d4"), ("c", 1, "d2"), ("b", 1, "d1")]):
        TB.keyed_load(spark, spark.createDataFrame(rows, "k string, v long, day string"), name, ["k"], ORDER, "b", guard=True, buckets=4, progress="day", stored=True)
    assert state(spark, name) == {"a": 3, "b": 1, "c": 1} and TB.current(spark, name).count() == 3
    assert TB.properties(spark, name)["merged_through"] == "d4"
    assert len(left) == 2 and not any({"k", "v"} & set(x.columns) for x in left)


def test_shared_folders_never_meet(spark):
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b and a.startswith(spark.sparkContext.getCheckpointDir())


def test_no_scratch_folder_off_a_local_master(spark, monkeypatch):
    from marketlake import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())


def test_pending_rows_gate_retention(spark):
    path, now = shared_dir(spark, "t-retention"), TB.fresh_name("t_retention")
    load = spark.createDataFrame([("a", 1, "2024-01-01"), ("b", 2, "2024-02-01")], "k string, v long, ingested_date string")
    load.write.partitionBy("ingested_date").parquet(path)
    assert TB.pending_rows(load, now, "ingested_date") == 2
    TB.keyed_load(spark, load.filter("k = 'a'"), now, ["k"], ORDER, "one", progress="ingested_date")
    assert TB.pending_rows(load, now, "ingested_date") == 1
    assert TB.retention_cleanup(spark, path, "2024-01-15", 1) == []
    TB.keyed_load(spark, load, now, ["k"], ORDER, "two", progress="ingested_date")
    assert TB.pending_rows(load, now, "ingested_date") == 0
    run = dt.datetime(2024, 1, 17, 3)
    assert TB.retention_cutoff(run) == "2024-01-15"
    assert TB.clean_loads(spark, {"markets": (path, now)}, "ingested_date", run) == {"markets": ["ingested_date=2024-01-01"]}


def test_flatten_records_of_nested_arrays(spark):
    docs = spark.createDataFrame([('[{"a": 1}, [{"a": 2}, 5, {"a": 3}], 7]',)], "doc string")
    got = J.flatten_records(docs, "doc").select(F.try_variant_get("record", "$.a", "bigint").alias("a"))
    assert sorted(r.a for r in got.collect()) == [1, 2, 3]


def test_cache_and_missing(spark):
    root = shared_dir(spark, "t-cache")
    df = spark.createDataFrame([("E1", 1), ("E2", 2)], "event string, x long")
    TB.cache_write(df, root, "event")
    assert TB.cache_read(spark, root, "event", ["E2"]).collect()[0].x == 2
    exp = spark.createDataFrame([("E1",), ("E2",), ("E3",)], "event string")
    assert [r.event for r in TB.cache_missing(exp, TB.cache_read(spark, root, "event"), ["event"]).collect()] == ["E3"]


def test_cache_splits_the_hot_event_by_its_size(spark):
    root = shared_dir(spark, "t-cache-hot")
    rows = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("e"), F.col("id") % 8)).alias("event"), "id")
    count = lambda e: len([f for f in os.listdir(f"{root}/event={e}".removeprefix("file:")) if f.endswith(".parquet")])
    own = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "64"}   # each salt a task
    before = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        TB.cache_write(rows, root, "event", rows_per_file=250)
        assert 5 <= count("hot") <= 8 and 1 <= count("e1") <= 2 and TB.cache_read(spark, root, "event").count() == 4000
        TB.cache_write(rows.filter("id < 100"), root, "event", rows_per_file=250)
        assert count("hot") == 1 and TB.cache_read(spark, root, "event", ["hot"]).count() == 50
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_cache_of_many_small_events_is_written_by_many_tasks(spark):
    root = shared_dir(spark, "t-cache-small")
    TB.cache_write(spark.range(600).select((F.col("id") % 300).alias("event"), "id"), root, "event", files_per_task=30)
    # a task's files carry its number
    written = [f for d, _, fs in os.walk(root.removeprefix("file:")) for f in fs if f.startswith("part-")]
    by_task = {}
    for f in written:
        by_task[f[:10]] = by_task.get(f[:10], 0) + 1
    assert len(written) == 300 and len(by_task) > 5 and max(by_task.values()) <= 60
    assert TB.cache_read(spark, root, "event").count() == 600


def test_cache_keys_that_folder_names_must_escape(spark):
    root = shared_dir(spark, "t-cache-names")
    keys = ["a/b", "c=d", "50%", "x y", "ü:*", None]
    TB.cache_write(spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "event string, x long"), root, "event")
    assert {(r.event, r.x) for r in TB.cache_read(spark, root, "event").collect()} == {(k, i) for i, k in enumerate(keys)}
    assert [r.x for r in TB.cache_read(spark, root, "event", ["a/b"]).collect()] == [0]


def _folders(root):
    return {f: sorted(os.listdir(f"{root}/{f}")) for f in os.listdir(root) if "=" in f}


def test_a_small_event_costs_one_folder_and_one_file_and_few_listing_tasks(spark):
    root = shared_dir(spark, "t-cache-cost")
    TB.cache_write(spark.range(900).select((F.col("id") % 300).alias("event"), "id"), root, "event")
    on_disk = _folders(root.removeprefix("file:"))
    assert len(on_disk) == 300 and all(len(f) == 1 for f in on_disk.values())   # no checksum file beside it
    sc, before = spark.sparkContext, spark.conf.get(TB.LISTING)
    sc.setJobGroup("t-listing", "")
    try:
        assert TB.cache_read(spark, root, "event").count() == 900
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    seen = sc.statusTracker()
    tasks = [seen.getStageInfo(s).numTasks for j in seen.getJobIdsForGroup("t-listing") for s in seen.getJobInfo(j).stageIds if seen.getStageInfo(s)]
    assert tasks and max(tasks) <= 8 * sc.defaultParallelism < 300 and spark.conf.get(TB.LISTING) == before


def test_a_cache_holds_what_sparks_writer_would(spark):
    mine, theirs = shared_dir(spark, "t-cache-types"), shared_dir(spark, "t-cache-spark")
    df = spark.range(500).select(
        F.when(F.col("id") % 9 == 0, F.lit("")).when(F.col("id") % 7 != 0, F.concat(F.lit("g%/"), F.col("id") % 5)).alias("event"), "id",
        F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("s"), (F.col("id") / 7).alias("d"), F.col("id").cast("decimal(20,4)").alias("n"),
        F.col("id").cast("string").cast("binary").alias("b"), F.col("id").cast("short").alias("h"), (F.col("id") % 2 == 0).alias("t"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id / 1000)").alias("at"), F.expr("date'2024-01-01' + cast(id as int)").alias("day"))
    TB.cache_write(df, mine, "event")
    df.write.partitionBy("event").parquet(theirs)
    a, b = (TB.cache_read(spark, x, "event") for x in (mine, theirs))
    assert a.dtypes == b.dtypes and a.count() == 500 and a.exceptAll(b).isEmpty()
    assert set(_folders(mine.removeprefix("file:"))) == set(_folders(theirs.removeprefix("file:")))
    nested = df.select("event", F.array("id").alias("ids"))    # Spark's writer takes what is no plain column
    TB.cache_write(nested, mine, "event")
    assert TB.cache_read(spark, mine, "event").exceptAll(nested.select("ids", F.nullif("event", F.lit("")))).isEmpty()


def test_a_failed_cache_write_leaves_the_cache_as_it_was(spark):
    root = shared_dir(spark, "t-cache-failed")
    rows = spark.range(40).select((F.col("id") % 4).alias("event"), "id")
    TB.cache_write(rows, root, "event")
    before = _folders(root.removeprefix("file:"))
    with pytest.raises(Exception):
        TB.cache_write(rows.withColumn("id", F.expr("if(id = 39, cast(raise_error('lost') as bigint), id)")), root, "event")
    assert _folders(root.removeprefix("file:")) == before and not [f for f in os.listdir(root.removeprefix("file:")) if f.startswith(".staged")]
    TB.cache_write(rows.filter("event = 1").withColumn("id", F.col("id") + 100), root, "event")
    after = _folders(root.removeprefix("file:"))
    assert [f for f in after if after[f] != before[f]] == ["event=1"]
    assert sorted(r.id for r in TB.cache_read(spark, root, "event", [1]).collect()) == list(range(101, 141, 4))
    assert TB.cache_read(spark, root, "event").count() == 40


def test_optional_columns_and_subtitle(spark):
    raw = spark.createDataFrame([("T", "E", "t", "A", "A", "0.12345", "x")],
                                "ticker string, event_ticker string, title string, yes_sub_title string, "
                                "no_sub_title string, last_price_dollars string, volume_fp string")
    out = ST.stg_markets(raw)
    assert len(out.columns) == 48
    r = out.collect()[0]
    assert r.market_subtitle == "A" and str(r.last_price_dollars) == "0.1235" and r.volume_fp is None
    assert dict(out.dtypes)["created_at"] == "timestamp_ntz"
    with_sub = raw.withColumn("subtitle", F.lit(None).cast("string"))
    assert ST.stg_markets(with_sub).collect()[0].market_subtitle is None   # column present: no fallback
