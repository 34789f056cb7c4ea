import random
from collections import defaultdict

import numpy as np

from marketlake.llm.mixing import HEAVY, mix_sources, pivot_round, pool_round, sizes, targets
from tests.llm.helpers import awkward, docs, rows_of


def brute_targets(per):
    """Share by weight, stop at three times the size, share the excess again until none is above."""
    names = sorted(per, key=lambda s: (s is None, s))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    out, left, open_ = {}, float(sum(per.values())), set(names)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * per[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = 3.0 * per[s]
            left -= out[s]
        open_ -= over
    return out


def test_targets_by_brute_force(spark):
    rnd = random.Random(3)
    for _ in range(3):
        per = {rnd.choice(["a", "B", "é", "z", "src1", "src10", "src2", ""]) + str(k): rnd.choice([0, 1, 5, 50, 4000]) for k in range(7)} | {None: 9}
        df = spark.createDataFrame([(s, n) for s, n in per.items()], "source string, size long")
        got = {r.source: r.target for r in targets(df).collect()}
        want = brute_targets(per)
        assert set(got) == set(want) and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_rounding_keeps_words_and_chances():
    rng = np.random.default_rng(1)
    size, p = rng.integers(1, 100, 50).astype(float), rng.random(50)
    mean = np.zeros(50)
    for _ in range(4000):
        q = pivot_round(p, size, rng)
        rest = (q > 1e-9) & (q < 1 - 1e-9)
        assert rest.sum() <= 1 and abs((q * size).sum() - (p * size).sum()) < 1e-6
        mean += q / 4000
    assert np.abs(mean - p).max() < 0.04


def test_whole_mix_in_small_groups(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = rows_of(mix_sources(d, group_rows=8, fan_in=3))
    text = {r.doc_id: (r.text, r.source) for r in d.collect()}
    assert sorted(r["doc_id"] for r in got) == sorted(text)
    per, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        t, s = text[r["doc_id"]]
        assert r["size"] == len((t or "").encode().split())
        per[s] += r["size"]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
        assert r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= 3
    want = brute_targets(dict(per))
    for r in got:
        s = text[r["doc_id"]][1]
        assert r["source_size"] == per[s] and abs(r["target"] - want[s]) < 1e-6
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in per)
    again = rows_of(mix_sources(d.repartition(7), group_rows=8, fan_in=3))
    key = lambda r: r["doc_id"]
    assert sorted(again, key=key) == sorted(got, key=key)


def test_awkward_documents(spark):
    got = rows_of(mix_sources(awkward(spark), group_rows=2))
    assert len(got) == 9
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert sum(r["size"] for r in got) == sum(len((r["text"] or "").encode().split()) for r in rows_of(awkward(spark)))
    assert sizes(docs(spark, [])).count() == 0 and mix_sources(docs(spark, [])).count() == 0
    assert rows_of(mix_sources(docs(spark, [(1, " ", "en", "s")])))[0]["taken"] == 0


def test_documents_against_pools_keep_words_and_chances():
    rng = np.random.default_rng(2)
    size = rng.integers(1, 100, 400).astype(float)
    for p in (0.1, 0.5, 0.93):
        mean = np.zeros(400)
        for _ in range(3000):
            q = pool_round(p, size, rng)
            rest = (q > 1e-9) & (q < 1 - 1e-9)
            assert rest.sum() <= 1 and abs((q * size).sum() - p * size.sum()) < 1e-6 and (size[rest] <= HEAVY * p * size.sum()).all()
            mean += q / 3000
        assert np.abs(mean - p).max() < 0.05


def test_a_document_that_outweighs_the_rest_does_not_miss_the_target():
    for seed in range(20):
        rng = np.random.default_rng(seed)
        size = np.append(rng.integers(1, 50, 400).astype(float), 9000.0)
        q = pool_round(0.1, size, rng)
        assert q[-1] == 0 and abs((q * size).sum() - 0.1 * size.sum()) < 1e-6
    assert pool_round(0.3, np.array([5.0]), rng).tolist() == [0.3] and len(pool_round(0.3, np.array([]), rng)) == 0


def test_every_source_comes_near_its_target(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    source = {r.doc_id: r.source for r in d.select("doc_id", "source").collect()}
    for seed in range(20):
        taken, target = defaultdict(int), {}
        for r in rows_of(mix_sources(d, seed=seed)):
            taken[source[r["doc_id"]]] += r["taken"]
            target[source[r["doc_id"]]] = r["target"]
        assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] for s in target), seed


def test_equal_rows_and_null_ids_are_dealt_over_groups(spark):
    rows = [(None, "one two three four", "en", "a")] * 3000 + [(7, f"w{i % 50} x", "en", "a") for i in range(1000)] + [(i, "some other words", "en", "b") for i in range(100, 300)]
    total = lambda got: (sum(r["taken"] for r in got if r["doc_id"] is None), sum(r["taken"] for r in got if r["doc_id"] == 7))
    a = rows_of(mix_sources(docs(spark, rows), group_rows=100, fan_in=4))
    b = rows_of(mix_sources(docs(spark, rows).repartition(5), group_rows=100, fan_in=4))
    assert len(a) == len(rows) and total(a) == total(b)
    per = {s: sum(r["taken"] for r in a if (r["doc_id"] is None or r["doc_id"] == 7) == (s == "a")) for s in "ab"}
    want = {s: next(r["target"] for r in a if (r["doc_id"] is None or r["doc_id"] == 7) == (s == "a")) for s in "ab"}
    assert all(abs(per[s] - want[s]) <= 4 for s in "ab")
