import numpy as np

import corpus_pipeline as CP
from marketlake.llm.simhash import simhash
from marketlake.llm.vocab import tokenizer_path
from marketlake.llm.sentencepieces import Pieces
from tests.llm.helpers import awkward, docs, rows_of
from tests.llm.test_mixing import brute_targets
from tests.llm.test_pii import brute as brute_pii
from tests.llm.test_simhash import brute_components

SF = "/root/testdata/sf0.001"


def test_every_stage_on_what_the_one_before_kept(spark):
    d, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    source = rows_of(d)
    for name, stage in CP.STAGES:
        d = CP.stored(stage(spark, d, SF), "t-stage")
        seen.append(rows_of(d))
        if name != CP.STAGES[-1][0]:
            assert d.columns == CP.COLUMNS
    told, once, clean, mixed, last = seen
    # 1: clean documents stay, with their language
    truth = {r["doc_id"]: r["lang"] for r in source}
    assert len(told) >= 0.98 * sum(any(map(str.isalpha, r["text"] or "")) for r in source)
    assert sum(r["lang"] == truth[r["doc_id"]] for r in told) >= 0.98 * len(told)
    # 2: the least id of every group
    told.sort(key=lambda r: r["doc_id"])
    roots = brute_components([simhash(r["text"] or "") for r in told])
    assert sorted(r["doc_id"] for r in once) == [told[i]["doc_id"] for i in sorted(set(roots))]
    # 3: nothing personal is left, other texts are as they were
    before = {r["doc_id"]: r["text"] for r in once}
    assert sorted(before) == sorted(r["doc_id"] for r in clean)
    for r in clean:
        assert not brute_pii(r["text"]) and r["n_chars"] == len(r["text"])
        if not brute_pii(before[r["doc_id"]]):
            assert r["text"] == before[r["doc_id"]] or "[" in r["text"]
    # 4: copies as the mix takes them
    from marketlake.llm.mixing import mix_sources
    want = sorted(x["doc_id"] for x in rows_of(mix_sources(docs(spark, [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in clean])))
                  for _ in range(x["copies"]))
    assert sorted(r["doc_id"] for r in mixed) == want
    # 5: the ids decode to the text
    p = Pieces.load(tokenizer_path("piece_bpe_32k.model"))
    text = {r["doc_id"]: r["text"] for r in clean}
    assert len(last) == len(mixed)
    for r in last:
        assert r["text"] == text[r["doc_id"]] == p.decode(np.array(r["ids"])) and r["n_pieces"] == len(r["ids"])


def test_stages_on_awkward_and_empty_documents(spark):
    for rows in (awkward(spark), docs(spark, [])):
        for _, stage in CP.STAGES:
            stage(spark, rows, SF).collect()
    kept = rows_of(CP.one_of_each(spark, awkward(spark), SF))
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "3", "5", "6", "7", "None"]
    n = CP.without_personal_data(spark, awkward(spark), SF).count()
    assert n == 9


def prose(seed, n=60):
    rnd = np.random.default_rng(seed)
    return " ".join(f"w{k}" for k in rnd.integers(0, 5000, n))


def test_every_group_keeps_one_row_whatever_its_ids(spark):
    a, b, c, d, e, f = map(prose, range(6))
    rows = [(None, a), (None, b), (None, b), (5, c), (None, c), (None, d), (3, e), (3, f), (1, f), (8, f), (8, f), (None, None), (2, "")]
    got = sorted(((r["doc_id"], r["text"]) for r in rows_of(CP.one_of_each(spark, docs(spark, rows), SF))), key=str)
    assert got == sorted([(None, a), (None, b), (5, c), (None, d), (3, e), (1, f), (2, "")], key=str)


def test_a_repeated_least_id_keeps_the_least_text(spark):
    a = prose(1, 400)
    rows = [(4, a + " z"), (4, a + " b"), (None, a), (9, a)]
    assert [r["text"] for r in rows_of(CP.one_of_each(spark, docs(spark, rows), SF))] == [a + " b"]


def test_rows_without_or_with_one_id_take_their_own_copies(spark):
    rnd = np.random.default_rng(9)
    rows = [(None if k % 2 else 5, f"{k:03d} " + prose(k, int(rnd.integers(1, 90))), "en", "abc"[k % 3]) for k in range(90)]
    got = rows_of(CP.mixed(spark, docs(spark, rows), SF))
    size = {r[1]: len(r[1].split()) for r in rows}
    per = {s: sum(size[r[1]] for r in rows if r[3] == s) for s in "abc"}
    for s, want in brute_targets(per).items():
        taken = sum(size[r["text"]] for r in got if r["source"] == s)
        assert abs(taken - want) <= max(size[r[1]] for r in rows if r[3] == s)
    source = {r[1]: (r[0], r[3]) for r in rows}
    assert all(source[r["text"]] == (r["doc_id"], r["source"]) for r in got)


def test_run_is_the_stages(spark):
    got = rows_of(CP.run(spark, SF).select("doc_id", "n_pieces"))
    assert got
