import zlib

import numpy as np

from marketlake.llm import langid
from marketlake.llm.langid import codewords, grams, identify_languages, pieces
from tests.llm.helpers import awkward, docs, rows_of


def test_codewords_keep_their_distance():
    for k in (1, 2, 4, 7, 30):
        code = codewords(k)
        for a in range(k):
            for b in range(a):
                assert (code[a] != code[b]).sum() == code.shape[1] // 2 + 1


def test_a_text_in_pieces_has_the_same_trigrams(monkeypatch):
    raw = np.frombuffer(("Ünder the sea, 12 x " * 50).encode(), dtype=np.uint8)
    whole = np.sort(grams(raw))
    monkeypatch.setattr(langid, "PIECE", 64)
    assert (np.sort(np.concatenate(list(pieces(raw)))) == whole).all()


def test_held_out_accuracy_and_contract(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r for r in rows_of(identify_languages(d))}
    truth = {r.doc_id: r.lang for r in d.collect()}
    assert set(got) == set(truth)
    tested = [i for i in got if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i in got if got[i]["held_out"]} == set(tested)
    assert sum(got[i]["lang_pred"] == truth[i] for i in tested) / len(tested) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert sum(r["ambiguous"] for r in got.values()) < 0.01 * len(got)


def test_label_source_and_id_are_no_input(spark):
    words = {"en": "the house and the garden of this", "de": "das Haus und der Garten von diesem"}
    rows = [(i, words[lang] + f" {i}", lang, "s") for i in range(40) for lang in ("en", "de")]
    rows += [(1000, words["en"], "de", "x"), (1000, words["en"], None, None), (None, words["en"], "xx", "y")]
    got = rows_of(identify_languages(docs(spark, rows)))
    same = {(r["lang_pred"], r["score"]) for r in got if r["doc_id"] in (1000, None)}
    assert len(same) == 1 and same.pop()[0] == "en"


def test_awkward_documents(spark):
    got = rows_of(identify_languages(awkward(spark)))
    assert len(got) == 9
    by = {r["doc_id"]: r for r in got}
    for i in (1, 2, 4):
        assert (by[i]["lang_pred"], by[i]["score"], by[i]["ambiguous"]) == ("und", 0.0, True)
    assert by[7]["lang_pred"] in ("en", "fr")


def test_no_labels_and_no_rows(spark):
    got = rows_of(identify_languages(docs(spark, [(1, "some text"), (2, "other")])))
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    assert identify_languages(docs(spark, [])).count() == 0
