import random
import zlib

import numpy as np

from marketlake.llm.tokencount import count_tokens, spliced_count
from marketlake.llm.tokenfiles import open_parts, read_token_files, token_files, write_token_files
from marketlake.llm.vocab import WordCounts, WordIds, load, tokenizer_path
from marketlake.session import shared_dir
from tests.llm.helpers import awkward, docs, rows_of

ODD = ["", " ", "a  b", "\n", "İstanbul ΣΑΣ ß ÀÉ ÿ÷×", "x\u0301y é ²³ ½", "<|endoftext|> a<|endoftext|>b", "it's, THE. x.. ,", "tab\there",
       "日本 語。", "\x1c a\x1cb", "a\x85b", "end \n", " \nstart", "a\n\nb", "…", "I'll we've.", "A.B,C", "x" * 5000]


def texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    return [r.text or "" for r in rows] + ODD


def test_word_wise_ids_are_the_whole_texts(spark):
    own = texts(spark)
    path = tokenizer_path("word_bpe_49k.json")
    words = WordIds(path, "<u2")
    assert words.split
    want = [e.ids for e in load(path).encode_batch(own, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u2").tolist() for b in words.encode(own)] == want


def test_word_wise_counts_are_the_whole_texts(spark):
    own = texts(spark)
    path = tokenizer_path("byte_bpe_50k.json")
    counts = WordCounts(path)
    assert counts.split
    assert counts.count(own) == [len(e.ids) for e in load(path).encode_batch(own, add_special_tokens=False)]


def test_spliced_chunks_count_what_the_whole_text_has():
    t = load(tokenizer_path("byte_bpe_50k.json"))
    rnd = random.Random(1)
    cases = ["".join(rnd.choice(["the ", "cat", "\n", "  ", " 12", "é", "日", "<|endoftext|>", "x" * 40, ", ", "'ll "]) for _ in range(400)) for _ in range(6)]
    cases += ["y" * 3000, " " * 3000, "a b" * 900, "word " * 500]
    for text in cases:
        want = len(t.encode(text, add_special_tokens=False))
        for chunk, overlap in ((64, 4), (200, 16), (1000, 64)):
            assert spliced_count(text, t, chunk, overlap) == want


def test_text_without_cuts_is_not_encoded_over_and_over():
    t, seen = load(tokenizer_path("byte_bpe_50k.json")), []

    class Counting:
        def encode(self, text, **options):
            seen.append(len(text))
            return t.encode(text, **options)

    text = "".join(random.Random(2).choices("abcé1,", k=100_000))
    assert spliced_count(text, Counting(), 500, 16) == len(t.encode(text, add_special_tokens=False))
    assert sum(seen) < 20 * len(text)


def test_count_tokens_on_awkward_documents(spark):
    t = load(tokenizer_path("byte_bpe_50k.json"))
    source = rows_of(awkward(spark))
    want = []
    for r in source:
        n = len(t.encode(r["text"] or "", add_special_tokens=False))
        want.append((r["doc_id"], len((r["text"] or "").encode()), n, n > 512))
    for chunk in (65_536, 1000):
        got = [(r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows_of(count_tokens(awkward(spark), chunk=chunk))]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert count_tokens(docs(spark, [])).count() == 0


def test_files_give_back_what_was_written(spark):
    t = load(tokenizer_path("word_bpe_49k.json"))
    source = rows_of(awkward(spark))
    folder = shared_dir(spark, "t-token-files")
    manifest = write_token_files(awkward(spark).repartition(5), folder)
    got = rows_of(read_token_files(manifest, folder, docs_at_once=2))
    ids = [(r["doc_id"], t.encode(r["text"] or "", add_special_tokens=False).ids + [1]) for r in source]
    want = [(d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in ids]
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=str) == sorted(want, key=str)
    # starts: the sequence has no gap and ascends with the ids, nulls first
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert order == sorted(order)
    # a loader that maps the parts itself finds the flat sequence
    flat = []
    for p in open_parts(spark, manifest):
        flat += np.memmap(f"{folder}/{p['name']}.ids".removeprefix("file:"), dtype=p["dtype"], mode="r").tolist()
    assert len(flat) == sum(len(i) for _, i in ids) and flat[:1] == [t.encode("no").ids[0]]


def test_no_documents_no_files(spark):
    assert token_files(docs(spark, [])).count() == 0


def test_ids_of_every_letter_and_digit_before_a_mark():
    path = tokenizer_path("word_bpe_49k.json")
    words, t = WordIds(path, "<u2"), load(path)
    alnum = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalnum()]
    own = [f"{a}{c}{m} x" for c in alnum for a in ("", "b") for m in ".,"]
    for lo in range(0, len(own), 50_000):
        part = own[lo:lo + 50_000]
        assert [np.frombuffer(b, "<u2").tolist() for b in words.encode(part)] == [e.ids for e in t.encode_batch(part, add_special_tokens=False)]


def test_ids_of_random_odd_texts_and_blobs():
    path, rng = tokenizer_path("word_bpe_49k.json"), random.Random(0)
    words, t = WordIds(path, "<u2"), load(path)
    odd = ["İ", "ﬁ", "e\u0301", "é", "Σ", ".", ",", " ", "\n", "a", "B", "9", "\u0958", "日本", "'s", "'", "\x1c", "\x85", "ǅ", "½", "²", "\u1100", "\u1161", "x\u0301", "İ.",
           "ß.", "<|endoftext|>", "ÿ,", "_", "-", "Q" * 90 + "."]
    own = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 9))) for _ in range(30_000)]
    assert [np.frombuffer(b, "<u2").tolist() for b in words.encode(own)] == [e.ids for e in t.encode_batch(own, add_special_tokens=False)]
    assert max(map(len, words.memo)) <= 64


def test_one_id_for_a_third_of_the_rows(spark):
    rows = [(None, f"text {i % 40}") for i in range(300)] + [(5, f"word {i % 7}") for i in range(300)] + [(i, "other") for i in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        seen = []
        for n in (2, 7):
            folder = shared_dir(spark, "t-hot-id")
            manifest = write_token_files(docs(spark, rows).repartition(n), folder)
            parts = open_parts(spark, manifest)
            assert max(p["n_docs"] for p in parts) < 400
            got = sorted(rows_of(read_token_files(manifest, folder)), key=lambda r: r["start"])
            assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
            seen.append([tuple(r.values()) for r in got])
        assert seen[0] == seen[1] and len(seen[0]) == 900
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
