import random
import zlib
from hashlib import sha256

import numpy as np

from marketlake.llm.sentencepieces import DoubleArray, Pieces, encode_pieces, piece_digests
from marketlake.llm.vocab import tokenizer_path
from tests.llm.helpers import awkward, docs, rows_of


def test_the_double_array_finds_every_key_and_no_other():
    rnd = random.Random(1)
    keys = {bytes(rnd.choice(b"ab\xc3\xa9\xff") for _ in range(rnd.randint(1, 6))): i for i in range(400)}
    trie = DoubleArray.build({k: i for i, k in enumerate(keys)})
    text = bytes(rnd.choice(b"ab\xc3\xa9\xffz") for _ in range(600)) + b"\0"
    found = {(int(a), n, int(i)) for at, n, ids in trie.matches(np.frombuffer(text, np.uint8).astype(np.int64), np.arange(len(text) - 1))
             for a, i in zip(at, ids)}
    want = {(a, n, i) for i, k in enumerate(keys) for n in [len(k)] for a in range(len(text) - 1) if text[a:a + n] == k}
    assert found == want


def brute(pieces, scores, unk, word):
    """The best score of any segmentation, character by character."""
    best = [0.0] + [float("-inf")] * len(word)
    for i in range(len(word)):
        for j in range(i + 1, len(word) + 1):
            s = scores.get(word[i:j], unk if j == i + 1 else None)
            if s is not None:
                best[j] = max(best[j], best[i] + s)
    return best[-1]


def small():
    rnd = random.Random(2)
    own = ["▁", "a", "b", "c", "é", "▁a", "▁ab", "abc", "ca", "bca", "cé", "aa", "aaa"]
    pieces = [("<unk>", 0.0)] + [(f"<0x{b:02X}>", 0.0) for b in range(256)] + [(p, -rnd.randint(1, 9) - 1.5 * rnd.random()) for p in own]
    return Pieces.make(pieces, set(range(257)), {1 + b: b for b in range(256)}, 0), dict(pieces[257:])


def test_viterbi_by_brute_force():
    p, scores = small()
    rnd = random.Random(3)
    words = ["".join(rnd.choice("▁abcéxz日") for _ in range(n)) for n in [*range(1, 14)] * 20] + ["a" * 700, "abcé" * 200]
    for word, ids in zip(words, p.viterbi([w.encode() for w in words])):
        unknown = [c for c in word if c not in scores]
        got = sum(p.scores[i] for i in ids if i > 256) + p.unk_score * len(unknown)
        assert abs(got - brute(p, scores, p.unk_score, word)) < 1e-6
        assert b"".join(p.surface[i] for i in ids).decode() == word


def test_units_are_as_good_as_the_whole_text():
    p = Pieces.load(tokenizer_path("piece_bpe_32k.model"))
    rnd = random.Random(4)
    for _ in range(30):
        text = "".join(rnd.choice(["the ", "house", " ", "\n", "é", "12", "  ", "日本", "tion", "x", "😀", "."]) for _ in range(30))
        whole = p.viterbi([("▁" + text.replace(" ", "▁")).encode()])[0]
        ids = np.frombuffer(p.encode([text])[0], p.dtype)
        assert ids.tolist() == whole.tolist() and p.decode(ids) == text


def test_never_worse_than_the_librarys_unigram_mode(spark):
    """The library's own unigram mode over the same pieces, on lines without unknown characters (beside those its
    32-bit sums lose the other scores): its segmentation never has a greater sum of scores."""
    import pytest
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece
    path = tokenizer_path("piece_bpe_32k.model")
    m = proto.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    lib = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    p = Pieces.load(path)
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    lines = [line[:400] for r in rows for line in (r.text or "").split("\n")[:4]]
    unknown = set(p.byte_ids.tolist())
    lines = [x for x in lines if x and not unknown & set(lib.encode(x))]
    assert len(lines) > 300
    for line, ids in zip(lines, p.encode(lines)):
        own = np.frombuffer(ids, p.dtype)
        assert p.decode(own) == line and p.scores[own].sum() >= p.scores[lib.encode(line)].sum(), line


def test_documents_round_trip(spark):
    source = rows_of(awkward(spark))
    got = rows_of(encode_pieces(awkward(spark), ["doc_id"]))
    assert len(got) == len(source)
    want = sorted((str(r["doc_id"]), (r["text"] or "").replace("▁", " ")) for r in source)
    assert sorted((str(r["doc_id"]), r["decoded"]) for r in got) == want
    digests = {r["doc_id"]: r for r in rows_of(piece_digests(awkward(spark)))}
    for r in got:
        d = digests[r["doc_id"]]
        assert d["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and d["n_pieces"] == len(r["ids"])
        assert d["decoded_sha256"] == sha256(r["decoded"].encode()).hexdigest()
    assert {i for i in digests if not digests[i]["round_trip"]} == {5}
    assert digests[1]["n_pieces"] == 0
    assert piece_digests(docs(spark, [])).count() == 0
