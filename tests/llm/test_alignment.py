import random
from collections import Counter
from hashlib import sha256

import numpy as np

from marketlake.llm.alignment import align_tokens, aligned, alignment_table, cut_points, group_texts, loaded, overlaps
from marketlake.llm.common import ready

from tests.llm.helpers import awkward, docs, rows_of

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
ODD = ["a", "b", "the", " ", "  ", "\n", "\t", "'s", "don't", ".", ",", "1", "23", "é", "日本", "😀", "▁", "<s>", "<|endoftext|>", "<0x41>", " ",
       "\u0085", "​", "ﬁ", "\x1c", "İ", "hello", "World", "\r", "᠎", "　", "x" * 70]


def tokens(text):
    """Both tokenizers over the whole text, as the libraries give them."""
    a, b = loaded(A)[0], loaded(B)[0]
    if not text:
        return [], []
    x, y = a.tokenizer.encode(" " + text, add_special_tokens=False).ids, b.model.encode(text)
    want = b" " + text.encode()
    if b"".join(a.spelt[i] for i in x) != want or b"".join(b.spelt[i] for i in y) != want:
        return [], []
    return x, y


def groups(x, y):
    def ends(ids, spelt):
        return {int(e): n for n, e in enumerate(np.cumsum([len(spelt[i]) for i in ids]), 1)}
    ea, eb = ends(x, loaded(A)[0].spelt), ends(y, loaded(B)[0].spelt)
    out, i, j = [], 0, 0
    for e in sorted(set(ea) & set(eb)):
        out.append((x[i:ea[e]], y[j:eb[e]]))
        i, j = ea[e], eb[e]
    return out


def text_of(found):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in found)


def test_pieces_of_the_merge_find_every_overlap_once():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = rng.integers(1, 40)
        at_a, at_b = rng.random(n) < .4, rng.random(n) < .4
        at_a[-1] = at_b[-1] = True
        ea, eb = np.flatnonzero(at_a) + 1, np.flatnonzero(at_b) + 1
        sa, sb = np.append(0, ea[:-1]), np.append(0, eb[:-1])
        want = [(i, j) for i in range(len(ea)) for j in range(len(eb)) if sa[i] < eb[j] and sb[j] < ea[i]]
        for piece in (1, 2, 3, 5, 100):
            i, j, together = overlaps(ea, eb, piece)
            assert list(zip(i.tolist(), j.tolist())) == want
            assert together.tolist() == [ea[a] == eb[b] for a, b in want]


def test_diagonals_deal_equal_work():
    ea, eb = np.arange(1, 1001) * 3, np.arange(1, 3001)
    i, j = cut_points(ea, eb, np.arange(0, 4001, 250))
    assert (np.diff(i + j) == 250).all()
    for a, b in zip(i, j):  # what lies before a diagonal is not above what lies behind it
        assert a == 0 or b == len(eb) or ea[a - 1] <= eb[b]
        assert b == 0 or a == len(ea) or eb[b - 1] < ea[a]


def test_random_texts_align_as_whole_texts_do():
    rng = random.Random(3)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    found = aligned(texts, A, B, piece=7)
    at_a, at_b = (np.append(0, np.cumsum(found[n])) for n in ("n_a", "n_b"))
    for k, (text, own) in enumerate(zip(texts, group_texts(found, A, B))):
        x, y = tokens(text)
        assert found["ids_a"][at_a[k]:at_a[k + 1]].tolist() == x and found["ids_b"][at_b[k]:at_b[k + 1]].tolist() == y
        assert own == text_of(groups(x, y))


def brute(rows):
    per = [(i, *tokens(t)) for i, t in rows]
    links = [[(a[-1], b[-1]) for a, b in groups(x, y)] for _, x, y in per]
    count = Counter(p for own in links for p in own)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for (i, x, y), own in zip(per, links):
        text = text_of(groups(x, y))
        out.append((i, len(x), len(y), len(own), len(own), sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own),
                    sha256(text.encode()).hexdigest() if x else ""))
    return sorted(out, key=str)


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_counts_over_all_documents(spark):
    ready(spark)
    rng = random.Random(4)
    rows = [(rng.choice([i, i, None, 3]), rng.choice([None, "", "".join(rng.choice(ODD) for _ in range(30))] + [" ".join(rng.choice(["the", "of", "and", "naïve", "日本"]) for _ in range(20))] * 3))
            for i in range(150)]
    out = alignment_table(docs(spark, rows).repartition(5), piece=5, chars=200, part_bytes=400)
    assert sorted((tuple(r[n] for n in NAMES) for r in rows_of(out)), key=str) == brute(rows)


def test_groups_as_arrays(spark):
    ready(spark)
    rows = [(1, "don't stop, naïve 日本"), (2, None), (3, "a▁b")]
    out = {r["doc_id"]: r for r in rows_of(align_tokens(docs(spark, rows)))}
    assert out[2]["a_ids"] == out[2]["a_end"] == out[3]["b_ids"] == []
    x, y = tokens(rows[0][1])
    assert (out[1]["a_ids"], out[1]["b_ids"]) == (x, y)
    want = groups(x, y)
    assert out[1]["a_end"] == np.cumsum([len(a) for a, _ in want]).tolist() and out[1]["b_end"] == np.cumsum([len(b) for _, b in want]).tolist()


def test_awkward_rows(spark):
    ready(spark)
    frame = awkward(spark)
    out = rows_of(alignment_table(frame))
    assert sorted((tuple(r[n] for n in NAMES) for r in out), key=str) == brute([(r["doc_id"], r["text"]) for r in frame.collect()])
    assert alignment_table(frame.limit(0)).count() == 0


def test_words_learnt_together_have_the_ids_of_words_learnt_alone(monkeypatch):
    from marketlake.llm import alignment

    words = [w + m for w in ("plain", "Ünïcode", "日本語", "x" * 70, "3.14", "a\tb", "it's", "<|endoftext|>", "\nnext", "é", "🙂🙂") for m in ("", ".", ",", "!?")]
    made, calls = [], []
    encode = alignment.ByteTokens.encode
    monkeypatch.setattr(alignment.ByteTokens, "encode", lambda self, texts: calls.append(len(texts)) or encode(self, texts))
    for units in (1, 5, 100):
        monkeypatch.setattr(alignment, "UNITS", units)
        e = alignment.Encoder("byte_bpe_50k.json", "piece_bpe_32k.model")
        assert e.by_words
        calls.clear()
        e._learn(words)
        made.append((e.memo_a, e.memo_b, e.bad))
    assert made[0] == made[1] == made[2] and calls[0] == 1
