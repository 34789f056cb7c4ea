import random

from marketlake.llm.common import ready
from marketlake.llm.substrings import SuffixAutomaton, remove_repeats, spans_above

from tests.llm.helpers import awkward, docs, rows_of


def brute(rows, size):
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - size + 1):
            window = tuple(words[s:s + size])
            if window in seen:
                gone[s:s + size] = [True] * size
            seen.add(window)
        out.append((i, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in rows_of(df)), key=str)


def test_automaton_matches_as_all_substrings_do():
    rng = random.Random(1)
    for _ in range(400):
        passages = [[rng.randint(0, 2) for _ in range(rng.randint(1, 9))] for _ in range(rng.randint(1, 4))]
        own = SuffixAutomaton()
        for p in passages:
            own.add(p)
        inside = {tuple(p[i:j]) for p in passages for i in range(len(p)) for j in range(i, len(p) + 1)}
        text = [rng.randint(-1, 2) for _ in range(12)]
        want = [max(n for n in range(e + 1) if tuple(text[e - n:e]) in inside) for e in range(1, 13)]
        assert own.matched(text) == want
        covered = {k for e, n in enumerate(want, 1) if n >= 3 for k in range(e - n, e)}
        spans = spans_above(want, 3)
        assert covered == {k for a, z in spans for k in range(a, z)}
        assert all(z < b for (_, z), (b, _) in zip(spans, spans[1:]))


def test_equals_brute_force(spark):
    ready(spark)
    for seed in range(3):
        rng = random.Random(seed)
        known = [[rng.choice("abcdef") for _ in range(rng.randint(0, 30))] for _ in range(8)]
        rows = []
        for i in range(80):
            text = []
            for _ in range(rng.randint(0, 4)):
                text += rng.choice(known)[rng.randint(0, 5):] if rng.random() < .7 else [rng.choice("abcdefgh") for _ in range(rng.randint(0, 9))]
            rows.append((i, None if rng.random() < .05 else rng.choice([" ", "\n", " \t"]).join(text)))
        # small parts, blocks, shards and groups, so that passages cross all of them
        out = remove_repeats(docs(spark, rows).repartition(3), words=6, run=3, shard_bits=3, stream_words=10, part_bytes=200, block_bytes=100)
        assert got(out) == brute(rows, 6)


def test_hot_line_and_hot_passage(spark):
    ready(spark)
    rng = random.Random(9)
    line, passage = " ".join(f"l{i}" for i in range(13)), " ".join(f"p{i}" for i in range(40))
    own = lambda n: " ".join(str(rng.randrange(10 ** 9)) for _ in range(n))
    rows = [(i, f"{own(25)} {line if i % 3 else passage} {own(25)}") for i in range(200)]
    out = got(remove_repeats(docs(spark, rows).repartition(4), part_bytes=4000, block_bytes=1000, stream_words=500))
    assert out == brute(rows, 20)
    # a line of 13 words is in no repeated window, the passage stays once
    assert sum(r[2] for r in out) == 40 * (len([i for i in range(200) if i % 3 == 0]) - 1)


def test_awkward_rows(spark):
    ready(spark)
    frame = awkward(spark)
    out = rows_of(remove_repeats(frame))
    assert sorted((r["doc_id"] is None, r["n_words"]) for r in out) == sorted((r["doc_id"] is None, len((r["text"] or "").split())) for r in frame.collect())
    long = next(r for r in out if r["doc_id"] == 7)  # six words over and over: all but the first of each window repeat
    assert long["n_words"] == 24_000 and long["n_removed"] == 24_000 - 6
    assert next(r for r in out if r["doc_id"] == 3)["n_removed"] == 0
    assert remove_repeats(frame.limit(0)).count() == 0


def test_repeated_and_null_ids_keep_one_copy(spark):
    ready(spark)
    text = " ".join(f"w{i}" for i in range(30))
    out = rows_of(remove_repeats(docs(spark, [(None, text), (None, text), (5, text), (5, text)])))
    assert sorted((r["doc_id"] is None, r["n_removed"]) for r in out) == [(False, 0), (False, 30), (True, 30), (True, 30)]
