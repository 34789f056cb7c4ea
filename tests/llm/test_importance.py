import hashlib
import math
import random
import re
import zlib

from marketlake.llm.common import ready
from marketlake.llm.importance import collapsed, feature_buckets, importance_resample

from tests.llm.helpers import awkward, docs, rows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, ngrams, buckets):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i:i + n]) for n in range(1, ngrams + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % buckets for g in grams]


def brute(rows, target, ngrams, buckets, seed, percent, least):
    own = [features(t, ngrams, buckets) for _, t in rows]
    want = [b for t in target for b in features(t, ngrams, buckets)[1]]
    corpus = [b for _, f in own for b in f]
    s, t = [0] * buckets, [0] * buckets
    for b in corpus:
        s[b] += 1
    for b in want:
        t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (len(corpus) + buckets) / ((s[b] + 1) * (len(want) + buckets)))) for b in range(buckets)]
    out = []
    for (i, _), (n, f) in zip(rows, own):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    ranks = {}
    for k, r in enumerate(able[:percent * len(able) // 100], 1):
        ranks.setdefault(tuple(r[:4]), []).append(k)
    return sorted(((*r[:4], (ranks.get(tuple(r[:4])) or [None]).pop(0) if r[4] >= least and ranks.get(tuple(r[:4])) else None) for r in out), key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in rows_of(df)), key=str)


def test_overlapped_scan_gives_every_run_of_words():
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice(["a", "B", "word", "é", "日本", " ", "  ", "\t", "-", "9", "'", "\x00", "😀", "İ"]) for _ in range(rng.randint(0, 20)))
        n, found = feature_buckets(collapsed(text), 3, 97)
        want = features(text, 3, 97)
        assert (n, sorted(found.tolist())) == (want[0], sorted(want[1]))


def test_equals_brute_force(spark):
    ready(spark)
    rng = random.Random(2)
    rows = [(rng.choice([i, i, i, None, 7]), " ".join(rng.choice("ab cd Ef gh,ij kl-m no".split()) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    target = ["ab gh ij", "no no", None, ""]
    for ngrams, buckets, percent, least in ((1, 50, 10, 20), (2, 70_000, 100, 0), (3, 11, 33, 5)):
        frame = docs(spark, rows).repartition(5)
        bench = spark.createDataFrame([(t,) for t in target], "text string")
        out = importance_resample(frame, bench, ngrams=ngrams, buckets=buckets, percent=percent, least_words=least, seed=3)
        assert got(out) == brute(rows, target, ngrams, buckets, 3, percent, least)


def test_awkward_rows_empty_tables_and_ties(spark):
    ready(spark)
    frame = awkward(spark)
    bench = spark.createDataFrame([("the cat",)], "text string")
    out = rows_of(importance_resample(frame, bench, percent=100, least_words=1))
    assert len(out) == frame.count()
    assert sorted(r["rank"] for r in out if r["rank"]) == list(range(1, sum(r["n_features"] > 0 for r in out) + 1))
    assert all(r["weight"] == 0 and r["rank"] is None for r in out if r["n_features"] == 0)
    assert importance_resample(frame.limit(0), bench).count() == 0
    assert importance_resample(frame, bench.limit(0)).count() == frame.count()
    # equal scores: one id, one text, many rows; ranks are still 1, 2, 3 ...
    same = docs(spark, [(1, "word " * 30)] * 200).repartition(4)
    assert sorted(r["rank"] for r in rows_of(importance_resample(same, bench)) if r["rank"]) == list(range(1, 21))
