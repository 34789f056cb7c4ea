import re

import numpy as np
import xxhash

from marketlake.llm.simhash import near_links, simhash, simhash_near_duplicates
from tests.llm.helpers import awkward, docs, rows_of


def brute_hash(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(hashes):
    root = list(range(len(hashes)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(hashes)):
        for j in range(i):
            if bin(hashes[i] ^ hashes[j]).count("1") <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(hashes))]


def test_fingerprints_by_brute_force():
    for text in ("", None, "One", "a b c", "A b C d", "a b c d e a b c d", "Ä É x\x0by\x1cz w q", "the cat sat on the mat " * 300):
        assert simhash(text or "") == brute_hash(text)


def test_links_of_all_pairs_with_hot_keys(spark):
    rnd = np.random.default_rng(4)
    far = rnd.integers(0, 1 << 64, 150, dtype=np.uint64).tolist()
    near = [int(far[0])]
    for _ in range(120):  # a group that drifts away from its first member, few bits at a time
        near.append(int(near[rnd.integers(len(near))]) ^ sum(1 << int(b) for b in rnd.choice(64, rnd.integers(1, 5), replace=False)))
    fps = sorted({*map(int, far), *near, 0, (1 << 64) - 1})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    at = {s: i for i, s in enumerate(signed)}
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    links = [(at[r.a], at[r.b]) for r in near_links(df, 4, cell_rows=8).collect()]
    assert all(bin(fps[a] ^ fps[b]).count("1") <= 64 for a, b in links)
    root = list(range(len(fps)))
    find = lambda i: i if root[i] == i else find(root[i])
    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(fps))] == brute_components(fps)


def test_awkward_documents(spark):
    got = rows_of(simhash_near_duplicates(awkward(spark)))
    source = rows_of(awkward(spark))
    hashes = [brute_hash(r["text"]) for r in source]
    want, roots = [], brute_components(hashes)
    for r, h, root in zip(source, hashes, roots):
        ids = [s["doc_id"] for s, q in zip(source, roots) if q == root and s["doc_id"] is not None]
        want.append((r["doc_id"], f"{h:016x}", min(ids, default=None)))
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == sorted(want, key=str)


def test_no_rows(spark):
    assert simhash_near_duplicates(docs(spark, [])).count() == 0
