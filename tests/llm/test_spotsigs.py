import hashlib
import random
import re

from marketlake.llm.spotsigs import (ANCHORS, COVER, length_part, next_documents, pruned_jaccard, signature_classes, spot_fingerprints, spot_pairs,
                                     spot_search, with_signatures)
from pyspark.sql import functions as F
from tests.llm.helpers import awkward, docs, rows_of


def brute_chains(text, chain=3):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    content = [(i, w) for i, w in enumerate(words) if w not in ANCHORS]
    found = [(words[i - 1], *(w for _, w in content[n:n + chain])) for n, (i, _) in enumerate(content) if i and words[i - 1] in ANCHORS]
    out = set(found)
    if len(found) * COVER < len(content):
        out = {("", *(w for _, w in content[n:n + chain])) for n in range(len(content))}
    return out or {("~", w) for w in words}


TEXTS = ["the cat sat on the mat", "of the to", "no anchor words here now", "", "The CAT, sat; on the mat!", "the", "a b the c d of e f the g h i",
         "le chat et la maison des voisins", "x", "!!! ???", "the the cat sat down quietly near"]


def test_signature_sets_by_brute_force(spark):
    df = with_signatures(spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string"), "text", "sigs")
    got = {r.i: r.sigs for r in df.collect()}
    chains = {i: brute_chains(t) for i, t in enumerate(TEXTS)}
    for i in chains:
        assert len(got[i]) == len(set(got[i])) == len(chains[i]) and got[i] == sorted(got[i])
        for j in chains:  # the hashes agree exactly where the chains do
            assert len(set(got[i]) & set(got[j])) == len(chains[i] & chains[j]), (TEXTS[i], TEXTS[j])


def like(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def check(spark, df, source):
    """Rows against a brute-force pass; ids unique in ``source`` (a null id first)."""
    order = sorted(source, key=lambda r: (r["doc_id"] is not None, r["doc_id"]))
    got = {r["doc_id"]: r for r in rows_of(spot_fingerprints(df))}
    assert len(got) == len(order)
    for r, after in zip(order, order[1:] + order[:1]):
        text, following = r["text"] or "", after["text"] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        g, mine = got[r["doc_id"]], brute_chains(text)
        assert g["n_chars"] == len(text) and g["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(g["near_edited"] - like(mine, brute_chains(edited))) < 1e-12
        assert abs(g["near_next"] - like(mine, brute_chains(following))) < 1e-12
    return got


def test_documents_by_brute_force(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id % 3 <> 1")
    got = check(spark, d, rows_of(d))
    by_text = {}
    for r in rows_of(d):
        by_text.setdefault(r["text"], set()).add(got[r["doc_id"]]["fingerprint"])
    assert all(len(f) == 1 for f in by_text.values())


def test_awkward_documents(spark):
    once = awkward(spark).dropDuplicates(["doc_id"])
    check(spark, once, rows_of(once))
    assert sum(r["doc_id"] == 3 for r in rows_of(spot_fingerprints(awkward(spark)))) == 2
    assert spot_fingerprints(docs(spark, [])).count() == 0
    alone = rows_of(spot_fingerprints(docs(spark, [(5, "the cat sat on the mat")])))[0]
    assert alone["near_next"] == 1.0


def test_next_ids_over_many_ranges(spark):
    ids = [7, -3, 100, 8, 9, 55, 2 ** 62, 0]
    df = spark.createDataFrame([(i, "x" * 9) for i in ids], "k long, text string")
    got = {r.k: (r.half, r.next) for r in next_documents(df).collect()}
    ids.sort()
    assert got == {a: (4, b) for a, b in zip(ids, ids[1:] + ids[:1])}


def test_pruning_never_drops_a_pair_that_reaches_the_threshold(spark):
    sets = [list(range(a, a + n)) for a in (0, 3) for n in (0, 1, 4, 5, 8, 10, 20)]
    rows = [(i, j, x, y) for i, x in enumerate(sets) for j, y in enumerate(sets)]
    df = spark.createDataFrame(rows, "i int, j int, a array<long>, b array<long>")
    df = df.select("a", "b", pruned_jaccard("a", "b", 0.8).alias("pruned"), pruned_jaccard("a", "b").alias("exact"),
                   F.abs(length_part(F.size("a"), 0.8) - length_part(F.size("b"), 0.8)).alias("apart"))
    for r in df.collect():
        assert abs(r.exact - like(set(r.a), set(r.b))) < 1e-12
        if r.exact >= 0.8:
            assert r.pruned == r.exact and (r.apart <= 1 or not r.a)
        else:
            assert r.pruned in (0.0, r.exact)


def test_one_accidental_anchor_does_not_stand_for_a_text(spark):
    start = "set a alpha beta gamma "
    code, prose = start + " ".join(f"x{i}=f{i * 7}" for i in range(200)), start + " ".join(f"word{i}" for i in range(300))
    got = {r["doc_id"]: r for r in rows_of(spot_fingerprints(docs(spark, [(1, code), (2, prose), (3, "the cat sat on the mat by the door")])))}
    assert got[1]["fingerprint"] != got[2]["fingerprint"] and got[1]["near_next"] < 0.1 and got[1]["near_edited"] < 0.8


def brute_search(rows, threshold):
    sets = {i: frozenset(brute_chains(t or "")) for i, t in rows}
    classes = {}
    for i, own in sets.items():
        classes.setdefault(own, []).append(i)
    n = {c: sum(like(c, d) >= threshold for d in classes if d != c) for c in classes}
    return {i: (min(classes[own], key=lambda k: (k is not None, k)), n[own]) for i, own in sets.items()}


def test_search_finds_all_pairs_of_the_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    want = brute_search(rows, 0.8)
    got = {r["doc_id"]: (r["class_id"], r["n_similar"]) for r in rows_of(spot_search(d))}
    assert got == want and sum(n for _, n in want.values()) > 0


def test_search_of_random_sets_at_several_thresholds(spark):
    rng = random.Random(4)
    base = [[f"w{rng.randrange(40)}" for _ in range(rng.randint(0, 40))] for _ in range(6)]
    rows = [(None, "one text of the words"), (1000, None), (1001, "")]
    for i in range(150):
        words = [w if rng.random() > 0.04 else "odd" for w in rng.choice(base)]
        rows.append((i, " ".join(words[rng.randint(0, 2):])))
    df = docs(spark, rows).repartition(4)
    for threshold in (0.5, 0.8, 0.95):
        assert {r["doc_id"]: (r["class_id"], r["n_similar"]) for r in rows_of(spot_search(df, threshold))} == brute_search(rows, threshold)


def test_search_salts_signatures_that_many_sets_share(spark):
    """A group of near copies, each with a word of its own: all are linked, whatever the salting."""
    rng = random.Random(5)
    common = " ".join(f"the c{i} d{i}" for i in range(40))
    rows = [(i, f"{common} the own{i} thing") for i in range(60)] + [(100 + i, " ".join(f"the r{rng.randrange(10 ** 6)} s{i}" for _ in range(20))) for i in range(60)]
    classes, _ = signature_classes(docs(spark, rows))
    for per_salt in (5, 500):
        pairs = spot_pairs(classes, 0.8, rows_per_salt=per_salt)
        assert pairs.count() == 60 * 59 // 2
    assert sum(r["n_similar"] for r in rows_of(spot_search(docs(spark, rows)))) == 60 * 59
    assert spot_search(docs(spark, [])).count() == 0


def test_search_of_awkward_documents(spark):
    got = rows_of(spot_search(awkward(spark)))
    assert len(got) == 9 and all(r["n_similar"] == 0 for r in got)
    assert len({r["class_id"] for r in got if r["doc_id"] in (1, 2, 4)}) == 1   # no words: one class
