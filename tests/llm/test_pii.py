import hashlib
import random
import re
import time

from marketlake.llm.pii import KINDS, base_spans, bootstrap, context, find_personal_data, luhn, mentions, redact, scan
from tests.llm.helpers import awkward, docs, rows_of

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def digits(s):
    return re.sub(r"[^0-9]", "", s)


def brute(text):
    out = []
    for kind in KINDS:
        for m in re.finditer(PLAIN[kind], text or ""):
            s = m[0]
            if (kind == "ip" and any(int(x) > 255 for x in s.split(".")) or kind == "card" and not (16 <= len(digits(s)) <= 19 and luhn(digits(s)))
                    or kind == "phone" and not 8 <= len(digits(s)) <= 15):
                continue
            out.append((kind, m.start(), m.end()))
    return out


CASES = ["a@b.c", "a@b", "x.y+z@d-e.f.g, a@b@c.d", "@a.b", "é@ü.de x%_@1.2.3.4", "1.2.3.4.5.6.7.8", "1.2.3", "300.1.1.1 01.002.3.255", "0000000001.1.1.1",
         "4111 1111-1111 1111", "4111 1111 1111 1112", "1 2 3", "41111111111111111", "+1 (523) 555-1055", "+1 2", "+1234567", "++12345678 ", "+1 (2) 3456789 - ",
         "a..b@c.d..e", "4111111111111111 4111111111111111", "1.2.3.4@5.6", "+491111111111111111", "x@y.z@q.w", "a@b.c.-", "٣.1.1.1 1.1.1.٣", "4111\n111111111111"]


def test_base_patterns_by_plain_regular_expressions():
    for text in CASES:
        assert base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    began = time.time()
    for text in ("a" * 400_000 + " x@y.z", "1" * 400_000, "1." * 200_000, "+" * 300_000, "+1" + " " * 400_000, "a@" * 200_000, "1 " * 200_000):
        base_spans(text)
    assert time.time() - began < 20


def test_mentions_stay_clear_of_base_spans():
    for text in [*CASES, "call (523) 555-7777 or +1 (523) 555-1055", "a@b.c at id-77 4111 1111-1111 1111 4111 1111 1111 1112", "+4111111111111111 x-9"]:
        base = base_spans(text)
        got = mentions(text, base)
        assert [(m["kind"], m["start"], m["end"]) for m in got if m["seed"]] == base
        for m in got:
            assert m["seed"] or not any(m["start"] < z and a < m["end"] for _, a, z in base)


def test_many_spans_in_one_text_take_linear_time():
    text = "mail a@b.cd for order-7000x now " * 60_000
    began = time.time()
    assert sum(not m["seed"] for m in mentions(text, base_spans(text))) == 60_000
    assert time.time() - began < 60


def test_documents_by_brute_force(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r for r in rows_of(find_personal_data(d))}
    for r in d.collect():
        want = brute(r.text)
        joined = ",".join(f"{k}:{a}:{z}" for k, a, z in want)
        g = got[r.doc_id]
        assert [g[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in want) for k in KINDS]
        assert g["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(g["spans"].split(","))


def phones(n, text="please call me at {} after work"):
    return [(i, text.format(f"+1 (523) 555-{1000 + i}"), "en", "s") for i in range(n)]


def test_trusted_patterns_discover_other_forms(spark):
    rows = phones(12) + [(100, "please call me at (523) 555-7777 after work", "en", "s"), (101, "chapter ten of (523) 555-8888 pages", "en", "s")]
    got = {r["doc_id"]: r for r in rows_of(find_personal_data(docs(spark, rows)))}
    assert got[100]["spans"] == "phone:18:32" and got[100]["n_added"] == 1 and got[100]["n_phone"] == 0
    assert got[101]["spans"] == "" and got[0]["n_added"] == 0


def test_a_pattern_around_everything_is_not_trusted(spark):
    rows = phones(4, "the {} of") + [(50 + i, f"the order-{7000 + i}x of", "en", "s") for i in range(20)] + [(100, "the (523) 555-7777 of", "en", "s")]
    found = scan(docs(spark, rows))
    assert bootstrap(found).count() == 0


def unseen(n, at, text="please call me at {} after work"):
    return [(at + i, text.format(f"(523) 555-{5000 + i}"), "en", "s") for i in range(n)]


def test_as_many_unseen_forms_as_seeds_and_more(spark):
    for seeds, new in ((3, 1), (12, 12), (10, 40)):
        got = rows_of(find_personal_data(docs(spark, phones(seeds) + unseen(new, 100))))
        assert sum(r["n_added"] for r in got) == new, (seeds, new)
    assert bootstrap(scan(docs(spark, phones(2) + unseen(9, 100)))).count() == 0


def test_accepted_values_make_patterns(spark):
    chain = ["please call me at {} after work", "his own number was {} last year", "they then dialled {} from home"]
    rows = phones(3) + unseen(4, 100) + unseen(4, 200, chain[1]) + unseen(8, 300, chain[1]) + unseen(8, 400, chain[2]) + unseen(16, 500, chain[2])
    rows += unseen(20, 600, "chapter ten of {} pages")[16:]
    got = {r["doc_id"]: r["n_added"] for r in rows_of(find_personal_data(docs(spark, rows)))}
    assert sum(got.values()) == 40 and not any(got[600 + i] for i in range(16, 20))


def test_values_of_other_kinds_count_against_a_pattern(spark):
    other = [(200 + i, f"please call me at order-{7000 + i}x after work", "en", "s") for i in range(4)]
    assert bootstrap(scan(docs(spark, phones(12) + unseen(12, 100) + other))).count() == 0
    assert bootstrap(scan(docs(spark, phones(18) + unseen(12, 100) + other))).count() == 12


def test_fragments_of_a_candidate_say_nothing_against_it():
    got = [(m["kind"], m["value"], m["inner"]) for m in mentions("at (523) 555-7777 or 523-555-7777 or 1234 5678 9012 3456 id-77", [])]
    assert [g for g in got if g[0] == "other"] == [("other", "id-77", False)]
    assert ("phone", "(523) 555-7777", False) in got and ("phone", "523-555-7777", False) in got
    assert ("phone", "1234 5678 9012", True) in got and ("card", "1234 5678 9012 3456", False) in got


def test_redaction(spark):
    rows = phones(12) + [(100, "please call me at (523) 555-7777 after work", "en", "s"), (101, "mail a@b.cd or 1.2.3.4", "en", "s"), (102, None, "en", "s")]
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    got = {r["doc_id"]: r["text"] for r in rows_of(redact(docs(spark, rows), cols))}
    assert got[0] == got[100] == "please call me at [PHONE] after work"
    assert got[101] == "mail [EMAIL] or [IP]" and got[102] is None


def test_redaction_adds_spans_of_the_row_itself(spark):
    rows = phones(12) + [(None, "please call me at (523) 555-7777 after work", "en", "s"), (None, "many other things (523) 555-8888 were read", "en", "s"),
                         (None, "or read the pages (523) 555-7777 then", "en", "s")]
    d = docs(spark, rows).repartition(3)
    got = sorted(r["text"] for r in rows_of(redact(d, ["doc_id", "text"])) if r["doc_id"] is None)
    assert got == ["many other things (523) 555-8888 were read", "or read the pages [PHONE] then", "please call me at [PHONE] after work"]
    keyed = d.selectExpr("doc_id", "text", "xxhash64(text) as own")
    found = scan(keyed, row_col="own")
    assert {r["rid"] for r in rows_of(found)} == {r["own"] for r in rows_of(keyed)}


def test_awkward_documents(spark):
    got = rows_of(find_personal_data(awkward(spark)))
    assert len(got) == 9 and {r["spans"] for r in got} == {""}
    assert find_personal_data(docs(spark, [])).count() == 0


def test_edges_and_numbers_are_no_context(spark):
    assert context("1.2.3.4", 0, 7) == [] and context("-- 12:30 | 9 --", 3, 8) == []
    assert context("at 1.2.3.4 now", 3, 10) == [" at _", "at _ now", "_ now "]
    ips = [(i, f"10.20.30.{i}") for i in range(5)] + [(10 + i, f"line\n10.20.31.{i}\n") for i in range(5)] + [(20 + i, f"# 10.20.32.{i} | 7") for i in range(5)]
    alone = ["12:30:45:10", "1:2:3:4", "a:b:c:d:e:f", "2.10.3", "deadbeefcafe01", "v1.2.3-rc4", "# 12:30:45:10 | 9", "| 01:02:03:04 |", "4111 1111 1111 1112"]
    rows = ips + [(100 + i, t) for i, t in enumerate(alone)] + [(200 + i, f"{t}\nand more text") for i, t in enumerate(alone)]
    got = {r["doc_id"]: r for r in rows_of(find_personal_data(docs(spark, rows)))}
    assert all(got[i]["n_ip"] == 1 for i, _ in ips) and not any(r["n_added"] for r in got.values())
    hidden = {r["doc_id"]: r["text"] for r in rows_of(redact(docs(spark, rows), ["doc_id", "text"]))}
    assert all(hidden[i] == t for i, t in rows if i >= 100)


def brute_bootstrap(texts, min_seeds=3, confidence=0.8):
    """The graph in plain dictionaries."""
    edges = {}
    for text in texts:
        for m in mentions(text, base_spans(text)):
            for p in m["patterns"]:
                seed, inner = edges.get((p, m["value"], m["kind"]), (False, True))
                edges[p, m["value"], m["kind"]] = (seed or m["seed"], inner and m["inner"])
    accepted = set()
    while True:
        trust = {}
        for p in {e[0] for e in edges}:
            for kind in KINDS:
                known = {v for (q, v, k), (seed, _) in edges.items() if q == p and k == kind and (seed or (v, k) in accepted)}
                against = [1 for (q, v, k), (_, inner) in edges.items() if q == p and k != kind and not inner]
                c = len(known) / (len(known) + len(against) + 0.5)
                if len(known) >= min_seeds and c >= confidence:
                    trust[p, kind] = c
        new = {(v, k) for (p, v, k), (seed, _) in edges.items() if not seed and (p, k) in trust} - accepted
        if not new:
            break
        accepted |= new
    score = {}
    for v, k in accepted:
        rest = 1.0
        for (p, w, kind), (seed, _) in edges.items():
            if (w, kind) == (v, k) and not seed and (p, k) in trust:
                rest *= 1 - trust[p, k]
        score.setdefault(v, []).append((round(1 - rest, 9), -KINDS.index(k), k))
    return {v: max(s)[2] for v, s in score.items()}


def test_the_graph_by_brute_force(spark):
    rng = random.Random(6)
    frames = ["please call {} now", "call {} after work", "write to {} or", "write {} now", "server {} is", "order {} now", "card {} or", "{}"]
    forms = [lambda: f"+1 (523) 555-{rng.randrange(1000, 1030)}", lambda: f"(523) 555-{rng.randrange(1000, 1030)}", lambda: f"u{rng.randrange(9)}@ex.org",
             lambda: f"u{rng.randrange(9)} [at] ex [dot] org", lambda: f"10.0.0.{rng.randrange(9)}", lambda: f"fe80:0:0:{rng.randrange(9)}:1", lambda: f"x-{rng.randrange(99)}",
             lambda: f"4111 1111 1111 11{rng.randrange(10, 14)}", lambda: "4111 1111-1111 1111"]
    for _ in range(4):
        texts = [" ".join(rng.choice(frames).format(rng.choice(forms[k:k + 2])()) for _ in range(rng.randint(1, 3))) for k in (rng.randrange(8) for _ in range(120))]
        got = {r["value"]: r["kind"] for r in rows_of(bootstrap(scan(docs(spark, list(enumerate(texts))))))}
        assert got == brute_bootstrap(texts)


def test_planted_contexts_precision_and_recall(spark):
    """Identifiers of unseen forms in the contexts of known ones are found, look-alikes in other contexts are not."""
    rng = random.Random(8)
    filler = lambda: " ".join(rng.choice("river stone paper window garden music letter winter bridge".split()) for _ in range(rng.randint(3, 9)))
    rows, planted, alike = [], set(), set()
    for i in range(300):
        number = f"{rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        kind = i % 5
        if kind < 2:
            body = f"reach our office at +1 ({number} any weekday"
        elif kind == 2:
            body = f"reach our office at ({number} any weekday"
            planted.add(i)
        else:
            body = f"see chapter {filler()} ({number} {filler()}"
            alike.add(i)
        rows.append((i, f"{filler()} {body} {filler()}"))
    found = {r["doc_id"] for r in rows_of(find_personal_data(docs(spark, rows))) if r["n_added"]}
    assert len(found & planted) == len(planted) and not found & alike
