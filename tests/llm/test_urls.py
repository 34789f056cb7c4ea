import random

from marketlake.llm.urls import RULES, filter_urls
from tests.llm.helpers import rows_of


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:cut], rest[cut:]
        path = tail[:min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, None, default))
    return host, path, best[2], best[3]


URLS = [None, "", "no scheme", "http://Example.ORG/es/1", "https://m.example.org/en/15?x", "https://example.org/en/25#/es/", "x://org/", "x://org",
        "a://b.com/de/", "a://b.com/fr/x", "a://com/fr", "a://notexample.org/es/", "://example.org/es/", "http://é.org/é/", "a://b.com?/de/",
        "a://" + "a." * 30_000 + "org/" + "x" * 50_000, "a://b.com/de/\n/x"]


def test_rules_by_brute_force(spark):
    rnd = random.Random(2)
    urls = URLS + [f"http://{rnd.choice(['', 'm.', 'www.x.'])}{rnd.choice(['org', 'example.org', 'a.com', 'com', 'net'])}/{rnd.choice(['de', 'es', 'en', 'fr'])}/{rnd.randint(1, 30)}" for _ in range(200)]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows_of(filter_urls(df, RULES))}
    assert got == {i: brute(u, RULES) for i, u in enumerate(urls)}


def test_colliding_digests_are_confirmed_by_the_strings(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(None, None), (1, URLS[3]), (1, URLS[3])], "page_id long, url string")
    got = rows_of(filter_urls(df, RULES, digest=lambda s: len(s) % 2))  # nearly all digests collide
    assert len(got) == len(URLS) + 3
    want = {i: brute(u, RULES) for i, u in enumerate(URLS)}
    want[None] = brute(None, RULES)
    for r in got:
        if not (r["page_id"] == 1 and r["rule"]):  # the repeated id has another url
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == want[r["page_id"]]


def test_no_rules_and_no_rows(spark):
    df = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert rows_of(filter_urls(df, [], default="block")) == [{"page_id": 1, "host": "a.b", "path": "/c", "rule": None, "verdict": "block"}]
    assert filter_urls(df.limit(0), RULES).count() == 0


def test_a_rule_with_both_verdicts_blocks(spark):
    df = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert rows_of(filter_urls(df, [("block", "a.b", "/"), ("allow", "A.B", "/")]))[0]["verdict"] == "block"
