from __future__ import annotations

import random

from lumenframe.llm import urlrules as U

RULES = [U.Rule.parse(r) for r in ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/", "block a.b.org/x", "allow b.org/x/longer")]


def plain(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:n], rest[n:]
    return host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), path.split("?")[0].split("#")[0]


def best(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.text), len(r.host)), default=None)


URLS = [
    None, "", "no scheme.org/x", "http://", "http:///x", "HTTP://WWW.Example.ORG/es/a?b#c", "https://example.org/en/12", "https://example.org/en/2", "ftp://x.com/fr/?q", "ftp://x.com/fr", "http://com/de/x",
    "http://notorg/", "http://org/", "http://org", "http://a.b.org/x/longer/y", "http://a.b.org/x?z", "http://é.example.org/es/ü", "x://y://example.org/", "http://u@example.org:80/es/", "http://example.org#/es/", "http://.org/a",
]


def test_sweep_equals_each_rule_on_its_own():
    rng = random.Random(2)
    points = [(".".join(rng.choice(["a", "b", "org", "com", "example"]) for _ in range(rng.randint(1, 4))), rng.choice(["", "/", "/es/", "/en/1", "/fr/x", "/x/longer", "/x"])) for _ in range(500)]
    assert U.Sweep(RULES).run(points) == [best(*p) for p in points]


def test_pages(spark):
    rows = [(i, u, "host!", -1) for i, u in enumerate([*URLS, URLS[5]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, extra int").repartition(3)
    expected = {}
    for i, u, *_ in rows:
        h, p = plain(u)
        r = best(h, p)
        expected[i] = (h, p, r and r.text, r.verdict if r else "allow")
    out = U.match_urls(pages, RULES)
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()} == expected
    table = spark.createDataFrame([(r.verdict, r.host, r.path) for r in RULES], "verdict string, host string, path string")
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.match_urls(pages, table).collect()} == expected


def test_many_rules_are_joined(spark, monkeypatch):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    table = spark.createDataFrame([(r.verdict, r.host, r.path) for r in RULES], "verdict string, host string, path string")
    few = {r.page_id: (r.rule, r.verdict) for r in U.match_urls(pages, RULES).collect()}
    monkeypatch.setattr(U, "MAX_SENT_RULES", 2)
    assert {r.page_id: (r.rule, r.verdict) for r in U.match_urls(pages, table).collect()} == few


def test_rules_by_ranges_equal_each_rule_on_its_own(spark, monkeypatch):
    """Nested rules of hot hosts, whose intervals reach over many ranges."""
    monkeypatch.setattr(U, "MAX_SENT_RULES", 2)
    rng = random.Random(5)
    labels, parts = ["a", "b", "org", "com"], ["", "/", "/a", "/a/b", "/a/b/c", "/x", "/x-1", "/a\u00e9"]
    rules = [U.Rule(rng.choice(["allow", "block"]), ".".join(rng.choice(labels) for _ in range(rng.randint(1, 3))).upper(), rng.choice(parts)) for _ in range(60)]
    points = [(i, f"http://{'.'.join(rng.choice(labels) for _ in range(rng.randint(1, 4)))}{rng.choice(parts)}{rng.choice(['', '/z', '?q'])}") for i in range(800)]
    pages = spark.createDataFrame(points, "page_id long, url string").repartition(5)
    want = {}
    for i, u in points:
        h, p = plain(u)
        fits = [r for r in rules if (h == r.host.lower() or h.endswith("." + r.host.lower())) and p.startswith(r.path)]
        r = max(fits, key=lambda r: (len(r.text), len(r.host), r.verdict == "block"), default=None)
        want[i] = (r and r.host.lower() + r.path, r.verdict if r else "allow")
    assert {r.page_id: (r.rule, r.verdict) for r in U.match_urls(pages, rules).collect()} == want
    monkeypatch.setattr(U, "MAX_SENT_RULES", 1000)
    assert {r.page_id: (r.rule, r.verdict) for r in U.match_urls(pages, rules).collect()} == want


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [(r.rule, r.verdict) for r in U.match_urls(pages, [], default="block").collect()] == [(None, "block")]
    assert U.match_urls(pages.limit(0), RULES).collect() == []


def test_few_and_many_rules_of_a_table_fit_alike(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "http://Example.org/a"), (2, "http://É.org/a"), (3, "http://x.com/a")], "page_id long, url string")
    rows = [("block", "EXAMPLE.org", "/"), ("block", "É.org", "/"), ("block", None, "/"), ("block", "x.com", None), (None, "x.com", "/")]
    table = spark.createDataFrame(rows, "verdict string, host string, path string")
    for most in (U.MAX_SENT_RULES, 1):
        monkeypatch.setattr(U, "MAX_SENT_RULES", most)
        got = {r.page_id: (r.rule, r.verdict) for r in U.match_urls(pages, table).collect()}
        assert got == {1: ("example.org/", "block"), 2: ("É.org/", "block"), 3: (None, "allow")}
