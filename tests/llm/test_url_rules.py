"""URL rules against a plain reading of each url."""

import random

import pytest

from tarmac.llm import url_rules


def plain(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    ends = [i for i in map(rest.find, "/?#") if i >= 0]
    host, tail = rest[: min(ends, default=len(rest))], rest[min(ends, default=len(rest)) :]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([i for i in map(tail.find, "?#") if i >= 0], default=len(tail))]
    fits = [
        (len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def judge(spark, rows, rules, **options):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    given = spark.createDataFrame(rules, "host string, path string, verdict string")
    return url_rules.filter_pages(pages, given, **options)


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
URLS = [
    None, "", "no scheme", "http://", "http://NET/x", "http://net", "http://a.net?/", "http://a.net/#x", "//a.net/",
    "x://y://a.net/", "http://EXAMPLE.net/en/1?q=/fr/", "http://b.example.net/en", "http://notexample.com/de/",
    "http://a.b.example.com/de/#top", "http://É.org/fr/x", "http://org./fr/", "http://.org/fr/", "http://a..org/fr/y",
    "http://a.org:80/fr/", "http://u@a.org/fr/é\n/x", "http:///fr/",
]


def test_urls_of_all_shapes(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS)] + [(None, "http://a.net/", None), (0, "http://a.net/", None)]
    got = judge(spark, rows, RULES)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    found = sorted(((r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in got.collect()), key=str)
    assert found == sorted(((i, u, *plain(u, RULES)) for i, u, _ in rows), key=str)


@pytest.mark.parametrize("options", [{}, {"rules_per_range": 7, "keys_per_sweep": 5}])
def test_nested_rules_over_ranges_and_sweeps(spark, options):
    rnd = random.Random(4)
    parts = ["a", "b", "ab", "net", "org"]

    def host():
        return ".".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 4)))

    def path():
        return "/" + "/".join(rnd.choice(parts) for _ in range(rnd.randrange(3)))

    rules = list({(h, p): (h, p, rnd.choice(["allow", "block"])) for h, p in ((host(), path()) for _ in range(60))}.values())
    rows = [(i, f"http://{host()}{path()}", None) for i in range(400)]
    got = judge(spark, rows, rules, **options).collect()
    assert {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got} == {(i, *plain(u, rules)) for i, u, _ in rows}
    assert len(got) == len(rows)


def test_repeated_contrary_and_null_rules(spark):
    rules = [("a.b", "/", "allow"), ("A.b", "/", "block"), (None, "/", "block"), ("c", None, "block"), ("a.b", "/", "allow")]
    rows = [(1, "http://x.a.b/", None), (2, "http://c/", None)]
    assert {r.page_id: (r.rule, r.verdict) for r in judge(spark, rows, rules).collect()} == {
        1: ("a.b/", "block"),
        2: (None, "allow"),
    }


def test_no_rules_and_no_pages(spark):
    assert [r.verdict for r in judge(spark, [(1, "http://a/", None)], []).collect()] == ["allow"]
    assert judge(spark, [], RULES).count() == 0
