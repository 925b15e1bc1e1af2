import random

import pytest

from mirrorset.llm.urls import judge_urls

RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
    ("a.example.net", "/", "allow"),
    ("a.example.net", "/e", "block"),
    ("b.a.example.net", "", "allow"),
    (None, "/evil", "block"),
]


def brute(url, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    found = [
        (len(h or "") + len(p), len(h or ""), v == "block", (h or "") + p, v)
        for h, p, v in RULES
        if (not h or host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(found, default=None)
    return host, path, best and best[3], best[4] if best else default


def sample():
    rng = random.Random(3)
    hosts = ["net", "example.net", "a.example.net", "b.a.example.net", "c.b.a.Example.NET", "xa.example.net", "example.com",
             "w.example.com", "org", "x.org", "other.info", "", "a..net", "ünï.org"]
    paths = ["", "/", "/en/", "/en/1?x=/de/", "/de/3#a", "/fr/", "/e", "/evil", "?q=1", "#f", "/de"]
    rows = ["http://" + rng.choice(hosts) + rng.choice(paths) for _ in range(400)]
    return rows + ["http://example.net/en/1"] * 200 + [None, "", "nothing", "://", "a://b://c/de/", "x://net\n/"]


@pytest.mark.parametrize("ranges", [1, 40])
def test_as_brute_force(spark, ranges):
    given = list(enumerate(sample()))
    pages = spark.createDataFrame([(i, u, None, 1) for i, u in given], "page_id long, url string, html string, verdict int")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    rows = judge_urls(pages, rules, ranges=ranges).collect()
    assert len(rows) == len(given)
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == brute(given[r.page_id][1]), given[r.page_id]


def test_no_rules_no_pages(spark):
    pages = spark.createDataFrame([(None, "http://x.net/"), (None, None)], "page_id long, url string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert [r.verdict for r in judge_urls(pages, rules).collect()] == ["allow", "allow"]
    assert judge_urls(pages.limit(0), rules).count() == 0
