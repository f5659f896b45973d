import random

import numpy as np
import pytest

from helpers import clashing
from tallycheck.llm import url_filter
from tallycheck.llm.url_filter import DigestArray, host_of, suffixes, write_index

URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/en/1?x", "https://example.org", "x://EXAMPLE.org#f", "x://a.b/c://d",
        "http://ÄB.org/", "http://org/es/", "http://notexample.org/es/1", "http://u.com/fr/a/b;c", "http:///p"]
RULES = [("org", "/", "allow"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/fr/", "block"),
         ("", "", "block"), ("u.com", "", "allow"), (None, "/p", "allow"), ("b", "/c", "odd")]


def brute(url, rules, default="allow"):
    rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(h or "", p or "", v) for h, p, v in rules if v in ("allow", "block")
            and (host == (h or "") or host.endswith("." + (h or ""))) and path.startswith(p or "")]
    if not fits:
        return host, path, None, default
    h, p, _ = max(fits, key=lambda x: (len(x[0] + x[1]), len(x[0])))
    return host, path, h + p, "block" if any(f[:2] == (h, p) and f[2] == "block" for f in fits) else "allow"


@pytest.mark.parametrize("most", [1000, 0])
def test_equals_every_rule_tried(spark, most):
    r = random.Random(1)
    urls = URLS + [f"http{r.choice(['', 's'])}://{'.'.join(r.choices(['a', 'b', 'org', 'com', 'example'], k=r.randrange(1, 4)))}"
                   f"/{'/'.join(r.choices(['en', '1', 'fr', 'es'], k=r.randrange(0, 4)))}{r.choice(['', '?q', '#f', '/'])}" for _ in range(200)]
    rules = RULES + [(r.choice(["a.com", "b.org", "b", "example.com"]), r.choice(["/", "/en", "/en/1", "/fr/es"]),
                      r.choice(["allow", "block"])) for _ in range(20)]
    pages = clashing(spark.createDataFrame(list(enumerate(urls)) + [(None, urls[5]), (5, urls[5])], "page_id long, url string"))
    got = url_filter.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), max_rules=most)
    want = [(k, *brute(u, rules)) for k, u in [*enumerate(urls), (None, urls[5]), (5, urls[5])]]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("most", [1000, 0])
def test_hosts_of_many_labels(spark, most):
    url = "http://" + "a." * 200_000 + "b.org/" + "p/" * 100_000
    rules = [("org", "/", "allow"), ("b.org", "/p/p", "block"), ("x.y.z.org", "", "allow")]
    pages = spark.createDataFrame([(1, url), (2, "http://org./p"), (3, "http://...")], "page_id long, url string")
    got = url_filter.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), max_rules=most).collect()
    assert [(r["id"], r["rule"], r["verdict"]) for r in sorted(got)] == [(1, "b.org/p/p", "block"), (2, None, "allow"), (3, None, "allow")]


def test_suffixes():
    assert suffixes("a.b.c", [1, 2, 3, 9]) == ["c", "b.c", "a.b.c"] and suffixes("a.b.c", [2]) == ["b.c"]
    assert suffixes("", [1, 2]) == [""] and suffixes("a.", [1, 2]) == ["", "a."] and suffixes("a", []) == []


def test_collisions_are_confirmed_by_the_string(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "_key", lambda h, p: 7)
    index = DigestArray(write_index(spark, [("a.org", "/", "block"), ("b.org", "/", "allow"), ("c", "/x", "block")]))
    assert len(index.keys) == 3 and isinstance(index.keys, np.memmap)
    assert index.match([("b.org", "/q"), ("x.a.org", "/"), ("d.org", "/x")]) == [("b.org/", "allow"), ("a.org/", "block"), None]


def test_host_of():
    assert host_of("a://B.c?x/y") == ("b.c", "") and host_of("a://b#x/y") == ("b", "") and host_of("a://b/c#x?y") == ("b", "/c")


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert url_filter.judge(pages, rules).count() == 0
    one = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    for most in (10, -1):
        assert tuple(url_filter.judge(one, rules, default="block", max_rules=most).collect()[0]) == (1, "a", "/b", None, "block")
