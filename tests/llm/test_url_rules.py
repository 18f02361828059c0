"""URL rules against plain Python: wildcards, ties, odd URLs, clashing columns, empty tables, both ways to fetch rules."""

import itertools
import random
import re

import pytest
from pagelens.llm import url_rules
from pagelens.llm import queries as registered
from conftest import SMALL

LETTER = "[0-9A-Za-z\x80-\U0010ffff]"
RULES = url_rules.RULES + [
    ("block", "ads.*.net", "/x"), ("allow", "EXAMPLE.org", ""), ("block", "", "/private/"), ("allow", "", "/private/"), ("block", "net", "/a*z"),
    ("allow", r"q\E.net", r"/\E("), ("block", "zürich.net", "/été/"), (None, "net", "/en/"), ("block", None, "*tracker/"), ("allow", "a.b", "/"), ("block", "b", "/c/"),
    ("block", "net", "/"), ("block", "*", "/wild/"), ("allow", "example.com", "no-slash")]
ODD = [None, "", "://", "no scheme", "http://", "http://NET", "http://net/", "http://net?x", "http://x.net/#y", "http://notnet/", "http://example.net/en", "http://EXAMPLE.NET/en/",
       "http://example.net/EN/", "http://a.example.com/de/1?u=http://b/fr/", "http://org/fr/", "ftp://u@org:80/fr/", "http://.net/", "http://a.b/c/", "http://b/c/", "x://ads.q.net/xyz",
       "http://ads./.net/x", "http://q\\E.net/\\E(", "http://zürich.net/été/", "http://zürich.net/étés/", "http://net/a\nz", "http://net\n/a", "http://h/private/", "http://h/q/tracker/",
       "http://" + "x." * 5000 + "net/", "http://net/" + "en/" * 30000, "http://w/wild/", "http://example.com", "http://example.comno-slash"]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def judged(url, rules, default="allow"):
    host, path = parts(url)
    fits = []
    for v, h, p in rules:
        h, p = re.sub("[A-Z]", lambda m: m[0].lower(), h or ""), p or ""
        hosts = "[^/]*".join(map(re.escape, h.split("*")))
        if v is not None and (not h or re.fullmatch(rf"(?:.*\.)?{hosts}", host, re.S)) and re.match(".*".join(map(re.escape, p.split("*"))), path, re.S):
            fits.append((len(h + p), v == "block", h + p, v))
    best = max(fits, default=(0, False, None, default))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("limit", [1000, 0])  # the index as one value, the join
def test_judged_urls(spark, limit):
    draw = random.Random(5)
    hosts, tails = ["net", "a.example.net", "m.ads.net", "ads.x.net", "b.example.org", "q.com", "notorg"], ["", "/", "/en/1", "/fr/", "/de/x?y", "/abz/", "/a/private/", "/private/"]
    urls = ODD + [f"http://{h}{t}" for h, t in itertools.product(hosts, tails)]
    rows = [(i, u, "kept", 7) for i, u in enumerate(urls + draw.choices(urls, k=40))] + [(0, None, None, None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, HOST string, _best int").repartition(3)
    rules = spark.createDataFrame(RULES + RULES[:2], "verdict string, host string, path string")
    got = url_rules.judge_urls(pages, rules, index_rules=limit)
    assert got.columns == ["page_id", "url", "HOST", "_best", "_host", "path", "rule", "verdict"]
    expected = [(*r, *judged(r[1], RULES)) for r in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    assert url_rules.judge_urls(pages.limit(0), rules, index_rules=limit).count() == 0
    none = url_rules.judge_urls(pages, rules.limit(0), default="block", index_rules=limit).collect()
    assert len(none) == len(rows) and {(r.rule, r.verdict) for r in none} == {(None, "block")}


def test_rules_are_indexed_by_their_rarest_token(spark):
    pages = spark.createDataFrame([(i, f"http://www.example.{'net' if i % 3 else 'org'}/en/{i}") for i in range(30)], "page_id long, url string")
    host, path = url_rules.url_parts(pages.url)
    urls = pages.select(host.alias("_host"), path.alias("_path"))
    rules = url_rules.compiled(url_rules.rule_table(spark, [("block", "example.org", "/en/"), ("block", "net", "/en/7/"), ("block", "net", "/en"), ("allow", "*", "/e*")]))
    for small in (True, False):
        got = {r._rule: r._token for r in url_rules.indexed(rules, urls, small).collect()}
        assert got == {"example.org/en/": "h:org", "net/en/7/": "p:7", "net/en": "h:net", "*/e*": ""}


def test_url_rules_are_native(spark):
    for limit in (1000, 0):
        pages = spark.read.parquet(f"{SMALL}/pages.parquet")
        plan = url_rules.judge_urls(pages, url_rules.rule_table(spark, url_rules.RULES), index_rules=limit)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow|ExistingRDD|Cartesian|NestedLoop", plan)
    assert "op11_url_tokens" in registered.queries()
