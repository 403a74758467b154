"""URL filters against every rule for every url."""

import re
from collections import Counter

import pytest

from cellspark.llm import url_filter
from cellspark.llm.queries import URL_RULES

from .conftest import SF

URLS = [
    (1, "https://www.Example.com/en/a?b#c"),
    (2, "http://example.com"),
    (3, "http://example.com?x=/en/"),
    (4, "http://notexample.com/en/x"),
    (5, "http://a.b.example.com/en/x"),
    (6, "//example.com/en/"),
    (7, None),
    (8, ""),
    (9, "x://y://example.net/fr/1"),
    (10, "http://net/fr/1"),
    (11, "http://shop.net/fr/../es/"),
    (12, "http://www.example.com/en/" + "a/" * 3000),
    (12, "http://www.example.com/en/\nb"),
    (None, "http://xn--.com/é"),
    (13, "http:///en/"),
    (14, "http://www.example.com./en/"),
    (15, "http://m.www.example.com/enough"),
    # a comma or any other mark may stand in a host and divides no labels
    (16, "http://foo.net,evil/es/x"),
    (17, "http://a.com,b/en/"),
    (18, "http://x,net/es/"),
    (19, "http://com,example/en/"),
    (20, "http://a!.net/es/"),
    (21, "http://www.example.com,/en/"),
]
MORE = [
    ("example.com", "", "allow"),
    ("EXAMPLE.com", "/en/a", "block"),
    ("example.com", "/en/a", "block"),
    ("", "/", "block"),
    (None, "/", "block"),
    ("net", None, "block"),
    ("evil/net", "/", "block"),
]


def split(url):
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    if not found:
        return "", ""
    return found[1].translate({c: c + 32 for c in range(65, 91)}), found[2]


def expected(rows, rules, default="allow"):
    sound = {(h.lower(), p, a) for h, p, a in rules if h and p is not None}
    for page, url in rows:
        host, path = split(url)
        fits = [
            (len(h) + len(p), len(h), p, a, h)
            for h, p, a in sound
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        best = max(fits, default=None)
        yield page, host, path, best and best[4] + best[2], best[3] if best else default


def rules_of(spark, rules):
    return spark.createDataFrame(rules, "host string, path string, action string")


@pytest.mark.parametrize("rules", [URL_RULES, URL_RULES + MORE])
def test_odd_urls(spark, rules):
    pages = spark.createDataFrame(URLS, "page_id long, url string").selectExpr("*", "1 as host", "'x' as rule")
    found = url_filter.judge(pages.repartition(3), rules_of(spark, rules))
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert Counter(map(tuple, found.collect())) == Counter(expected(URLS, rules))


def test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [(r.page_id, r.url) for r in pages.collect()]
    found = url_filter.judge(pages, rules_of(spark, URL_RULES))
    assert Counter(map(tuple, found.collect())) == Counter(expected(rows, URL_RULES))


def test_hot_host_is_in_several_ranges(spark):
    """One url in a third of all rows; many nested rules."""
    rows = [(i, "http://a.b.c.hot.org/x/y" if i % 3 else f"http://h{i % 50}.org/x/{i}") for i in range(600)]
    rules = [("org", "/", "block"), ("hot.org", "/x", "allow"), ("c.hot.org", "/z", "block"), ("b.c.hot.org", "/x/y", "block")]
    rules += [(f"h{i}.org", "/x/", "allow") for i in range(0, 50, 3)]
    found = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules_of(spark, rules))
    assert Counter(map(tuple, found.collect())) == Counter(expected(rows, rules))


def test_empty(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string")
    none = rules_of(spark, URL_RULES).limit(0)
    assert {r.verdict for r in url_filter.judge(pages, none, default="block").collect()} == {"block"}
    assert url_filter.judge(pages.limit(0), rules_of(spark, URL_RULES)).count() == 0
