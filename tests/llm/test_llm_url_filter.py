from __future__ import annotations

import random

import pytest

from layerloom.llm import url_filter
from layerloom.llm.queries import URL_RULES

URLS = [
    "http://a.example.net/en/1", "https://EXAMPLE.net/en/", "http://example.net/en", "http://x.net", "http://x.net/",
    "http://net/", "https://m.example.com/de/5?x=/fr/", "http://org/fr/1#a", "http://a.org/fr", "ftp://b.org/fr/",
    None, "", "no scheme", "http://", "://host/path?q", "http://host#/en/", "http://a..net/", "http://example.com/DE/",
    "http://u:p@example.net:80/en/", "http://notexample.net/en/", "http://x.net/a://b.org/fr/", "http://h\n.net/\n",
]


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
        host = rest[:end].encode().lower().decode()
        tail = rest[end:]
        path = tail[: min([i for i in map(tail.find, "?#") if i >= 0], default=len(tail))]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.text), r.verdict == "block"), default=None)
    return host, path, best and best.text, best.verdict if best else "allow"


@pytest.mark.parametrize("block_rules", [1, 3, 1000])
def test_verdicts_equal_brute_force(spark, block_rules):
    rnd = random.Random(3)
    names = ["a.b", "b", "a", "c.b", "net", "b.net"]
    paths = ["", "/", "/x", "/x/", "/xy/", "/x/y"]
    rules = [url_filter.rule(rnd.choice(["allow", "block"]), rnd.choice(names) + rnd.choice(paths)) for _ in range(12)]
    made = [f"http://{rnd.choice(names)}.{rnd.choice(names)}{rnd.choice(paths)}z" for _ in range(300)]
    urls = URLS + made
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id int, url string, hit string")
    for chosen in (rules, URL_RULES):
        rows = url_filter.judged(pages, chosen, block_rules=block_rules).collect()
        assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows} == {
            i: brute(u, chosen) for i, u in enumerate(urls)
        }
        assert {r.hit for r in rows} == {"mine"}


def test_no_rules_and_no_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.net/", "h")], "page_id int, url string, host string")
    assert [tuple(r) for r in url_filter.judged(pages, [], default="block").collect()] == [
        (1, "http://a.net/", "a.net", "/", None, "block")
    ]
    assert url_filter.judged(pages.limit(0), URL_RULES).count() == 0


def test_bad_rules():
    for verdict, text in (("maybe", "net/"), ("block", "/path")):
        with pytest.raises(ValueError):
            url_filter.rule(verdict, text)


def test_very_long_and_repeated_urls(spark):
    long = "http://" + "a." * 50_000 + "example.net/en/" + "x/" * 50_000
    pages = spark.createDataFrame([(1, long), (1, long), (2, "x" * 200_000)], "page_id int, url string")
    rows = url_filter.judged(pages, URL_RULES).collect()
    assert [(r.page_id, r.rule, r.verdict) for r in sorted(rows, key=lambda r: r.page_id)] == [
        (1, "example.net/en/", "allow"), (1, "example.net/en/", "allow"), (2, None, "allow")
    ]
