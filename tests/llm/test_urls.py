"""URL filters: hosts, paths and rules against plain Python; templates and purity on planted labels."""

import random

import pytest
from pyspark.sql import functions as F

from tillwright.llm import urls

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    stop = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[stop:]
    stop2 = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return rest[:stop].translate(UPPER), path[:stop2]


def rule(host, path):
    fits = [(of + pre, what) for what, of, pre in urls.RULES if (host == of or host.endswith(f".{of}")) and path.startswith(pre)]
    return max(fits, key=lambda r: len(r[0]), default=(None, None))


EDGES = [
    None, "", "no scheme", "://", "http://", "http://NET", "http://net/", "http://x.NET/a", "http://xnet/", "HTTP://Example.NET/en/1", "http://example.net/en",
    "http://a.b.org/fr/x?y#z", "http://É.org/FR/", "http://example.com/de/?q=/en/", "http://example.com?/de/", "http://example.com#x", "a://b://c/d",
    "http://example.net:80/en/", "http://h/\n1", "http://h//" + "/a" * 300, "http://h2/" + "/b" * 20_000, "http://h/" + "x" * 50_000, "http://example.com/de/5.html", "http://example.com/de/5.html",
]


def judged(spark, page_urls, labels=()):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(page_urls)], "page_id long, url string")
    pages = pages.withColumns({"host": F.lit("clash"), "verdict": F.lit("clash")}).repartition(3)
    known = spark.createDataFrame(list(labels), "url string, bad int")
    return {r["page_id"]: r for r in urls.judged(pages, known).collect()}


def test_hosts_paths_and_rules(spark):
    got = judged(spark, EDGES)
    assert len(got) == len(EDGES)
    for i, url in enumerate(EDGES):
        host, path = parts(url)
        want, verdict = rule(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, want, verdict or "allow"), url


def test_templates_generalise_and_block_by_purity(spark):
    labels = [(f"http://site.info/spam/{k}.html", 1) for k in range(40)] + [(f"http://site.info/news/{k}", 0) for k in range(60)]
    labels += [(f"http://other.info/user{k}/home", int(k % 2 == 0)) for k in range(100)] + [("http://site.info/news/1", None), (None, 1)]
    pages = ["http://site.info/spam/99999.html", "http://site.info/news/7777", "http://other.info/unseen-name/home", "http://never.info/a", "http://site.info/spam/1.html"]
    got = judged(spark, pages, labels)
    assert [got[i]["template"] for i in range(4)] == ["/spam/*.html", "/news/*", "/*/home", "/a"]
    assert [got[i]["verdict"] for i in range(5)] == ["block", "allow", "allow", "allow", "block"]


def test_similar_branches_are_merged(spark):
    """A rare template joins siblings that behave like it."""
    labels = [(f"http://h.info/{s}/{k}", 1) for s in ("b1", "b2", "b3") for k in range(30)] + [(f"http://h.info/{s}/{k}", 0) for s in ("g1", "g2") for k in range(60)]
    pages = [f"http://h.info/{s}/5" for s in ("b1", "b2", "b3", "g1", "g2")]
    got = judged(spark, pages, labels)
    assert len({got[i]["branch"] for i in range(3)}) == 1 and len({got[i]["branch"] for i in range(5)}) == 2
    assert [got[i]["verdict"] for i in range(5)] == ["block"] * 3 + ["allow"] * 2


@pytest.mark.parametrize("sections", [31, 32, 33, 400])
def test_a_bad_section_is_blocked_at_any_fan_out(spark, sections):
    labels = [(f"http://h.info/s{s}x/{k}", int(s == 0)) for s in range(sections) for k in range(40)]
    got = judged(spark, ["http://h.info/s0x/777", "http://h.info/s1x/777"], labels)
    assert [(got[i]["template"], got[i]["verdict"]) for i in range(2)] == [("/s0x/*", "block"), ("/s1x/*", "allow")]


def test_thousands_of_rare_segments_are_one_wildcard(spark):
    name = [f"user-{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}" for k in range(10_000)]
    labels = [(f"http://h.info/{name[k]}/{('home', 'photos')[k % 2]}", k % 2) for k in range(10_000)]
    got = judged(spark, ["http://h.info/someone/photos", "http://h.info/someone/home"], labels)
    assert [(got[i]["template"], got[i]["verdict"]) for i in range(2)] == [("/*/photos", "block"), ("/*/home", "allow")]


def test_random_urls(spark):
    rng = random.Random(1)
    bits = ["http", "://", "/", "?", "#", "net", "example", ".", "com", "org", "/fr/", "/de/", "/en/", "A", "é", "12", "\n"]
    some = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    got = judged(spark, some)
    for i, url in enumerate(some):
        host, path = parts(url)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule(host, path)[0]), url


def test_empty_tables(spark):
    assert judged(spark, []) == {}
