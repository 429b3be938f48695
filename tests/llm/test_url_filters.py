import random

import pytest

from figpairs.llm.queries import URL_RULES
from figpairs.llm.url_filters import url_verdicts


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host):].split("?", 1)[0].split("#", 1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def judge(url, rules):
    host, path = split(url)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return (host, path, best[2] if best else None, best[3] if best else "allow")


URLS = [None, "", "no scheme", "http://", "http://net", "http://net/", "http://a.net/x", "http://NET/EN/", "https://example.net/en/1?q#f", "http://m.example.net/en/",
        "http://example.net/de/", "http://example.com/de/x", "http://xexample.com/de/x", "http://a.org/fr/", "http://a.org/frx", "http://b.a.org?x=http://net/",
        "http://a..net/", "http://net./", "http://a.net:80/", "ftp://example.net/en/" + "x" * 50_000, "http://a.net/x", "http://ü.net/ä"]


def run(spark, urls, rules, ranges=5):
    pages = spark.createDataFrame([(k, u, "?", "?", "?") for k, u in enumerate(urls)], "page_id long, url string, host string, key string, verdict string")
    rules = spark.createDataFrame(rules, "host string, path string, verdict string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_verdicts(pages, rules, ranges=ranges).collect()}


def test_rules_of_the_query(spark):
    got = run(spark, URLS, URL_RULES)
    assert got == {k: judge(u, URL_RULES) for k, u in enumerate(URLS)}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_nested_rules(spark, seed):
    rng = random.Random(seed)
    hosts = [".".join(rng.choice(["a", "b", "c"]) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    paths = ["", "/", "/x", "/x/", "/x/y", "/y", "/x/y/z"]
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h in hosts[:25] for p in rng.sample(paths, 2)}.values())
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'q', '?x'])}" for _ in range(300)]
    assert run(spark, urls, rules) == {k: judge(u, rules) for k, u in enumerate(urls)}


def test_no_rules_no_pages_and_repeated_pages(spark):
    assert {v[2:] for v in run(spark, URLS, []).values()} == {(None, "allow")}
    assert run(spark, [], URL_RULES) == {}
    pages = spark.createDataFrame([(None, "http://a.net/"), (1, "http://a.net/"), (1, "http://a.net/")], "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    assert sorted((r.page_id is None, r.verdict) for r in url_verdicts(pages, rules).collect()) == [(False, "block"), (False, "block"), (True, "block")]


def test_plan_has_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    plan = url_verdicts(pages, rules)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
