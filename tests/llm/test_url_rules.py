"""URL verdicts by brute force."""

import math
import random
from collections import Counter
from itertools import combinations

from airwave.llm import url_rules
from airwave.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string"


def parts(url):
    scheme, found, rest = (url or "").partition("://")
    if not found:
        scheme = rest = ""
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    before, mark, _ = rest.partition("#")
    path, _, query = before.partition("?")
    return scheme, host, path, query, bool(mark)


def tokens(url):
    scheme, host, path, query, mark = parts(url)
    labels = [x for x in host.split(".") if x]
    segments = [x for x in path.split("/") if x]
    stem, dot, ending = segments[-1].rpartition(".") if segments else ("", "", "")
    plain = dot and ending and all(c.isascii() and c.isalnum() for c in ending)
    found = {
        "scheme": scheme,
        "tld": labels[-1] if labels else "",
        "domain": ".".join(labels[-2:]) if len(labels) > 1 else "",
        "host": host,
        "sub": labels[0] if len(labels) > 2 else "",
        "first": segments[0] if segments else "",
        "second": segments[1] if len(segments) > 1 else "",
        "ending": ending if plain else "",
        "query": "&".join(x.split("=")[0] for x in query.split("&")),
        "fragment": "yes" if mark else "",
    }
    return frozenset(f"{k}={v}" for k, v in found.items() if v)


def given(url):
    _, host, path, *_ = parts(url)
    fits = [
        (len(h + p), len(h), h + p, says)
        for h, p, says in URL_RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[2:] if fits else (None, None)


def brute(urls, support, confidence):
    labelled = [(tokens(u), given(u)[1]) for u in urls if given(u)[0]]
    hits, every = Counter(), Counter()
    for found, says in labelled:
        for n in (1, 2, 3):
            for s in combinations(sorted(found), n):
                hits[s, says] += 1
                every[s] += 1
    least = math.ceil(support * len(labelled))
    sure = {k: h / every[k[0]] for k, h in hits.items() if h >= least and h / every[k[0]] >= confidence}
    mined = {
        (s, says): c
        for (s, says), c in sure.items()
        if not any(
            sure.get((t, says), 0) >= c for n in range(1, len(s)) for t in combinations(s, n)
        )
    }
    out = []
    for i, u in enumerate(urls):
        rule, says = given(u)
        best = None
        if rule is None:
            has = tokens(u)
            fits = [
                (-c, -hits[s, v], len(s), "&".join(s), v) for (s, v), c in mined.items() if has >= set(s)
            ]
            best = min(fits, default=None)
            says = best[4] if best else "allow"
        _, host, path, *_ = parts(u)
        out.append((i, host, path, rule, says, best and best[3]))
    return out


def judged(spark, urls, **settings):
    rows = [(i, u, "<html>") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "'x' AS host", "'x' AS rule", "'x' AS tokens", "'x' AS path", "1 AS verdict"
    )
    df = url_rules.judge_urls(pages, URL_RULES, **settings)
    return sorted(tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict", "mined").collect())


ODD = [None, "", "no scheme", "://", "http://", "http:///x", "http://ORG", "http://org/", "ftp://a.ORG/es/",
       "http://example.org/es/1", "http://x.example.org/es/", "http://badexample.org/es/", "http://a.com/fr/",
       "http://a.com/de", "http://a.com/de/", "http://example.org/en/12?x=http://y/z#q", "http://a?b/c", "http://a#b?c",
       "a://b://c.com/de/", "http://com/fr/a.b.html", "http://..org/", "http://é.com/de/ü?ä=1&b",
       "http://h.com/" + "s/" * 3000 + "end.html", "http://x.org/a\nb"]


def test_odd_urls(spark):
    assert judged(spark, ODD, support=0.1, confidence=0.5) == brute(ODD, 0.1, 0.5)


def test_mined_rules_equal_brute_force(spark):
    draw = random.Random(4)
    urls = [
        f"{draw.choice(['http', 'https'])}://{draw.choice(['a', 'b', 'www', 'm'])}.{draw.choice(['example', 'pills', 'news'])}"
        f".{draw.choice(['com', 'org', 'net', 'com'])}/{draw.choice(['fr', 'de', 'es', 'en'])}/{draw.randrange(200)}"
        f"{draw.choice(['', '.html', '/', '?page=2&ref=x', '#top'])}"
        for _ in range(600)
    ]
    # One host holds a third of all pages.
    urls += ["https://www.hot.com/de/7?page=1", "https://www.hot.net/de/7?page=1"] * 150
    for support, confidence in ((0.005, 0.8), (0.02, 0.95), (0.05, 0.6)):
        got = judged(spark, urls, support=support, confidence=confidence)
        assert got == brute(urls, support, confidence)
        assert {"block", "allow"} == {r[4] for r in got} and any(r[5] for r in got)


def test_no_labels_and_no_rows(spark):
    assert judged(spark, ["http://x.net/a", None]) == brute(["http://x.net/a", None], 0.005, 0.8)
    empty = spark.createDataFrame([], SCHEMA)
    assert url_rules.judge_urls(empty, URL_RULES).collect() == []


def test_no_python_in_the_plan(spark):
    rows = [(i, u, "") for i, u in enumerate(ODD)]
    df = url_rules.judge_urls(spark.createDataFrame(rows, SCHEMA), URL_RULES)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
