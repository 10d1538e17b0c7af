import re

import numpy as np

from walkvec.llm.link_trust import RULES, UrlRule, host_edges, judged_pages, propagate

URLS = [
    "http://A.Example.NET/en/1?x=/de/#f", "https://example.net/en", "http://example.net", "http://x.example.com/de/5",
    "http://x.example.com/DE/5", "http://example.com?/de/", "http://notexample.com/de/1", "http://org/fr/2", "ftp://a.b.org/fr/#x",
    "no scheme/here", "", None, "http:///path", "http://a.net/#", "http://a://b/c", "://h.net/", "http://net/", "x://b.org/fr",
    "http://ünï.example.org/fr/ä?q", "http://blog.example.com/en/1", "http://blog.example.com/en/1",
]


def brute(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.text)) if fit else None


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1.0) for r in rows], "page_id bigint, url string, html string, host string, trust double")


def test_hosts_paths_and_rules(spark):
    table = pages(spark, [(i, u, None if i % 2 else "<a href='/x'>") for i, u in enumerate(URLS)])
    got = {r["page_id"]: r for r in judged_pages(table).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = brute(url)
        fits = rule(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, fits.text if fits else None), url
        assert got[i]["verdict"] == fits.verdict if fits else got[i]["verdict"] in ("allow", "block")


def test_edges(spark):
    html = """<A HREF="https://B.org/x">1</a><a href='//c.d.org:80/y'><a href=/local><a href="http://a.b.org/"> <a href="http://B.org/2">"""
    table = spark.createDataFrame([("a.b.org", html), ("a.b.org", None)], "host string, html string")
    got = {(r["src"], r["dst"]): r["weight"] for r in host_edges(table, table.select("host").distinct()).collect()}
    assert got[("a.b.org", "b.org")] == 3.0  # two links and the tie
    assert got[("a.b.org", "c.d.org:80")] == 1.0
    assert got[("b.org", "a.b.org")] == 1.0 and ("a.b.org", "a.b.org") not in got
    assert not any(s == "org" or d == "org" for s, d in got)


def test_propagation_equals_matrix_powers(spark):
    rng = np.random.default_rng(4)
    n = 12
    weights = rng.integers(0, 4, (n, n)) * (rng.random((n, n)) < 0.3)
    np.fill_diagonal(weights, 0)
    edges = spark.createDataFrame(
        [(f"h{i}", f"h{j}", float(weights[i, j])) for i in range(n) for j in range(n) if weights[i, j]],
        "src string, dst string, weight double",
    )
    seeds = {"trust": {0: 3.0, 4: 1.0}, "distrust": {7: 2.0, 0: 1.0}}
    rows = [(k, f"h{i}", s) for k, v in seeds.items() for i, s in v.items()]
    got = propagate(edges, spark.createDataFrame(rows, "kind string, node string, score double"), 0.8, 6).collect()
    got = {(r["kind"], r["node"]): r["score"] for r in got}
    for kind, matrix in (("trust", weights), ("distrust", weights.T)):
        step = matrix / np.maximum(matrix.sum(1, keepdims=True), 1)
        start = np.zeros(n)
        for i, s in seeds[kind].items():
            start[i] = s
        x = start
        for _ in range(6):
            x = 0.8 * x @ step + 0.2 * start
        for i in range(n):
            assert abs(got.get((kind, f"h{i}"), 0.0) - x[i]) < 1e-9


def test_distrust_reaches_those_that_link_to_blocked_hosts(spark):
    rules = (UrlRule("block", "bad.org", "/"), UrlRule("allow", "good.org", "/"))
    rows = [(i, "http://bad.org/x", "") for i in range(9)] + [(i + 10, "http://good.org/x", "") for i in range(9)]
    rows += [(30, "http://farm.com/", "<a href='http://bad.org/'>"), (31, "http://fan.com/", "<a href='http://good.org/'>")]
    rows += [(32, "http://cited.com/", "")]
    rows.append((33, "http://good.org/y", "<a href='http://cited.com/'>"))
    got = {r["page_id"]: r for r in judged_pages(pages(spark, rows), rules).collect()}
    assert got[30]["verdict"] == "block" and got[30]["rule"] is None
    assert got[31]["verdict"] == "allow" and got[32]["verdict"] == "allow" and got[32]["trust"] > 0


def test_empty_table(spark):
    assert judged_pages(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
