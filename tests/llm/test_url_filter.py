import duckdb
import pyarrow as pa
import pytest

from quillspark.llm import oracle, url_filter

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("com/de/", "block")]


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash") for i, u, h in rows], "page_id long, url string, html string, host string")


def test_parts_and_rules(spark):
    rows = [(1, "http://WWW.Example.org/es/1?x#y", None), (2, "https://a.org", ""), (3, "https://a.org?q=/x/", ""), (4, None, "x"), (5, "no scheme", "x"),
            (6, "ftp://É.org/Ü#/", ""), (7, "http://org/", ""), (8, "http://notorg/", ""), (8, "http://notorg/", ""), (9, "://x.com/de/://", "")]
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(frame(spark, rows), RULES).collect())
    assert got == [(1, "www.example.org", "/es/1", "example.org/es/", "block"), (2, "a.org", "", None, "allow"), (3, "a.org", "", None, "allow"),
                   (4, "", "", None, "allow"), (5, "", "", None, "allow"), (6, "É.org", "/Ü", "org/", "allow"), (7, "org", "/", "org/", "allow"),
                   (8, "notorg", "/", None, "allow"), (8, "notorg", "/", None, "allow"), (9, "x.com", "/de/://", "com/de/", "block")]
    assert url_filter.judge(frame(spark, []), RULES).collect() == []


def test_propagation_matches_plain_iteration(spark):
    links = {"good.org": ["a.net", "b.net"], "a.net": ["c.net"], "spam.net": ["bad.com", "c.net"], "farm.net": ["spam.net"], "c.net": ["c.net"]}
    html = lambda to: "".join(f'<A  HREF="https://{t}/x">' if k % 2 else f"<a href='//{t}?y'>" for k, t in enumerate(to)) + '<a href="/own">'
    rows = [(k, f"http://{h}/", html(to)) for k, (h, to) in enumerate(links.items())] + [(50, "http://bad.com/de/1", html(["spam.net"])), (51, "http://bad.com/", None)]
    rows += [(60, "http://a.net/", None), (61, "http://farm.net/z", None)]
    links["bad.com"] = ["spam.net"]
    edges = {(a, b) for a, to in links.items() for b in to if a != b}
    seeds = {("allow", "good.org"): 1.0, ("block", "bad.com"): 1.0}
    rank = dict(seeds)
    for _ in range(200):
        new = {k: v * (1 - url_filter.DAMPING) for k, v in seeds.items()}
        for kind in ("allow", "block"):
            step = edges if kind == "allow" else {(b, a) for a, b in edges}
            for a, b in step:
                r = rank.get((kind, a), 0.0)
                new[kind, b] = new.get((kind, b), 0.0) + url_filter.DAMPING * r / sum(x == a for x, _ in step)
        rank = new
    pages = frame(spark, rows)
    counts = spark.createDataFrame([(*k, v) for k, v in seeds.items()], "kind string, host string, seed double")
    got = {(r.kind, r.host): r["rank"] for r in url_filter.propagate(url_filter.host_links(pages, "url", "html"), counts).collect()}
    assert {k: v for k, v in got.items() if v} == pytest.approx({k: v for k, v in rank.items() if v}, abs=1e-5)
    verdict = {r.host: r.verdict for r in url_filter.judge(pages, RULES).collect() if r["rule"] is None}
    assert verdict["spam.net"] == verdict["farm.net"] == "block" and verdict["a.net"] == verdict["c.net"] == "allow"


def test_native_plan(spark):
    plan = url_filter.judge(frame(spark, [(1, "http://a.org/", "")]), RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_hosts_many_links_away_are_reached(spark):
    n = 30
    rows = [(k, f"http://h{k}.net/", f'<a href="http://h{k + 1}.net/">') for k in range(n)] + [(n, f"http://h{n}.net/", '<a href="http://bad.com/">'), (n + 1, "http://bad.com/de/1", None),
            (n + 2, "http://far.net/", '<a href="http://other.net/">')]
    verdict = {r.host: r.verdict for r in url_filter.judge(frame(spark, rows), RULES).collect()}
    assert all(verdict[f"h{k}.net"] == "block" for k in range(n + 1)) and verdict["far.net"] == "allow"
    con = duckdb.connect()
    pages = pa.table({"page_id": [r[0] for r in rows], "url": [r[1] for r in rows], "html": pa.array([r[2] for r in rows], pa.string())})
    con.register("pages", pages)
    assert {r[1]: r[4] for r in con.execute(oracle.oracle_sql()["op1_url_link_trust"]).fetchall()} == verdict


def test_cycles_settle(spark):
    rows = [(1, "http://a.net/", '<a href="http://b.net/">'), (2, "http://b.net/", '<a href="http://a.net/"><a href="http://bad.com/">'), (3, "http://bad.com/de/", '<a href="http://a.net/">')]
    assert {r.host: r.verdict for r in url_filter.judge(frame(spark, rows), RULES).collect()} == dict.fromkeys(["a.net", "b.net", "bad.com"], "block")
