import numpy as np
import pytest

from cohortloom.llm import url_filter as u

SCHEMA = "page_id long, url string, html string"


def judged(spark, rows, rules=u.RULES, **more):
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS host", "'y' AS verdict", "1 AS id", "2 AS trust")
    return {r["page_id"]: r for r in u.judge_urls(pages, rules, **more).collect()}


@pytest.mark.parametrize("url,host,path,rule", [
    (None, "", "", None), ("", "", "", None), ("no scheme/net/", "", "", None),
    ("http://A.Example.NET/en/1?q=://x", "a.example.net", "/en/1", "example.net/en/"),
    ("http://example.net/de/", "example.net", "/de/", "net/"), ("http://example.net", "example.net", "", None),
    ("http://notexample.net/en/", "notexample.net", "/en/", "net/"), ("http://xnet/", "xnet", "/", None),
    ("https://m.example.com/de/2#f", "m.example.com", "/de/2", "example.com/de/"), ("https://m.example.com/fr/", "m.example.com", "/fr/", None),
    ("http://a.org/fr/x", "a.org", "/fr/x", "org/fr/"), ("http://É.org/FR/", "É.org", "/FR/", None), ("http://h#a/b", "h", "", None),
])
def test_rules(spark, url, host, path, rule):
    row = judged(spark, [(1, url, None)])[1]
    assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
    if rule:
        assert row["verdict"] == {r.name: r.verdict for r in u.RULES}[rule]


def link(*hosts):
    return "".join(f'<a href="http://{h}/x">y</a>' for h in hosts)


def test_distrust_flows_against_links(spark):
    rules = [u.Rule("bad.com", "/", "block"), u.Rule("good.com", "/", "allow")]
    rows = [(1, "http://bad.com/", None), (2, "http://farm.com/", link("bad.com")), (3, "http://good.com/", link("fine.com")),
            (4, "http://fine.com/", "<a href='/local'>"), (5, "http://lone.com/", None)]
    got = judged(spark, rows, rules, threshold=0.3)
    assert {k: r["verdict"] for k, r in got.items()} == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}
    assert got[4]["trust"] > 0 and got[5]["trust"] == got[5]["distrust"] == 0


def test_ranks_against_dense_iteration(spark):
    rng = np.random.default_rng(2)
    hosts = [f"h{k}.com" for k in range(12)]
    links = {(int(a), int(b)): int(n) for a, b, n in zip(rng.integers(0, 12, 40), rng.integers(0, 12, 40), rng.integers(1, 5, 40)) if a != b and a != 3}
    edges = spark.createDataFrame([(hosts[a], hosts[b], n) for (a, b), n in links.items()], "src string, dst string, links long")
    seeds = spark.createDataFrame([("trust", hosts[0], 1.0), ("trust", hosts[1], 0.5), ("distrust", hosts[2], 0.25)], "kind string, host string, seed double")
    got = {(r["kind"], r["host"]): r["rank"] for r in u.propagate(seeds, edges).collect()}
    for kind, start in (("trust", {0: 1.0, 1: 0.5}), ("distrust", {2: 0.25})):
        m = np.zeros((12, 12))
        for (a, b), n in links.items():
            m[(b, a) if kind == "trust" else (a, b)] += n
        out = m.sum(axis=0)
        m = m / np.where(out, out, 1)
        s = np.array([start.get(k, 0.0) for k in range(12)])
        r = s.copy()
        for _ in range(200):
            got_mass = m @ r
            r = 0.15 * s + 0.85 * (got_mass + (s.sum() - got_mass.sum()) / s.sum() * s)
        for k, h in enumerate(hosts):
            assert abs(got.get((kind, h), 0.0) - r[k]) < 1e-4


def test_links():
    import re
    found = re.findall(u.LINK, """<a href='HTTPS://A.com/x'><a HREF = //b.org?q><a href=/rel><link data-href="http://c.de#"><img src=http://no.com>""")
    assert found == ["A.com", "b.org", "c.de"]


def test_empty_and_repeated(spark):
    assert judged(spark, []) == {}
    pages = spark.createDataFrame([(1, "http://a.org/fr/", None)] * 3, SCHEMA)
    assert u.judge_urls(pages, u.RULES).count() == 3
    assert u.judge_urls(pages, []).where("rule IS NULL AND verdict = 'allow'").count() == 3


@pytest.mark.parametrize("farms", [1, 2, 10])
def test_farms_are_blocked_at_the_production_threshold(spark, farms):
    rules = [u.Rule("bad.com", "/", "block"), u.Rule("good.com", "/", "allow")]
    rows = [(1, "http://bad.com/", None), (2, "http://good.com/", link("fine.com"))]
    rows += [(10 + k, f"http://farm{k}.com/", link("bad.com")) for k in range(farms)]
    rows += [(50, "http://fine.com/", link("bad.com", *[f"other{k}.com" for k in range(9)])),
             (51, "http://blog.com/", link("bad.com", *[f"other{k}.com" for k in range(9)])), (52, "http://reader.com/", link("blog.com"))]
    got = {k: r["verdict"] for k, r in judged(spark, rows, rules).items()}
    assert got == {1: "block", 2: "allow", 50: "allow", 51: "allow", 52: "allow"} | {10 + k: "block" for k in range(farms)}


def test_a_link_does_not_whitewash_its_target(spark):
    rules = [u.Rule("bad.com", "/x", "block")]
    rows = [(k, f"http://bad.com/x{k}", None) for k in range(9)] + [(9, "http://bad.com/open", None), (10, "http://farm.com/", link("bad.com"))]
    assert {r["verdict"] for r in judged(spark, rows, rules).values()} == {"block"}
