from collections import defaultdict

import pytest

from roadtally.llm import link_graph as L
from roadtally.llm.queries import op10_url_filter

LISTED = [
    (None, "", "", None), ("no scheme.org/", "", "", None), ("http://A.Org/x?y#z", "a.org", "/x", "org/"), ("x://org", "org", "", None),
    ("http://example.org/es/1", "example.org", "/es/1", "example.org/es/"), ("http://www.example.org/en/19?q", "www.example.org", "/en/19", "example.org/en/1"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/"), ("http://b.com/fr/", "b.com", "/fr/", "com/fr/"), ("http://b.com/frx", "b.com", "/frx", None),
    ("http://b.com/de/#/fr/", "b.com", "/de/", "com/de/"), ("http://c.net://d.org/", "c.net:", "//d.org/", None), ("http://É.COM?/fr/", "É.com", "", None), ("://", "", "", None),
]


def pages(spark, rows):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("rank", F.lit(0))


def test_hosts_paths_and_rules(spark):
    rows = L.judge_urls(pages(spark, [(i, u, None) for i, (u, *_) in enumerate(LISTED)]), rounds=2).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule) for r in rows] == [(h, p, rule) for _, h, p, rule in LISTED]
    verdicts = {rule: v for v, rule in L.RULES}
    assert all(r.verdict == verdicts[r.rule] for r in rows if r.rule)
    assert all(r.verdict == "allow" for r in rows if not r.host)


def test_ranks_against_a_plain_walk(spark):
    edges = [("a", "b", 2.0), ("a", "c", 1.0), ("b", "c", 1.0), ("c", "a", 1.0), ("d", "a", 1.0), ("b", "e", 3.0)]
    seeds = {"a": 0.7, "d": 0.3, "z": 1.0}
    rank = dict(seeds)
    for _ in range(9):
        total, moved = defaultdict(float), defaultdict(float)
        for s, _, w in edges:
            total[s] += w
        for s, t, w in edges:
            moved[t] += rank.get(s, 0.0) * w / total[s]
        rank = {h: 0.85 * moved[h] + 0.15 * seeds.get(h, 0.0) for h in {*moved, *seeds}}
    got = L.personalised_rank(
        spark.createDataFrame(edges, "src string, dst string, weight double"),
        spark.createDataFrame(list(seeds.items()), "host string, seed double"), rounds=9,
    )
    assert {r.host: r["rank"] for r in got.collect()} == pytest.approx({h: v for h, v in rank.items()})


def test_trust_and_distrust_travel(spark):
    """A host that trusted hosts link to stays; one that links to blocked hosts goes."""
    link = lambda *hosts: " ".join(f'<a href="https://{h}/x">x</a>' for h in hosts)
    rows = [
        (1, "http://good.org/1", link("friend.net", "good.org")), (2, "http://friend.net/", "<a href='/in'>"),
        (3, "http://bad.com/de/1", None), (4, "http://farm.net/a", link("bad.com")), (5, "http://lone.net/", "//"),
    ]
    got = {r.page_id: r for r in L.judge_urls(pages(spark, rows)).collect()}
    assert {i: r.verdict for i, r in got.items()} == {1: "allow", 2: "allow", 3: "block", 4: "block", 5: "allow"}
    assert got[2].trust > 0 and got[4].distrust > 0 and got[5].trust == got[5].distrust == 0


def test_query_keeps_every_page(spark, sf_dir):
    rows = op10_url_filter(spark, sf_dir).collect()
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert sorted(r.page_id for r in rows) == sorted(urls)
    for r in rows:
        rest = urls[r.page_id].split("://", 1)[1]
        host = min((rest.split(c, 1)[0] for c in "/?#"), key=len)
        path = rest[len(host) :]
        assert r.host == host.lower() and r.path == min((path.split(c, 1)[0] for c in "?#"), key=len)
        fits = [
            (len(rule), rule, v)
            for v, rule in L.RULES
            if (r.host == rule.split("/")[0] or r.host.endswith("." + rule.split("/")[0])) and r.path.startswith(rule[rule.index("/") :])
        ]
        assert (r.rule, r.verdict) == max(fits)[1:] if fits else r.rule is None


def test_empty_table(spark):
    assert L.judge_urls(pages(spark, []), rounds=1).count() == 0


def test_plan_is_native(spark, sf_dir):
    plan = op10_url_filter(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
