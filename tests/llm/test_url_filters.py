"""Rules, trees and verdicts of urls."""

import pytest
from pyspark.sql import functions as F

from quayside.llm import queries, url_filters


def judged(spark, urls, **how):
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id bigint, url string")
    return {r.page_id: r for r in url_filters.judge(pages, **how).collect()}


@pytest.mark.parametrize(
    ("url", "host", "path", "rule"),
    [
        ("http://A.Example.COM/en/1?x#y", "a.example.com", "/en/1", "example.com/en/"),
        ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/"),
        ("https://x.www.example.com/en/a", "x.www.example.com", "/en/a", "www.example.com/en/"),
        ("https://wwwexample.com/en/a", "wwwexample.com", "/en/a", "com/"),
        ("http://b.net/es/x", "b.net", "/es/x", "net/es/"),
        ("http://b.net/es", "b.net", "/es", None),
        ("http://net/fr/", "net", "/fr/", "net/fr/"),
        ("http://a.com", "a.com", "", None),
        ("http://a.com?x=/y", "a.com", "", None),
        ("http://a.org/b://c/d", "a.org", "/b://c/d", None),
        ("ÄB://Ö.com/É", "Ö.com", "/É", "com/"),
        ("no-scheme.com/en/", "", "", None),
        (None, "", "", None),
        ("", "", "", None),
    ],
)
def test_host_path_and_rule(spark, url, host, path, rule):
    row = judged(spark, [url])[0]
    assert (row.host, row.path, row.rule) == (host, path, rule)
    if rule:
        assert row.verdict == dict(url_filters.RULES)[rule]


def test_looks(spark):
    df = spark.createDataFrame([("12",), ("12.html",), ("2024-05-01",), ("deadbeef01",), ("a1",), ("about.html",)], "s string")
    got = [r[0] for r in df.select(url_filters.looks(F.col("s"))).collect()]
    assert got == ["{number}", "{number}.html", "{date}", "{hash}", "{mixed}", "about.html"]


def test_templates_of_bad_labels_are_rejected(spark):
    rules = [("a.org/bad/1", "block"), ("a.org/good/1", "allow")]
    urls = [f"http://a.org/{kind}/{k}" for kind in ("bad", "good", "other") for k in [*range(10, 30), *range(200, 220)]]
    rows = judged(spark, urls, rules=rules)
    of = {(r.path.split("/")[1], r.rule is None): r for r in rows.values()}
    assert of["bad", True].verdict == "block" and of["good", True].verdict == "allow" == of["other", True].verdict
    assert of["bad", True].template == "/bad/{number}"


def test_similar_branches_are_merged(spark):
    rules = [("a.org/x/1", "block"), ("a.org/y/1", "block"), ("a.org/z/1", "allow")]
    urls = [f"http://a.org/{b}/{k}" for b in "xyz" for k in [*range(100, 130), *range(200, 230)]]
    found = {r.template for r in judged(spark, urls, rules=rules).values()}
    assert found == {"/(x|y)/{number}", "/z/{number}"}


def test_many_rare_children_become_a_wildcard(spark):
    slugs = [f"{chr(97 + k // 26)}{chr(97 + k % 26)}slug" for k in range(150)]
    urls = [f"http://a.org/post/{s}" for s in slugs] + ["http://a.org/post/index"] * 60
    found = {r.template for r in judged(spark, urls).values()}
    assert found == {"/post/{any}", "/post/index"}


def test_verdicts_follow_from_the_labels_of_a_template(spark, sf_dir):
    """The share of blocked labels, counted again from the rows."""
    rows = queries.queries()["op1_url_filters"](spark, sf_dir.replace("0.001", "0.01")).collect()
    labels = {}
    for r in rows:
        seen = labels.setdefault((r.host, r.template), [0, 0])
        if r.rule:
            seen[0] += 1
            seen[1] += dict(url_filters.RULES)[r.rule] == "block"
    for r in rows:
        n, blocked = labels[r.host, r.template]
        share = (blocked + 1) / (n + 2)
        assert r.blocked_share == pytest.approx(share)
        assert r.verdict == (dict(url_filters.RULES)[r.rule] if r.rule else "block" if share > url_filters.REJECT else "allow")


def test_odd_inputs(spark):
    long = "http://a.org/" + "/".join(f"s{chr(97 + k % 26)}" for k in range(500))
    rows = [(None, None, 1), (1, long, 2), (1, long, 2), (2, "http://", 3), (3, "http://a.org//x///", 4)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host int").selectExpr(
        "*", "'q' as template", "1 as labels", "'c' as key", "'c' as says"
    )
    got = url_filters.judge(pages)
    assert got.count() == 5 and got.where("verdict is null").isEmpty()
    deep = got.where("page_id = 1").first()
    assert deep.path == long[12:] and deep.template.count("/") == 500
    assert got.where("page_id = 3").first().template == "/x"
    assert url_filters.judge(pages.where("page_id = 9")).count() == 0


def test_deep_branches_stay_apart(spark):
    deep = "http://a.org/1/b/c/d/e/f/g/"
    urls = [f"{deep}{kind}/x{k}" for kind in ("good", "bad") for k in range(8)]
    rules = tuple((f"a.org/1/b/c/d/e/f/g/bad/x{k}", "block") for k in range(6)) + tuple(
        (f"a.org/1/b/c/d/e/f/g/good/x{k}", "allow") for k in range(6)
    )
    rows = url_filters.judge(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string"), rules).collect()
    assert {r.template for r in rows} == {"/{number}/b/c/d/e/f/g/good/{mixed}", "/{number}/b/c/d/e/f/g/bad/{mixed}"}
    assert all(r.verdict == ("block" if "/bad/" in r.path else "allow") for r in rows)
