import re

import pytest

from studylake.llm import url_filters
from studylake.llm.queries import QUERIES

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    return host.translate(UPPER), path


def rule(host, path):
    fits = []
    for text, verdict in RULES.items():
        domain, _, start = text.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
            fits.append((len(text), text, verdict))
    return max(fits)[1:] if fits else (None, None)


@pytest.fixture(scope="module")
def judge(spark):
    def run(urls):
        pages = spark.createDataFrame(
            [(i, u, "mine", "theirs") for i, u in enumerate(urls)],
            "page_id long, url string, host string, _domain string")
        return url_filters.judge_urls(pages, url_filters.rule_table(spark, RULES))
    return run


def test_query_equals_the_rules(spark, small, table):
    urls = {r["page_id"]: r["url"] for r in table("pages")}
    rows = QUERIES["op7_url_filters"](spark, small).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(urls)
    for r in rows:
        host, path = parts(urls[r["page_id"]])
        name, verdict = rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, name)
        assert r["verdict"] == (verdict or ("block" if r["template_share"] >= url_filters.PURITY
                                            else "allow"))


ODD = [
    None, "", "no scheme", "://", "http://", "http://a.b", "http://EXAMPLE.net/en/x",
    "http://example.net/en", "http://example.net?x=/en/", "https://x.EXAMPLE.Com/de/1#f",
    "ftp://notexample.com/de/1", "http://net", "http://net/", "a://b://c.net/d", "http://org/fr/",
    "http://u.org/fr/a/b/c/d/e/f/g/h/i/j/k/l", "http://x.net\n/en/", "http://ÉX.net/É?É#É",
    "http://" + "a." * 30 + "net/" + "s/" * 3000,
]


def test_odd_urls(judge):
    rows = judge([*ODD, *ODD]).collect()
    assert len(rows) == 2 * len(ODD)
    for r in rows:
        host, path = parts(r["url"])
        name, verdict = rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, name), r["url"]
        assert r["verdict"] == (verdict or r["verdict"]) and r["verdict"] in ("allow", "block")
    assert judge(ODD).columns == ["page_id", "url", "_domain", "host", "path", "rule", "template",
                                  "template_share", "verdict"]


def test_empty_table_and_no_rules(spark, judge):
    assert judge([]).count() == 0
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    none = url_filters.judge_urls(pages, url_filters.rule_table(spark, {"zz/": "block"}).limit(0))
    assert [(r["rule"], r["verdict"]) for r in none.collect()] == [(None, "allow")]


def templates(spark, rows):
    places = spark.createDataFrame(rows, "host string, path string, bad int")
    return {r["path"]: r["template"] for r in url_filters.with_templates(places).collect()}


def test_variable_segments_become_wildcards(spark):
    found = templates(spark, [
        ("h", "/en/825", None), ("h", "/en/2024-05-06/a.html", None), ("h", "/en/deadbeef01", None),
        ("h", "/en/12.html", None), ("h", "/about/team", None), ("h", "/", None), ("h", "", None)])
    assert found == {
        "/en/825": "/en/*", "/en/2024-05-06/a.html": "/en/*/a.html", "/en/deadbeef01": "/en/*",
        "/en/12.html": "/en/*", "/about/team": "/about/team", "/": "", "": ""}


def test_many_distinct_siblings_are_a_wildcard(spark):
    found = templates(spark, [("h", f"/user/name{chr(97 + i)}x", None) for i in range(25)])
    assert set(found.values()) == {"/user/*"}


def test_similar_branches_merge_and_different_ones_stay(spark):
    rows = [("h", f"/{seg}/{i}", bad) for seg, bad in
            [("spam", 1), ("scam", 1), ("news", 0), ("blog", 0)] for i in range(40)]
    rows += [("h", f"/plain/{i}", None) for i in range(40)]
    found = set(templates(spark, rows).values())
    # each is unlike the rest of its siblings taken together, and the unlabelled one has no share
    assert found == {"/spam/*", "/scam/*", "/news/*", "/blog/*", "/plain/*"}
    rows = [("h", f"/{seg}/{i}", int(i % 2 == 0)) for seg in ("a", "b", "c") for i in range(40)]
    assert set(templates(spark, rows).values()) == {"/*/*"}


def test_a_pure_template_decides_for_urls_without_a_rule(judge):
    """``/de`` alone is judged by no rule, but by its template."""
    urls = [f"http://a.example.com/de/{i}" for i in range(30)] + ["http://a.example.com//de//77"]
    urls += [f"http://a.example.com/en/{i}" for i in range(30)]
    by_url = {r["url"]: r for r in judge(urls).collect()}
    odd = by_url["http://a.example.com//de//77"]
    assert odd["rule"] is None and odd["verdict"] == "block" and odd["template_share"] > 0.9
    assert by_url["http://a.example.com/en/3"]["verdict"] == "allow"


def test_no_python_on_the_executors(spark, small):
    plan = QUERIES["op7_url_filters"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
