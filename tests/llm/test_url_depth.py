from studylake.llm import url_filters


def test_deep_segments_count(spark):
    """Urls that differ from the ninth segment on have templates, shares and verdicts of their own."""
    top = "/" + "/".join(f"s{i}" for i in range(9))
    urls = [f"http://h.org{top}/{kind}/p{i}/17" for kind in ("bad", "good") for i in range(30)]
    urls += [f"http://h.org{top}", "http://h.org" + "/x" * 300]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = url_filters.rule_table(spark, {f"org{top}/bad/": "block", f"org{top}/good/": "allow"})
    found = {r["page_id"]: r for r in url_filters.judge_urls(pages, rules).collect()}
    assert {found[i]["template"] for i in range(30)} == {f"{top}/bad/*/*"}
    assert {found[i]["template"] for i in range(30, 60)} == {f"{top}/good/*/*"}
    assert {found[i]["template_share"] for i in range(30)} == {31 / 32}
    assert {found[i]["template_share"] for i in range(30, 60)} == {1 / 32}
    assert found[60]["template"] == top and found[61]["template"] == "/x" * 300
