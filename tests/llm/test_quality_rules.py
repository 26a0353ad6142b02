import collections
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from studylake.llm import quality_rules
from studylake.llm.queries import QUERIES


def statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def verdict(text):
    n_words, chars, symbols, dup_lines, repeated = statistics(text)
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    base = n_words < 20 or 100 * repeated > 30 * n_words
    stutter = sum(a == b for a, b in zip(words, words[1:], strict=False))
    other = (100 * symbols > 5 * chars or 100 * len(re.findall("[A-Z]", text)) > 40 * chars
             or 100 * dup_lines > 50 * len(lines) or 100 * stutter > 20 * n_words)
    return base, not base and not other


def test_query_equals_brute_force(spark, small, table):
    texts = {r["doc_id"]: r["text"] for r in table("documents")}
    rows = QUERIES["op5_quality_rules"](spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:6] == statistics(texts[r["doc_id"]])
        assert (r["base_failed"], r["kept"]) == verdict(texts[r["doc_id"]])


def test_no_python_on_the_executors(spark, small):
    plan = QUERIES["op5_quality_rules"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_kept_rows_match_the_labels(spark, small, table):
    good = {r["doc_id"]: r["quality"] for r in table("labels")}
    rows = QUERIES["op5_quality_rules"](spark, small).collect()
    judged = [(r["kept"], good[r["doc_id"]]) for r in rows if r["doc_id"] in good
              and not r["base_failed"]]
    assert sum(k == bool(g) for k, g in judged) >= 0.98 * len(judged)


def test_odd_rows(spark, documents, odd_rows):
    df = quality_rules.with_verdict(documents(odd_rows))
    assert df.columns == [*documents(odd_rows).columns, "rejected_by"]
    rows = df.collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert (r["rejected_by"] is None) == verdict(r["text"])[1], r["text"][:40]
    assert quality_rules.keep_good(documents([])).count() == 0
    kept = quality_rules.keep_good(documents(odd_rows))
    assert kept.columns == documents(odd_rows).columns


def test_order_changes_cost_only(spark, documents, odd_rows):
    df = documents(odd_rows)
    ordered = quality_rules.order_rules(df)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in quality_rules.RULES)
    body = quality_rules.Text(F.coalesce("text", F.lit("")))
    any_rule = F.lit(False)
    for rule in quality_rules.RULES:
        any_rule = any_rule | rule.rejects(body)
    kept = quality_rules.keep_good(df).count()
    assert kept == df.filter(~any_rule).count()


def test_rules_that_reject_more_for_less_come_first(spark, documents):
    slow = quality_rules.Rule("slow", lambda t: (t.n_repeat_words >= 0) & (t.n_words < 0))
    sure = quality_rules.Rule("sure", lambda t: t.text != "")
    df = documents([(i, "some words " * 500) for i in range(50)])
    assert [r.name for r in quality_rules.order_rules(df, [slow, sure])] == ["sure", "slow"]
    assert quality_rules.order_rules(documents([]), [slow, sure]) == [slow, sure]


def test_windows_that_overlap_and_touch(spark, documents):
    draw = [
        "a b c d e f g h " * 3, "a " * 30, "a b " * 12, " ".join(map(str, range(100))),
        " ".join([*map(str, range(20)), *map(str, range(12)), "x", *map(str, range(4, 12))]),
        " ".join(map(str, [*range(8), 99, *range(8), *range(8)])), "a b c d e f g h",
        "a b c d e f g h a b c d e f g", "one\n\none\n \n two \n two \ntwo",
    ]
    df = quality_rules.with_statistics(documents(list(enumerate(draw))))
    for r in df.collect():
        assert tuple(r[c] for c in quality_rules.STATISTICS) == statistics(r["text"])


@given(st.lists(st.text(alphabet="ab \n\t#é", max_size=80), min_size=1, max_size=20))
@settings(max_examples=8, deadline=None)
def test_any_text(spark, documents, texts):
    df = quality_rules.with_statistics(documents(list(enumerate(texts))))
    for r in df.collect():
        assert tuple(r[c] for c in quality_rules.STATISTICS) == statistics(r["text"])
