"""Repeated passages of lines, against a version that looks at every window."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from studylake.llm import line_dedup
from studylake.llm.queries import QUERIES


def units(text):
    """[line, line and the blank lines after it] per line with words."""
    out = []
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            out.append([line, line])
        elif out:
            out[-1][1] += "\n" + line
    return out


def long_runs(cut, gone):
    """Lines of neighbouring runs of at least LEAST_WORDS words."""
    out, run = set(), []
    for k in range(len(cut) + 1):
        if k in gone:
            run.append(k)
            continue
        if sum(len(cut[j][0].encode().split()) for j in run) >= line_dedup.LEAST_WORDS:
            out.update(run)
        run = []
    return out


def brute(rows):
    """{key: (lines with words, removed, text)}; distinct keys, NULL first, and no blank lines at the top."""
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        cut = units(text or "")
        gone = set()
        for k, (line, whole) in enumerate(cut):
            if k + 1 < len(cut):
                window = f"{whole}\n{cut[k + 1][0]}"
                gone |= {k, k + 1} if window in seen else set()
                seen.add(window)
            if len(line.encode().split()) >= line_dedup.LONG_LINE:
                gone |= {k} if line in seen else set()
                seen.add(line)
        if len(gone) < len(cut):
            gone = long_runs(cut, gone)
        rest = "\n".join(whole for k, (_, whole) in enumerate(cut) if k not in gone)
        out[key] = len(cut), len(gone), rest if gone else text
    return out


def result(df):
    return {r["doc_id"]: (r["n_chunks"], r["n_removed"], r["text"]) for r in df.collect()}


def liner(draw):
    return lambda: " ".join(f"w{draw.randrange(10 ** 7)}" for _ in range(draw.randrange(3, 12)))


def test_query_equals_brute_force(spark, small, table):
    wanted = brute([(r["doc_id"], r["text"]) for r in table("documents")])
    for r in QUERIES["op9_line_dedup"](spark, small).collect():
        n, removed, text = wanted[r["doc_id"]]
        assert (r["n_chunks"], r["n_removed"]) == (n, removed)
        assert r["text_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6])
def test_short_passages_go_whole_in_any_context(spark, documents, n):
    draw = random.Random(n)
    line = liner(draw)
    shared = [line() for _ in range(n)]
    while sum(len(x.split()) for x in shared) < line_dedup.LEAST_WORDS:
        shared = [line() for _ in range(n)]
    around = [([line() for _ in range(draw.randrange(0, 5))], [line() for _ in range(draw.randrange(0, 5))])
              for _ in range(60)]
    rows = [(i, "\n".join(a + shared + b)) for i, (a, b) in enumerate(around)]
    found = result(line_dedup.remove_repeated_passages(documents(rows)))
    assert found[0] == (len(around[0][0] + shared + around[0][1]), 0, rows[0][1])
    for i, (a, b) in enumerate(around[1:], 1):
        assert found[i][1:] == (n, "\n".join(a + b))


def test_blank_lines_repeats_and_null_keys(spark, documents):
    block = "first line here\n\nsecond line here of some more words\nthird line here and more"
    rows = [(1, "\n\n" + block + "\nown end of some six words"), (2, "own start\n \n" + block + "\n\nanother end"),
            (3, "\n".join([block] * 4)), (4, "first line here\nsecond line here of some more words"),
            (5, "third line here and more"), (None, "third line here and more\nown end of some six words"),
            (6, "\n".join(["same line of six whole words"] * 3)), (7, None), (8, ""), (9, " \n\n")]
    found = result(line_dedup.remove_repeated_passages(documents(rows)))
    assert found[None][1] == 0  # NULL keys come first
    assert found[1] == (4, 2, "\n\nfirst line here\n\nsecond line here of some more words")
    assert found[2] == (5, 3, "own start\n \nanother end")
    assert found[3] == brute(rows)[3]
    assert found[4][1] == found[5][1] == 0  # other bytes between the lines; one short line
    assert found[6] == (3, 2, "same line of six whole words")
    assert [found[i] for i in (7, 8, 9)] == [(0, 0, None), (0, 0, ""), (0, 0, " \n\n")]


def test_short_lines_that_meet_by_chance_stay(spark, documents):
    """Few words between other lines stay; a text that is nothing else goes."""
    code = [f"def f{i}(a{i}):\n  for x{i} in a{i}:\n    if x{i}:\n      g{i}(x{i})\n    }}\n  }}\n}}" for i in range(5)]
    talk = [f"Is it number {i} on the list?\nYes.\nNo.\nThen what of {i} more?" for i in range(5)]
    rows = list(enumerate([*code, *talk, "Yes.\nNo.", "Yes.\nNo."]))
    found = result(line_dedup.remove_repeated_passages(documents(rows)))
    assert found == brute(rows)
    assert all(found[i][1:] == (0, text) for i, text in rows[:10])
    assert [found[i][2] for i in (10, 11)] == ["", ""]


def test_only_bytes_decide(spark, documents, monkeypatch):
    """With a hash that is always the same, the result is still that of the texts."""
    draw = random.Random(3)
    pool = [liner(draw)() for _ in range(12)] + [" ".join(f"p{i}" for i in range(60))]
    rows = [(i, "\n".join(draw.choice(pool) for _ in range(draw.randrange(1, 9)))) for i in range(40)]
    assert result(line_dedup.remove_repeated_passages(documents(rows))) == brute(rows)
    monkeypatch.setattr(line_dedup, "_window_hash", lambda c: F.when(c.isNotNull(), F.lit(7).cast("long")))
    assert result(line_dedup.remove_repeated_passages(documents(rows))) == brute(rows)


def test_odd_rows(spark, documents, odd_rows):
    rows = line_dedup.remove_repeated_passages(documents(odd_rows)).collect()
    assert sorted(repr(r["text"]) for r in rows) == sorted(repr(t) for _, t in odd_rows)
    assert line_dedup.remove_repeated_passages(documents([])).count() == 0


def test_exact_copies_leave_nothing(spark, documents, small):
    """Every later copy of a text of several lines goes whole, in the pipeline its row too."""
    import corpus_pipeline

    draw = random.Random(8)
    line = liner(draw)
    texts = ["\n".join(line() for _ in range(draw.randrange(2, 30))) for _ in range(100)]
    texts += ["\n\n" + texts[0] + "\n \n", "a b\n\nc d"]
    rows = [(1000 * copy + i, t) for copy in range(3) for i, t in enumerate(texts)]
    found = result(line_dedup.remove_repeated_passages(documents(rows)))
    assert all(found[1000 * copy + i][2] == "" for copy in (1, 2) for i in range(len(texts)))
    assert all(found[i] == (len(units(t)), 0, t) for i, t in enumerate(texts[:100]))
    kept = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["line dedup"](
        spark, documents(rows).select("doc_id", "text", "lang", "source", "n_chars"), small).collect()}
    assert kept == set(range(100)) | {101}
