import collections
import zlib

import numpy as np
import pytest

from studylake.llm import language_id
from studylake.llm.queries import QUERIES


def test_held_out_accuracy(spark, small, table):
    langs = {r["doc_id"]: r["lang"] for r in table("documents")}
    rows = QUERIES["op8_language_id"](spark, small).collect()
    assert len(rows) == len(langs)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in langs if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


TRAIN = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate([
    ("the cat sat on the mat and the hat", "en"), ("that is the thing with the other", "en"),
    ("die katze sitzt auf der matte und", "de"), ("das ist nicht der hund und die maus", "de"),
    (None, "en"), ("words without a language", None), ("", "de")] * 3)]
KIND = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def model(spark):
    return language_id.fit(spark.createDataFrame(TRAIN, KIND))


def test_arrays_are_sorted(model):
    assert model.languages == ["de", "en"]
    for keys, values in [*model.shares, *model.weights]:
        assert (np.diff(keys.astype(object)) > 0).all() and len(keys) == len(values)


def brute(order=4):
    """Interpolated Kneser-Ney by its definition, from dictionaries."""
    counts = {}
    for _, text, lang, *_ in TRAIN:
        if text is None or lang is None:
            continue
        for word in text.lower().split():
            s = f"\x02{word}\x03"
            for end in range(2, len(s) + 1):
                for start in range(max(0, end - order), end):
                    counts[lang, s[start:end]] = counts.get((lang, s[start:end]), 0) + 1
    used = {}
    for (lang, gram), c in counts.items():
        if len(gram) < order and gram[0] != "\x02":
            c = len({g[0] for (x, g) in counts if x == lang and len(g) == len(gram) + 1 and g[1:] == gram})
        if c:
            used[lang, gram] = c

    def chance(lang, gram):
        if not gram:
            return 1 / language_id.CHARACTERS
        n = len(gram)
        own = {g: c for (x, g), c in used.items() if x == lang and len(g) == n}
        after = {g: c for g, c in own.items() if g[:-1] == gram[:-1]}
        lower = chance(lang, gram[1:])
        if not after:
            return lower
        ones = max(1, sum(c == 1 for c in own.values()))
        discount = ones / (ones + 2 * max(1, sum(c == 2 for c in own.values())))
        total = sum(after.values())
        return max(own.get(gram, 0) - discount, 0) / total + discount * len(after) / total * lower

    def bits(lang, word):
        s = f"\x02{word}\x03"
        return -sum(np.log2(chance(lang, s[max(0, end - order):end])) for end in range(2, len(s) + 1))

    return bits


def test_costs_equal_the_definition(model):
    bits = brute()
    words = ["the", "katze", "other", "zzz", "a", "thematte", "é", "12"]
    wanted = [[bits(lang, w) for lang in model.languages] for w in words]
    assert np.allclose(model.bits(words), wanted, rtol=1e-9)


def test_predictions(spark, model):
    rows = [(1, "the mat with the cat", "clash", 1.0), (2, "die maus und der hund", "x", 1.0),
            (3, None, "x", 1.0), (4, "123 !! _", "x", 1.0), (5, "", "x", 1.0), (None, "The Hat", "x", 1.0),
            (6, "the " * 30_000 + "und", "x", 1.0), (6, "the " * 30_000 + "und", "x", 1.0),
            (7, "\u4e2d\u6587\u5b57\u7b26 \u4e2d\u6587", "x", 1.0)]
    df = language_id.predict(
        spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double"), model)
    assert df.columns == ["doc_id", "text", "lang_pred", "score", "entropy", "rejected"]
    found = collections.defaultdict(set)
    for r in df.collect():
        found[r["doc_id"]].add((r["lang_pred"], r["rejected"]))
    assert {k: {p for p, _ in v} for k, v in found.items() if k != 7} == {
        1: {"en"}, 2: {"de"}, 3: {"und"}, 4: {"und"}, 5: {"und"}, None: {"en"}, 6: {"en"}}
    assert {x for _, x in found[7]} == {True}  # a script that no model knows


def test_empty_tables(spark, model):
    empty = spark.createDataFrame([], KIND)
    assert language_id.predict(empty, model).count() == 0
    untrained = language_id.fit(empty)
    rows = language_id.predict(spark.createDataFrame(TRAIN[:2], KIND), untrained).collect()
    assert {(r["lang_pred"], r["score"]) for r in rows} == {("und", 0.0)}


def test_the_sample_is_bounded(spark):
    rows = [(i, f"text number {i}", "en" if i % 10 else "de", "s", 1) for i in range(5000)]
    drawn = language_id.sample(spark.createDataFrame(rows, KIND), "text", "lang", 300).groupBy("lang").count()
    found = {r["lang"]: r["count"] for r in drawn.collect()}
    assert 200 < found["en"] < 400 and 200 < found["de"] < 400
