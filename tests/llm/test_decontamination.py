import hashlib
import random
import re

import pytest

from studylake.llm import decontamination
from studylake.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items):
    """[(n_words, n_hit, sorted items)] in the order of ``docs``."""
    windows = {}
    for item, text in items:
        own = words(text)
        size = min(10, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            windows.setdefault(tuple(own[i:i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for text in docs:
        own, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                here = windows.get(tuple(own[i:i + size]))
                if here:
                    hit.update(range(i, i + size))
                    found |= here
        out.append((len(own), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def test_query_equals_brute_force(spark, small, table):
    docs = table("documents")
    wanted = brute([r["text"] for r in docs], [(r["item_id"], r["text"]) for r in table("benchmark")])
    rows = {r["doc_id"]: r for r in QUERIES["op6_decontamination"](spark, small).collect()}
    assert len(rows) == len(docs)
    for doc, (n_words, n_hit, items) in zip(docs, wanted, strict=True):
        r = rows[doc["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (
            n_words, n_hit, len(items), n_hit > 0)
        assert r["items_sha256"] == hashlib.sha256(",".join(items).encode()).hexdigest()


@pytest.fixture(scope="module")
def cases():
    draw = random.Random(11)
    some = lambda n: [f"w{draw.randrange(60)}" for _ in range(n)]
    items = [(i, " ".join(some(draw.choice([1, 3, 7, 9, 10, 11, 25, 60])))) for i in range(25)]
    items += [(25, None), (26, ""), (27, "... !!"), (None, " ".join(some(15))), (3, " ".join(some(12)))]
    docs = []
    for i in range(120):
        body = [f"d{draw.randrange(3000)}" for _ in range(draw.randrange(0, 60))]
        for _ in range(draw.randrange(3)):
            text = (draw.choice(items)[1] or "").split()
            start = draw.randrange(max(1, len(text)))
            at = draw.randrange(len(body) + 1)
            body[at:at] = text[start:start + draw.choice([5, 9, 10, 14, 80])]
        docs.append((i, ", ".join(body).upper() if i % 4 == 0 else "  ".join(body)))
    return docs, items


def found(spark, docs, items):
    benchmark = spark.createDataFrame(
        [(i, t, "clash") for i, t in items], "item_id long, text string, doc_id string")
    return decontamination.find_contamination(docs, benchmark)


def test_short_items_overlaps_and_case(spark, documents, cases):
    docs, items = cases
    wanted = dict(zip([d for d, _ in docs], brute([t for _, t in docs], items), strict=True))
    rows = found(spark, documents(docs), items).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r["n_words"], r["n_hit"], list(r["items"])) == wanted[r["doc_id"]]
        assert all(0 <= s["start"] and s["start"] + s["size"] <= r["n_words"] for s in r["spans"])


def test_full_bitmap_changes_nothing(spark, documents, cases, monkeypatch):
    """Where every fingerprint passes the bitmap, the join alone decides."""
    import numpy as np

    docs, items = cases
    wanted = dict(zip([d for d, _ in docs], brute([t for _, t in docs], items), strict=True))
    monkeypatch.setattr(decontamination, "_bitmap",
                        lambda known: np.full(1 << 10, 2 ** 64 - 1, dtype=np.uint64))
    for r in found(spark, documents(docs), items).collect():
        assert (r["n_words"], r["n_hit"], list(r["items"])) == wanted[r["doc_id"]]


def test_odd_rows(spark, documents, odd_rows):
    items = [(1, "six words"), (2, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11")]
    rows = found(spark, documents(odd_rows), items).collect()
    wanted = brute([t for _, t in odd_rows], items)
    assert sorted(map(repr, wanted)) == sorted(
        repr((r["n_words"], r["n_hit"], list(r["items"]))) for r in rows)
    assert found(spark, documents([]), items).count() == 0
    assert all(r["n_hit"] == 0 for r in found(spark, documents(odd_rows), []).collect())


def test_filter_keeps_clean_rows_as_they_are(spark, documents, odd_rows):
    benchmark = spark.createDataFrame([(1, "Nameless text of six words here")], "item_id long, text string")
    docs = documents([*odd_rows, (50, "x nameless, text of six WORDS here y")])
    kept = decontamination.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len(odd_rows) - 1
    assert not any("ameless" in (r["text"] or "") for r in rows)


def test_fingerprints_are_the_first_least_grams_of_the_windows():
    import numpy as np

    draw = random.Random(5)
    texts = [[draw.randrange(9) for _ in range(n)] for n in (0, 4, 9, 10, 11, 0, 400, 3000)]
    bounds = np.cumsum([0, *map(len, texts)])
    words_of = np.array([w for t in texts for w in t], dtype=np.uint64)
    places, marks = decontamination._winnow(words_of, bounds)
    grams = decontamination.combine(words_of, decontamination.GRAM)
    wanted = set()
    for text, start in zip(texts, bounds, strict=False):
        for i in range(start, start + len(text) - 9):
            wanted.add(min(range(i, i + 6), key=lambda p: (grams[p], p)))
    assert places.tolist() == sorted(wanted) and (marks == grams[places]).all()
    assert len(places) < len(words_of) / 2


def test_a_phrase_in_many_contexts(spark, documents):
    """Fingerprints of the phrase meet everywhere, but only equal reaches are hits."""
    phrase = "one of the most common"
    items = [(i, f"a{i} b{i} c{i} d{i} {phrase} e{i} f{i} g{i} h{i}") for i in range(200)]
    docs = [(i, f"x{i} d{i} {phrase} e{i} f{i} g{i} h{i % 50} y{i}") for i in range(200)]
    wanted = brute([t for _, t in docs], items)
    rows = {r["doc_id"]: r for r in found(spark, documents(docs), items).collect()}
    assert [(r["n_words"], r["n_hit"], list(r["items"])) for _, r in sorted(rows.items())] == wanted
    assert sum(r["n_hit"] > 0 for r in rows.values()) == 50
