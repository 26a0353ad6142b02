import random
import re

import numpy as np
import pytest

from studylake.llm import near_dedup
from studylake.llm.components import components
from studylake.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows, k=2, percent=80):
    """{key: (set size, least reachable key)} by comparing all pairs."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b:
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    x, y = sorted((root(i), root(j)))
                    parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets}


def check(found, rows, k=2):
    wanted = brute(rows, k)
    assert len(found) == len(rows)
    for r in found:
        size, component = wanted[r["doc_id"]]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (
            size, component, component == r["doc_id"]), r


def test_query_equals_all_pairs(spark, small, table):
    rows = [(r["doc_id"], r["text"]) for r in table("documents")]
    check(QUERIES["op3_near_dedup"](spark, small).collect(), rows)


def test_groups_of_edited_copies(spark, documents):
    draw = random.Random(3)
    rows = []
    for group in range(12):
        base = [f"g{group}w{draw.randrange(400)}" for _ in range(draw.choice([6, 12, 40, 150, 600]))]
        for _ in range(draw.choice([1, 5, 25])):
            copy = list(base)
            for _ in range(draw.randrange(0, max(1, len(base) // 12) + 1)):
                copy[draw.randrange(len(copy))] = f"x{draw.randrange(10 ** 6)}"
            rows.append((len(rows) * 3 + 5, " ".join(copy)))
    draw.shuffle(rows)
    found = near_dedup.near_duplicates(documents(rows), shingle=2).collect()
    check(found, rows)


def test_chain_that_no_hub_joins(spark, documents):
    """Neighbours are linked, ends are not; all lie in shared buckets."""
    words = [f"w{i}" for i in range(400)]
    rows = [(100 - n, " ".join(words[n * 12:n * 12 + 200])) for n in range(12)]
    check(near_dedup.near_duplicates(documents(rows), shingle=2).collect(), rows)


def test_template_pages_do_not_meet(spark, documents):
    """100 common and 18 own words: similarity 0.72, so the common words must not join all pages."""
    from pyspark.sql import functions as F

    n, own = 118, 18
    prefix = n - -(-80 * n // 100) + 1
    rows = spark.range(300).select(
        F.col("id").alias("x"), F.lit(n).alias("nx"), F.explode(F.sequence(F.lit(own), F.lit(prefix - 1))).alias("place"))
    fitting = near_dedup._fitting_bands(rows.withColumn("rx", F.col("nx") - F.col("place")), 80)
    assert fitting.count() > 0
    assert fitting.filter(F.col("band") >= near_dedup._size_band(F.lit(n))).count() == 0


def test_bands_lose_no_size(spark):
    from pyspark.sql import functions as F

    rows = spark.range(1, 60).select(F.col("id").alias("nx")).withColumn(
        "rx", F.explode(F.sequence(F.lit(1), F.col("nx"))))
    bands = near_dedup._fitting_bands(rows, 80).collect()
    found = {(r["nx"], r["rx"], r["band"]) for r in bands}
    band_of = {r["id"]: r["b"] for r in spark.range(1, 90).select("id", near_dedup._size_band(F.col("id")).alias("b")).collect()}
    for nx in range(1, 60):
        for rx in range(1, nx + 1):
            for m in range(1, 90):
                if 100 * min(m, nx) >= 80 * max(m, nx) and rx * 180 >= (nx + m) * 80:
                    assert (nx, rx, band_of[m]) in found


def test_odd_rows(spark, documents, odd_rows):
    found = near_dedup.near_duplicates(documents(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    for r in found:
        assert r["kept"] and r["component_id"] == r["doc_id"]
    assert sorted(r["n_shingles"] for r in found if r["doc_id"] in (1, 2, 3)) == [0, 0, 0]
    assert near_dedup.near_duplicates(documents([])).count() == 0


def test_equal_texts_are_one_group_and_one_row_stays(spark, documents):
    rows = [(i, "The same text in every row, word for word") for i in range(9, 0, -1)]
    rows += [(20, "the SAME text in every row, word for WORD"), (21, None), (22, ""), (None, "same")]
    kept = near_dedup.keep_one(documents(rows)).collect()
    assert {r["doc_id"] for r in kept} == {1, 21, 22, None}


def test_sketches_estimate_similarity():
    draw = np.random.default_rng(5)
    for size in (100, 3000):
        for share in (0.3, 0.8, 0.95):
            both = draw.integers(0, 2 ** 63, int(size * share), dtype=np.uint64)
            one, other = (np.unique(np.concatenate([both, draw.integers(
                0, 2 ** 63, (size - len(both)) // 2, dtype=np.uint64)]) * np.uint64(2)) for _ in "ab")
            true = len(np.intersect1d(one, other)) / len(np.union1d(one, other))
            sketch = [near_dedup.registers(x)[None, :] for x in (one, other)]
            assert abs(near_dedup.estimate(*sketch)[0] - true) < 0.12


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)]
    links = spark.createDataFrame(path + star + [(5, 5), (None, 3)], "a long, b long")
    found = {r["node"]: r["label"] for r in components(links).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 260)]}


def test_components_without_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("shingle", [1, 5])
def test_other_shingles(spark, documents, shingle):
    draw = random.Random(8)
    base = [f"w{draw.randrange(90)}" for _ in range(120)]
    rows = [(i, " ".join(base[:i * 4] + [f"n{i}"] + base[i * 4:])) for i in range(20)]
    check(near_dedup.near_duplicates(documents(rows), shingle=shingle).collect(), rows, shingle)
