import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from studylake.llm import merkle
from studylake.llm.queries import QUERIES

KIND = "doc_id long, source string, lang string, n_chars long, text string, n long, tree string, leaf int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    parts = []
    for f in merkle.FIELDS:
        body = None if row[f] is None else str(row[f])
        parts.append("-" if body is None else f"{len(body.encode())}:{body}")
    return sha("".join(parts))


def grow(digests):
    """(root, siblings of every leaf as (left, right) per level)."""
    paths = [[] for _ in digests]
    members = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        runs = [range(i, min(i + 8, len(digests))) for i in range(0, len(digests), 8)]
        for run in runs:
            for i in run:
                step = ("".join(digests[j] for j in run if j < i), "".join(digests[j] for j in run if j > i))
                for m in members[i]:
                    paths[m].append(step)
        members = [[m for i in run for m in members[i]] for run in runs]
        digests = [sha("".join(digests[i] for i in run)) for run in runs]
    return digests[0], paths


def brute(rows):
    """(row, leaf, subroot, root, path), for every row."""
    if not rows:
        return []
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda t: t[:3])
        trees[lang] = grow([t[2] for t in groups[lang]])
    root, above = grow([trees[lang][0] for lang in langs])
    return [(t[3], t[2], trees[lang][0], root, path + up)
            for lang, up in zip(langs, above) for t, path in zip(groups[lang], trees[lang][1])]


def folded(digest, path):
    for left, right in path:
        digest = sha(left + digest + right)
    return digest


def wanted(rows):
    found = []
    for r, digest, subroot, root, path in brute(rows):
        changed = dict(r)
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None:
            changed["text"] = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
        back = folded(leaf(changed), path)
        found.append((r["doc_id"], digest, subroot, root, sha("".join(a + b for a, b in path)), back, back == root))
    return found


def test_query_equals_brute_force(spark, small, table):
    df = QUERIES["op13_merkle_manifest"](spark, small)
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = [tuple(r) for r in df.collect()]
    assert sorted(rows) == sorted(wanted(table("documents")))
    assert {r[-1] for r in rows} == {True, False}


def odd(odd_rows, lang):
    return [dict(doc_id=i, source=None if k % 3 else "s", lang=lang(k), n_chars=None if k % 4 else k,
                 text=t, n=1, tree="x", leaf=3) for k, (i, t) in enumerate(odd_rows)]


@pytest.mark.parametrize("lang", [lambda k: None, lambda k: ["de", None, "ée", "", "zz"][k % 5]])
def test_odd_rows(spark, odd_rows, lang):
    rows = odd(odd_rows, lang)
    df = merkle.manifest(spark.createDataFrame(rows, KIND), carry={"doc_id": F.col("doc_id"), "root": F.lit(1)})
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "path"]
    found = [(r[0], r[1], r[2], r[3], [tuple(s) for s in r[4]]) for r in df.collect()]
    assert Counter(map(repr, found)) == Counter(repr((r["doc_id"], *rest)) for r, *rest in brute(rows))


def test_runs_and_heights(spark):
    """Groups of many sizes: last runs of one node, trees of unlike height, one of a single row."""
    rows = [dict(doc_id=i, source="s", lang=f"{n}", n_chars=i, text=f"T{i}", n=1, tree="", leaf=0)
            for n in (1, 2, 8, 9, 64, 65, 73, 600) for i in range(n)]
    df = merkle.manifest(spark.createDataFrame(rows[::-1], KIND)).withColumn(
        "back", merkle.fold(F.col("leaf"), F.col("path")))
    found = {(r["doc_id"], r["subroot"]): r for r in df.collect()}
    assert len(found) == len(rows)
    for r, digest, subroot, root, path in brute(rows):
        seen = found[r["doc_id"], subroot]
        assert (seen["leaf"], seen["root"], seen["back"]) == (digest, root, root)
        assert [tuple(s) for s in seen["path"]] == path


def test_repeated_rows_and_many_groups(spark):
    rows = [dict(doc_id=7, source="s", lang="hot", n_chars=1, text="same", n=1, tree="", leaf=0)] * 90
    rows += [dict(rows[0], lang=f"l{i:03}") for i in range(70)]
    df = merkle.manifest(spark.createDataFrame(rows, KIND))
    found = Counter(repr((r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["path"]])) for r in df.collect())
    assert found == Counter(repr(tuple(rest)) for _, *rest in brute(rows))


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], KIND)).collect() == []


def test_a_change_shows(spark):
    rows = [dict(doc_id=i, source="s", lang="a", n_chars=i, text=f"t{i}", n=1, tree="", leaf=0) for i in range(20)]
    root = lambda rs: merkle.manifest(spark.createDataFrame(rs, KIND)).first()["root"]
    assert root(rows) != root([*rows[:-1], dict(rows[-1], text="t20")])


def test_plan(spark, small):
    """No Python on the executors, and no window wider than a run."""
    df = merkle.manifest(spark.read.parquet(f"{small}/documents.parquet"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert all("tree" in line and "run" in line for line in plan.splitlines() if "Window [" in line)
