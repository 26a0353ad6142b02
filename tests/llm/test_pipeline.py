import random

import pytest

import corpus_pipeline
import test_decontamination as decontamination_test
import test_line_passages as line_test
import test_near_dedup as near_test
import test_quality_rules as quality_test
from studylake.llm.queries import QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def expected(docs, items):
    """The rows that reach the last stage, by brute force: {doc_id: text}."""
    kept = [(r["doc_id"], r["text"]) for r in docs if quality_test.verdict(r["text"])[1]]
    cleaned = line_test.brute(kept)
    kept = [(i, t) for i, (_, n, t) in sorted(cleaned.items()) if not n or t.encode().split()]
    groups = near_test.brute(kept, k=5)
    kept = [(i, t) for i, t in kept if groups[i][1] == i]
    hits = decontamination_test.brute([t for _, t in kept], items)
    return {i: t for (i, t), (_, n_hit, _) in zip(kept, hits, strict=True) if not n_hit}


def test_stages_in_order():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "near dedup", "decontamination", "bpe"]


def test_pipeline_equals_brute_force(spark, small, table):
    from tokenizers import Tokenizer
    import numpy as np
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    items = [(r["item_id"], r["text"]) for r in table("benchmark")]
    wanted = expected(table("documents"), items)
    rows = corpus_pipeline.run(spark, small).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(wanted)
    for r in rows:
        ids = tokenizer.encode(wanted[r["doc_id"]], add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids)
        assert r["decoded"] == tokenizer.decode(ids, skip_special_tokens=False)
        assert r["n_chars"] == len(wanted[r["doc_id"]])


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_every_stage_takes_odd_rows(spark, small, name, stage):
    draw = random.Random(name)
    text = " ".join(f"w{draw.randrange(10 ** 6)}" for _ in range(300))
    rows = [(1, None), (2, ""), (3, text), (3, text), (None, text + " end"), (None, None), (4, " \n "),
            (5, "\n".join([text] * 3))]
    docs = spark.createDataFrame(
        [(i, t, None, None, None, "extra") for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, ids string")
    out = stage(spark, docs, small)
    out.collect()
    if name != "bpe":
        assert [c for c in out.columns if c != "ids"] == COLUMNS
    assert stage(spark, docs.limit(0), small).count() == 0


def test_planted_cases(spark, small):
    """Copies, benchmark passages and repeated passages go; the clean documents stay as they are."""
    draw = random.Random(21)
    item = spark.read.parquet(f"{small}/benchmark.parquet").first()["text"]
    prose = lambda n: "\n".join(
        " ".join(f"p{draw.randrange(10 ** 7)}" for _ in range(25)) for _ in range(n))
    clean = [(i, prose(6)) for i in range(20)]
    base = prose(10)
    edited = base.split(" ")
    edited[40] = "changed"
    passage = " ".join(f"q{i}" for i in range(60))
    planted = [(100, base), (101, base), (102, " ".join(edited)), (103, prose(3) + "\n" + item),
               (104, prose(3) + "\n" + passage), (105, prose(3) + "\n" + passage)]
    docs = spark.createDataFrame(
        [(i, t, "en", "s", len(t)) for i, t in clean + planted],
        "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    near = {r["doc_id"] for r in stages["near dedup"](spark, docs, small).collect()}
    assert {i for i, _ in clean} <= near and near & {100, 101, 102} == {100}
    bench = {r["doc_id"] for r in stages["decontamination"](spark, docs, small).collect()}
    assert bench == {i for i, _ in clean + planted} - {103}
    lines = {r["doc_id"]: r["text"] for r in stages["line dedup"](spark, docs, small).collect()}
    assert all(lines[i] == t for i, t in clean) and 101 not in lines
    assert passage in lines[104] and passage not in lines[105]


def test_registered(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op")}
    assert set(QUERIES) <= names
