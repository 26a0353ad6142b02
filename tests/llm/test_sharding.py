import collections
import re
import zlib

import pytest

from studylake.llm import sharding
from studylake.llm.queries import QUERIES


def check(rows, shards):
    by_shard = collections.defaultdict(list)
    for r in rows:
        by_shard[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], shards)
    for slots in by_shard.values():
        assert sorted(slots) == list(range(len(slots)))
    assert set(by_shard) <= set(range(shards))


def test_query(spark, small, table):
    rows = QUERIES["op10_sharding"](spark, small).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in table("documents")}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    check(rows, 40)
    for r in rows:
        body = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"]) == (len(body) + 16, zlib.crc32(body), "key")


def test_key_and_count_alone_decide(spark, documents):
    rows = [(i, f"text {i}") for i in range(300)]
    one = {r["doc_id"]: r for r in sharding.shuffle_into_shards(documents(rows), 7).collect()}
    other = [(i, f"quite another {i}") for i in range(299, 100, -1)]
    two = sharding.shuffle_into_shards(documents(other), 7, seed=5).collect()
    grown = {r["doc_id"]: r["shard"] for r in sharding.shuffle_into_shards(documents(rows), 8).collect()}
    assert all(r["shard"] == one[r["doc_id"]]["shard"] for r in two)
    assert all(grown[i] == r["grown_shard"] for i, r in one.items())
    sizes = collections.Counter(r["shard"] for r in one.values())
    assert len(sizes) == 7 and max(sizes.values()) < 2.2 * 300 / 7


def test_small_buckets_split_a_hot_key(spark, documents):
    rows = [(1, f"copy number {i} " * 30) for i in range(200)] + [(i, "x" * 400) for i in range(2, 60)]
    df = sharding.shuffle_into_shards(documents(rows), 3, bucket_bytes=4000)
    found = df.collect()
    assert sorted((r["doc_id"], r["text"]) for r in found) == sorted(rows)
    check(found, 3)
    hot = sorted((r["slot"], r["text"]) for r in found if r["doc_id"] == 1)
    assert [t for _, t in hot] != sorted(t for _, t in hot)


def test_the_order_is_shuffled_and_repeatable(spark, documents):
    rows = [(i, "t") for i in range(400)]
    order = lambda seed: [r["doc_id"] for r in sorted(
        sharding.shuffle_into_shards(documents(rows), 1, seed=seed).collect(), key=lambda r: r["slot"])]
    first = order(3)
    assert sorted(first) == list(range(400)) and first != sorted(first)
    assert first == order(3) != order(4)


def test_files_by_shard(spark, documents, tmp_path):
    path = str(tmp_path / "shards")
    sharding.shuffle_into_shards(documents([(i, str(i)) for i in range(50)]), 4, path=path).count()
    assert sorted(p.name for p in (tmp_path / "shards").iterdir() if p.is_dir()) == [
        f"shard={s}" for s in range(4)]
    assert spark.read.parquet(path).count() == 50


def test_odd_rows(spark, documents, odd_rows):
    df = sharding.shuffle_into_shards(documents(odd_rows), 5)
    assert df.columns == [*documents(odd_rows).columns, *sharding.ADDED]
    rows = df.collect()
    assert sorted(repr((r["doc_id"], r["text"])) for r in rows) == sorted(map(repr, odd_rows))
    check(rows, 5)
    assert {(r["size"], r["text_crc32"]) for r in rows if r["text"] is None} == {(16, 0)}
    assert sharding.shuffle_into_shards(documents([]), 5).count() == 0


def test_no_python_on_the_executors(spark, documents):
    df = sharding.shuffle_into_shards(documents([(1, "a")]), 2)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("shards", [1, 2, 41])
def test_shards_are_even(spark, shards):
    found = spark.range(8000).select(sharding.shard_of("id", shards).alias("s")).groupBy("s").count()
    counts = [r["count"] for r in found.collect()]
    assert len(counts) == shards
    assert max(counts) < 8000 / shards + 6 * (8000 / shards) ** 0.5
