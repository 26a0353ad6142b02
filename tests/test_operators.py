import re
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from studylake.operators import aggregates, copies, joins, ranking, upsert
from studylake.quality import builders

SCHEMA = "k int, t int, v string"


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, some on NULL, ties and exact copies included."""
    pick = random.Random(7)
    data = []
    for i in range(3000):
        key = 1 if i % 3 == 0 else (None if i % 10 == 0 else pick.randint(2, 800))
        data.append((key, pick.randint(0, 50), pick.choice("abc")))
    return spark.createDataFrame(data, SCHEMA).repartition(7)


def numbered(df):
    window = Window.partitionBy("k").orderBy(F.desc("t"), F.desc("v"))
    return df.withColumn("row_num", F.row_number().over(window))


def test_latest_per_key_equals_a_window(skewed, rows):
    expected = numbered(skewed).filter("row_num = 1").drop("row_num")
    assert rows(copies.latest_per_key(skewed, ["k"], ["t"])) == rows(expected)


def test_latest_puts_nulls_last(spark, rows):
    frame = spark.createDataFrame([(1, None, "x"), (1, 3, "y")], SCHEMA)
    assert rows(copies.latest_per_key(frame, ["k"], ["t"])) == [(1, 3, "y")]


def test_survivor_does_not_depend_on_order_or_partitions(skewed, rows):
    shuffled = skewed.orderBy(F.rand(3)).repartition(3)
    assert rows(copies.latest_per_key(skewed, ["k"], ["t"])) == rows(
        copies.latest_per_key(shuffled, ["k"], ["t"]))


def test_agreeing_copies_survive_and_others_are_refused(spark, rows):
    frame = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "a"), (2, 1, "a"), (2, 2, "b"), (3, 1, None), (3, 2, None)], SCHEMA)
    kept = copies.keep_agreeing_latest(
        frame, ["k"], ["t"], F.concat_ws("|", F.coalesce("v", F.lit("~"))))
    assert rows(kept) == [(1, 2, "a"), (3, 2, None)]


def few_copies(spark, resent=7):
    """Unique keys, some of them sent again; a NULL key twice, ties, one row repeated whole."""
    data = [(i, i % 13, "x") for i in range(400)]
    data += [(i, 20 if i % 2 else i % 13, "x" if i % 3 else "y") for i in range(0, 400, resent)]
    return spark.createDataFrame(
        [*data, (None, 1, "x"), (None, 2, "x"), (500, None, "x"), (500, None, "x"), (501, None, None)],
        SCHEMA).repartition(5)


@pytest.mark.parametrize("resent", [1, 7])  # every key, and few of them
@pytest.mark.parametrize("order", ["t", "v"])  # of a fixed width, and not
def test_latest_by_key_facts_equals_one_aggregate(spark, rows, resent, order):
    table = few_copies(spark, resent)
    assert rows(copies.latest_by_key_facts(table, ["k"], [order])) == rows(
        copies.latest_per_key(table, ["k"], [order]))


@pytest.mark.parametrize("content", [F.col, lambda c: F.coalesce(F.col(c), F.lit("~"))])
@pytest.mark.parametrize("resent", [1, 7])
def test_agreeing_by_key_facts_equals_one_aggregate(spark, rows, resent, content):
    table = few_copies(spark, resent)
    assert rows(copies.agreeing_by_key_facts(table, ["k"], ["t"], content("v"))) == rows(
        copies.keep_agreeing_latest(table, ["k"], ["t"], content("v")))


def test_texts_decide_where_content_hashes_collide(spark, rows, monkeypatch):
    table = few_copies(spark)
    expected = rows(copies.keep_agreeing_latest(table, ["k"], ["t"], F.col("v")))
    monkeypatch.setattr(copies.F, "xxhash64", lambda c: F.lit(1).cast("bigint"))
    assert rows(copies.agreeing_by_key_facts(table, ["k"], ["t"], F.col("v"))) == expected


@pytest.mark.parametrize("find", [
    lambda df: copies.latest_by_key_facts(df, ["k"], ["t"]),
    lambda df: copies.agreeing_by_key_facts(df, ["k"], ["t"], F.col("v"))])
def test_key_facts_of_an_empty_table_and_one_key(spark, rows, find):
    assert rows(find(spark.createDataFrame([], SCHEMA))) == []
    assert rows(find(spark.createDataFrame([(1, 2, "a")] * 9, SCHEMA))) == [(1, 2, "a")]


def test_numbers_equal_a_window(skewed, rows):
    got = copies.number_copies(skewed, ["k"], ["t"])
    assert rows(got.select("k", "t", "v", "row_num")) == rows(numbered(skewed))


def test_conflict_flag_covers_every_copy(skewed, rows):
    got = copies.number_copies(skewed, ["k"], ["t"], F.col("v"))
    w = Window.partitionBy("k")
    expected = skewed.withColumn("c", F.min("v").over(w) != F.max("v").over(w))
    assert rows(got.select("k", "t", "v", "key_conflict")) == rows(expected)


def test_occurrences_count_null_keys_together(skewed, rows):
    got = copies.with_key_occurrences(skewed, ["k"], "n")
    expected = skewed.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("k")))
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("size", [0, 1, 3, 4, 23, 101])
@pytest.mark.parametrize("buckets", [1, 4, 7])
def test_ntile(spark, rows, size, buckets):
    frame = spark.range(size, numPartitions=3).select(
        (F.col("id") % 5).alias("v"), F.col("id").alias("i"))
    order = [F.col("v").asc(), F.col("i").asc()]
    expected = frame.withColumn("ntile", F.ntile(buckets).over(Window.orderBy("v", "i")))
    assert rows(ranking.with_ntile(frame, buckets, order)) == rows(expected)


@pytest.mark.parametrize("size", [0, 1, 3, 6, 101])
@pytest.mark.parametrize("few", [1, 20])
def test_ntile_by_selection(spark, rows, size, few):
    frame = spark.range(size, numPartitions=3).select(
        F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("v"), F.col("id").alias("i"))
    expected = frame.withColumn("ntile", F.ntile(4).over(Window.orderBy("v", "i")))
    assert rows(ranking.with_ntile_by_selection(frame, 4, ["v", "i"], few=few)) == rows(expected)


def test_selection_splits_a_dominant_value_by_the_next_columns(spark, rows):
    """A third of the rows share their first column, another third NULL; texts, doubles and days as order."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 11).cast("int"))
    frame = spark.range(3000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7.5).when(F.col("id") % 3 == 1, F.col("id") / 8).alias("v"),
        F.when(F.col("id") % 7 > 0, F.md5(F.col("id").cast("string"))).alias("s"), day.alias("d"), "id")
    order = ["v", "d", "s", "id"]
    expected = frame.withColumn("part", F.ntile(9).over(Window.orderBy(*order)))
    found = ranking.with_ntile_by_selection(frame, 9, order, "part", few=40)
    assert rows(found) == rows(expected)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Sort" not in text


@pytest.mark.parametrize("few", [2, 1000])
def test_selection_among_equal_rows(spark, few):
    frame = spark.range(100, numPartitions=4).select((F.col("id") >= 90).alias("v"))
    found = ranking.with_ntile_by_selection(frame, 4, ["v"], few=few).groupBy("ntile").count().collect()
    assert {r["ntile"]: r["count"] for r in found} == {1: 25, 2: 25, 3: 25, 4: 25}


def test_position_under_one_dominant_value(spark, rows):
    frame = spark.range(5000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"), "id")
    order = [F.col("v").asc(), F.col("id").asc()]
    placed = ranking.with_position(frame, order, "p", total="n")
    expected = frame.select(
        "*", (F.row_number().over(Window.orderBy("v", "id")) - 1).alias("p"), F.lit(5000))
    assert rows(placed) == rows(expected)


def pairs(spark, *data):
    return spark.createDataFrame(list(data), "k int, a string, b string")


def test_upsert_updates_inserts_and_keeps(spark, rows):
    target = pairs(spark, (1, "a", "x"), (2, "a", "x"))
    batch = pairs(spark, (2, "n", "y"), (3, "n", "y"))
    once = upsert.merge_upsert(target, batch, ["k"])
    assert rows(once) == [(1, "a", "x"), (2, "n", "y"), (3, "n", "y")]
    assert rows(upsert.merge_upsert(once, batch, ["k"])) == rows(once)
    partly = upsert.merge_upsert(target, batch, ["k"], ["a"])
    assert rows(partly) == [(1, "a", "x"), (2, "n", "x"), (3, "n", "y")]


def test_first_load_takes_the_batch(spark, rows):
    batch = pairs(spark, (2, "n", "y"))
    assert rows(upsert.merge_upsert(None, batch, ["k"])) == [(2, "n", "y")]


@pytest.mark.parametrize("first_load", [True, False])
def test_two_source_rows_for_a_key_fail(spark, first_load):
    batch = pairs(spark, (2, "n", "y"), (2, "m", "y"))
    target = None if first_load else pairs(spark, (1, "a", "x"))
    with pytest.raises(Exception, match="several source rows"):
        upsert.merge_upsert(target, batch, ["k"]).collect()


def test_null_keys_never_match(spark, rows):
    target, batch = pairs(spark, (None, "a", "x")), pairs(spark, (None, "n", "y"))
    assert rows(upsert.merge_upsert(target, batch, ["k"])) == [
        (None, "a", "x"), (None, "n", "y")]


def test_orphans_and_parents(spark, rows):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, v string")
    parent = spark.createDataFrame([(1,), (1,)], "k int")
    assert rows(joins.orphans(child, parent, ["k"])) == [(2, "b"), (2, "c"), (None, "d")]
    assert rows(joins.with_parent(child, parent, ["k"])) == [(1, "a")]
    assert joins.orphan_count(child, parent, ["k"]).first()["orphans"] == 3


def test_gate_blocks_a_match(spark, rows):
    left = spark.createDataFrame([(1, 1), (2, 2), (None, 1)], "k int, n int")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "r int, v string")
    got = joins.lookup(left, right, {"k": "r"}, gate=left["n"] == 1)
    assert rows(got) == [(1, 1, "a"), (2, 2, None), (None, 1, None)]
    flagged = joins.flag_matches(left, right.toDF("k", "v"), ["k"], "f")
    assert rows(flagged) == [(1, 1, True), (2, 2, True), (None, 1, None)]


def test_a_hot_key_is_split_in_a_lookup(spark):
    """Adaptive execution reports a skewed join although the other side is grouped."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        left = spark.range(90000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"),
            F.xxhash64("id").alias("v"))
        right = spark.range(20000).select((F.col("id") % 5000).alias("k"))
        joined = joins.flag_matches(left, right, ["k"], "f")
        assert len(joined.collect()) == 90000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_duplicate_stats(spark):
    frame = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,), (3,)], "k int")
    assert tuple(aggregates.duplicate_stats(frame, ["k"]).first()) == (2, 5, 3)
    assert tuple(aggregates.duplicate_stats(frame.limit(0), ["k"]).first()) == (0, 0, 0)


def test_parent_mapping(spark, rows):
    frame = spark.createDataFrame(
        [(1, "a"), (1, "a"), (2, "a"), (2, "b"), (None, "a")], "k int, m string")
    assert rows(aggregates.parent_mapping(frame, "k", ["m"])) == [(1, 1, "a"), (2, 2, "a")]


def test_listed_values_are_rows_without_a_bound(spark):
    frame = spark.range(5000).selectExpr("cast(id as string) v", "if(id = 7, null, 'x') w")
    checks = [builders.distinct_list("1", "Vs", "v"), builders.profile("2", {"n": builders.rows()}, listed=["w"])]
    found = builders.check_values(frame, checks, "BRONZE", "t").collect()
    assert {r["value"] for r in found if r["check_code"] == "1"} == {str(i) for i in range(5000)}
    assert {(r["column_name"], r["value"]) for r in found if r["check_code"] == "2"} == {
        ("w", "x"), ("w", None)}
    counts = {r["check_code"]: r["metrics"] for r in builders.run_checks(
        frame, [builders.distinct_list("1", "Vs", "v"), builders.distinct_list("2", "Ws", "w")],
        "BRONZE", "t").collect()}
    assert counts["1"]["distinct_values"] == "5000" and counts["2"]["distinct_values"] == "2"
    nothing = builders.run_checks(frame.limit(0), [builders.distinct_list("1", "Vs", "v")], "BRONZE", "t")
    assert nothing.first()["metrics"]["distinct_values"] == "0"


def test_copies_of_one_row_are_split(spark):
    """A third of all rows are one row repeated: its numbers come from several tasks."""
    frame = spark.range(60000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 9001).cast("int").alias("k"),
        F.lit(1).alias("t"), F.lit("x").alias("v"))
    order = [F.col("k").asc(), F.col("t").desc(), F.col("v").desc()]
    settings = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",  # keep the ranges apart
        "spark.sql.files.maxPartitionBytes": "1k",  # and read each in its own task
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = ranking.with_position(frame, order, "p", ties=True).filter("k = 0")
        n = hot.count()
        parts = hot.select(F.spark_partition_id().alias("i")).groupBy("i").count()
        assert parts.agg(F.max("count")).first()[0] < n / 2
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert n > 20000
    assert hot.agg(F.countDistinct("p"), F.max("p") - F.min("p") + 1).first()[0:2] == (n, n)
    got = copies.number_copies(frame, ["k"], ["t"]).filter("k = 0")
    assert got.agg(F.max("row_num"), F.countDistinct("row_num")).first()[0:2] == (n, n)


def files(path):
    return {str(f.relative_to(path)): f.read_bytes() for f in path.rglob("*.parquet")}


def test_upsert_partitions_leaves_other_files_alone(spark, rows, tmp_path):
    path, by = tmp_path / "table", upsert.key_range(F.col("k"), 10)
    first = spark.range(100).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("a"), F.lit("b").alias("b"))
    assert len(upsert.upsert_partitions(first, str(path), ["k"], by)) == 10
    before = files(path)
    batch = pairs(spark, (12, "n", "y"), (17, "n", "y"), (45, "n", "y"), (230, "n", "y"))
    assert upsert.upsert_partitions(batch, str(path), ["k"], by) == ["1", "23", "4"]
    after = files(path)
    kept = {f for f in before if f.split("/")[0] not in ("_part=1", "_part=4")}
    assert kept and all(after[f] == before[f] for f in kept)
    assert {f.split("/")[0] for f in after if f not in kept} == {"_part=1", "_part=4", "_part=23"}
    wanted = rows(upsert.merge_upsert(first, batch, ["k"]))
    found = lambda: rows(upsert.read_partitions(spark, str(path), first.schema))
    assert found() == wanted
    upsert.upsert_partitions(batch, str(path), ["k"], by)
    assert found() == wanted
    upsert.upsert_partitions(batch.limit(0), str(path), ["k"], by)
    assert found() == wanted


def test_upsert_partitions_columns_nulls_and_repeats(spark, rows, tmp_path):
    path, by = str(tmp_path / "table"), upsert.key_bucket(["k"], 4)
    target = pairs(spark, (1, "a", "x"), (None, "a", "x"))
    batch = pairs(spark, (1, "n", "y"), (None, "n", "y"), (3, "n", "y"))
    upsert.upsert_partitions(target, path, ["k"], by)
    upsert.upsert_partitions(batch, path, ["k"], by, ["a"])
    found = rows(upsert.read_partitions(spark, path, target.schema))
    assert found == rows(upsert.merge_upsert(target, batch, ["k"], ["a"]))
    with pytest.raises(Exception, match="several source rows"):
        upsert.upsert_partitions(pairs(spark, (1, "a", "x"), (1, "b", "x")), path, ["k"], by)
    ranged = str(tmp_path / "ranged")
    for batch in (target, target):  # NULL keys lie in a part of their own and never match
        upsert.upsert_partitions(batch, ranged, ["k"], upsert.key_range(F.col("k"), 10))
    assert rows(upsert.read_partitions(spark, ranged, target.schema)) == sorted(
        [(1, "a", "x"), (None, "a", "x"), (None, "a", "x")], key=repr)


def test_upsert_partitions_reads_the_touched_parts_only(spark, tmp_path):
    path, by = str(tmp_path / "table"), upsert.key_range(F.col("k"), 10)
    upsert.upsert_partitions(pairs(spark, *[(k, "a", "x") for k in range(40)]), path, ["k"], by)
    old = upsert._stored(spark, path, pairs(spark, (1, "a", "x")).schema)
    text = old.filter(F.col(upsert.PART).isin(["2"]))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*_part#\d+ = 2", text)
