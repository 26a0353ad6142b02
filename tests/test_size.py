"""Work that must not grow faster than the tables: files of bounded rows, inputs read once."""

import os

import pytest
from pyspark.sql import functions as F

from studylake.bindings import storage
from studylake.bindings.learning import Learning
from studylake.operators import copies
from studylake.plans import analytics, gold
from studylake.quality import refusals
from tests.test_plans import plan


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.range(40).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"),
        F.lit("1-URGENT").alias("o_orderpriority"), F.lit("2024-01-02").cast("timestamp").alias("o_orderdate"),
    ).write.parquet(f"{path}/orders.parquet")
    spark.range(100).select(
        (F.col("id") % 40).alias("l_orderkey"), F.col("id").alias("l_partkey"), F.lit(1).alias("l_linenumber"),
        F.lit(5.0).alias("l_quantity"), F.lit(0.05).alias("l_discount"), F.lit(0.02).alias("l_tax"),
        F.when(F.col("id") % 4 == 0, "R").when(F.col("id") % 4 == 1, "A").alias("l_returnflag"),
        F.lit("2024-01-09").cast("timestamp").alias("l_shipdate"),
    ).write.parquet(f"{path}/lineitem.parquet")
    return path


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """What the engagement fact is made of, in parquet."""
    course = "'AAA' code_module, '2013J' code_presentation"
    frames = [
        f"select {course}, 1L id_student, 2L id_site, 3 date, 4L sum_click",
        f"select 'AAA_2013J' course_id, {course}, 260 module_presentation_length",
        "select '1_AAA_2013J' student_enrollment_id, 1L student_id, 'AAA_2013J' course_id",
        "select 2L vle_id, 'page' activity_type",
        "select 'AAA_2013J' course_id, 1 week_id",
    ]
    paths = [str(tmp_path_factory.mktemp("log") / "t") for _ in frames]
    for sql, path in zip(frames, paths):
        spark.sql(sql).write.parquet(path)
    return [spark.read.parquet(path) for path in paths]


def test_csv_files_hold_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "_FILE_ROWS", 10)
    table = spark.range(95).coalesce(1)
    storage._write_csv(table, str(tmp_path / "t"), storage._file_rows(table))
    files = [f for f in os.listdir(tmp_path / "t") if f.endswith(".csv")]
    assert len(files) == 10
    assert spark.read.option("header", True).csv(str(tmp_path / "t")).count() == 95
    assert storage._file_rows(spark.range(9)) == 4


def test_both_loads_of_submissions_come_from_one_join(spark, folder):
    bronze = Learning(spark, folder).bronze["student_assessment"]
    assert plan(bronze).count("Join") == 1
    assert bronze.columns == [
        "id_assessment", "id_student", "date_submitted", "is_banked", "score",
        "ingestion_timestamp", "ingestion_date"]
    loads = {str(r[0]): r[1] for r in bronze.groupBy("ingestion_date").count().collect()}
    assert loads == {"2024-01-01": 100, "2024-01-08": 25}


def test_a_stored_table_is_written_once_and_read(spark, folder):
    t = Learning(spark, folder)
    fresh = t.bronze["student_assessment"]
    kept = t.store("bronze", "student_assessment")
    assert t.store("bronze", "student_assessment") is kept and t.bronze["student_assessment"] is kept
    assert "Join" not in plan(t.silver["student_assessment"])
    assert sorted(map(str, kept.collect())) == sorted(map(str, fresh.collect()))


def exchanges(df) -> list[str]:
    return [line for line in plan(df).splitlines() if "Exchange hashpartitioning" in line]


def test_days_per_enrollment_need_no_shuffle_of_their_own(spark, log):
    """the fact is dealt by enrollment and day; one shuffle by enrollment follows."""
    fact = gold.fact_engagement(*log)
    by_id = [line for line in exchanges(analytics.engagement_per_enrollment(fact))
             if "hashpartitioning(student_enrollment_id" in line]
    assert len(by_id) == 2


def test_weeks_are_looked_up_after_the_shuffles_of_the_log(spark, log):
    """the week follows from the day and is not shuffled for the other lookups."""
    lines = plan(gold.fact_engagement(*log)).splitlines()
    places = [i for i, line in enumerate(lines) if "Join" in line]
    assert "_week" in lines[places[0]] and not any("_week" in lines[i] for i in places[1:])


def test_only_named_columns_are_stored(spark, folder):
    """what a query does not read is neither computed nor written."""
    t = Learning(spark, folder)
    stored = t.store("silver", "courses", "code_module", "code_presentation")
    assert stored.columns == ["code_module", "code_presentation"]
    assert t.silver["courses"] is stored and "FileScan" in plan(stored)


def test_both_loads_of_courses_come_from_one_scan(spark, folder):
    courses = Learning(spark, folder).bronze["courses"]
    assert plan(courses).count("FileScan") == 1
    assert sorted(tuple(map(str, r)) for r in courses.collect()) == [
        (" 1-urgent ", "2024j", "0", "2024-01-08 00:00:00", "2024-01-08"),
        ("1-URGENT", "2024J", "0", "2024-01-01 00:00:00", "2024-01-01")]


def test_lines_are_narrow_before_they_meet_their_order(spark, folder):
    """of a line only what a column needs is shuffled, as text or day."""
    for name in ("student_assessment", "student_vle"):
        below = plan(Learning(spark, folder).bronze[name]).split("Join", 1)[1]
        assert "SortMergeJoin" not in plan(Learning(spark, folder).bronze[name])
        moved = [line for line in below.splitlines() if "Project [l_orderkey" in line]
        assert moved and "cast(l_shipdate" in moved[0] and " l_quantity#" not in moved[0].split("CASE")[0]


def test_rows_of_single_keys_are_not_shuffled_for_their_count(spark, tmp_path):
    """the repeated keys are written first, so their size is known when the rows are planned."""
    path = str(tmp_path / "t")
    spark.range(50).unionByName(spark.range(3)).write.parquet(path)
    table = spark.read.parquet(path)
    counted = copies.with_key_occurrences(table, ["id"], "n")
    assert not exchanges(counted)
    assert counted.filter("n = 2").count() == 6 and counted.count() == 53


def test_reasons_are_put_together_once(spark):
    """the filter asks the rules; a NULL condition is no reason."""
    rows = spark.createDataFrame([(1, 5), (2, None), (3, -5)], "id int, x int").repartition(2)
    rules = {"high": F.col("x") > 4, "odd": F.col("id") % 2 == 1}
    got = refusals.rejected_rows(rows, rules, ["id"])
    assert plan(got).count("array(") == 1
    assert {r["id"]: r["reject_reasons"] for r in got.collect()} == {1: ["high", "odd"], 3: ["odd"]}
