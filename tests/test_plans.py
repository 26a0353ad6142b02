"""Physical plans: how often tables are scanned and rows are moved."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from studylake.operators import copies
from studylake.plans import gold
from studylake.quality import structured


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("Initial Plan")[0]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A table in parquet, so that scans can be counted."""

    def write(df):
        path = str(tmp_path_factory.mktemp("table") / "t")
        df.write.parquet(path)
        return spark.read.parquet(path)

    return write


def test_keeping_the_latest_moves_rows_once_and_combines_before(spark, stored):
    table = stored(spark.range(100).select((F.col("id") % 9).alias("k"), "id"))
    text = plan(copies.latest_per_key(table, ["k"], ["id"]))
    assert text.count("Exchange") == 1 and "partial_max" in text and "Window" not in text


def test_pruned_columns_do_not_reach_the_latest_row(spark, stored):
    table = stored(spark.range(9).select("id", F.lit(1).alias("t"), F.lit("x").alias("wide")))
    text = plan(copies.latest_per_key(table, ["id"], ["t"]).select("id"))
    assert "ReadSchema: struct<id:bigint>" in text


def test_rows_of_single_keys_are_not_moved(spark, stored):
    """Rows meet a small written table of repeated keys; only the rows of those are shuffled."""
    wide = spark.range(2000).select("id", (F.col("id") % 9).cast("timestamp").alias("t"), F.lit("x").alias("wide"))
    table = stored(wide.unionByName(wide.filter("id < 5")))
    text = plan(copies.latest_by_key_facts(table, ["id"], ["t"]))
    assert "SortMergeJoin" not in text and text.count("hashpartitioning") == 1
    # the one shuffle stands over the rows of repeated keys
    assert text.index("LeftAnti") < text.index("hashpartitioning") < text.index("LeftSemi")


def test_calendar_needs_no_join(spark, stored):
    courses = stored(spark.createDataFrame(
        [("AAA", "2013J", 1)],
        "code_module string, code_presentation string, module_presentation_length int"))
    assert "Join" not in plan(gold.dim_course_week(courses))


def test_a_structured_report_scans_its_table_twice(spark, stored):
    """Once for all rules, once for the duplicate keys; the check rows add no scan."""
    columns = "code_module string, code_presentation string, id_assessment string, " \
        "assessment_type string, date string, weight string, ingestion_timestamp timestamp, " \
        "ingestion_date date"
    assessments = stored(spark.createDataFrame([], columns))
    courses = stored(spark.createDataFrame([], "code_module string, code_presentation string"))
    text = plan(structured.bronze_assessment_report(assessments, courses))
    own = [line for line in text.splitlines() if "FileScan" in line and "id_assessment" in line]
    assert len(own) == 2


def test_filters_on_the_key_run_before_the_shuffle(spark, stored):
    table = stored(spark.range(100).select((F.col("id") % 9).alias("k"), "id"))
    text = plan(copies.latest_per_key(table, ["k"], ["id"]).filter("k = 3"))
    assert "PushedFilters: [IsNotNull(k), EqualTo(k,3)]" in text


@contextmanager
def small_partitions(spark):
    """Adaptive execution at the scale of a test: only tables of one row are broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "4k",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "4k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


@pytest.fixture(scope="module")
def skewed(spark, stored):
    """Silver frames with a third of the submissions on one assessment or one enrollment."""
    course = "'AAA' code_module, '2013J' code_presentation"
    frames = {
        "courses": spark.sql(f"select {course}, 260 module_presentation_length"),
        "assessments": spark.range(4000).selectExpr(
            "id id_assessment", course.split(", ")[0], course.split(", ")[1], "'TMA' assessment_type",
            "cast(id % 200 as int) date", "10.0D weight"),
        "info": spark.range(4000).selectExpr(
            "id id_student", *course.split(", "), "0 num_of_prev_attempts"),
        "registration": spark.range(4000).selectExpr(
            "id id_student", *course.split(", "), "cast(-9 as int) date_registration"),
    }
    one = "if(id % 3 = 0, 7, id % 4000)"
    facts = "cast(id % 250 as int) date_submitted, 0 is_banked, 50.0D score, 'x' score_source, " \
        "timestamp '2024-01-01' ingestion_timestamp"
    frames["by_assessment"] = spark.range(60_000).selectExpr(
        f"{one} id_assessment", "id id_student", *facts.split(", "))
    frames["by_student"] = spark.range(60_000).selectExpr(
        "id id_assessment", f"{one} id_student", *facts.split(", "))
    return {name: stored(df) for name, df in frames.items()}


def test_a_hot_assessment_is_split(spark, stored, skewed):
    dim = stored(gold.dim_assessment(skewed["assessments"]))
    courses, weeks = (stored(make(skewed["courses"])) for make in (gold.dim_course, gold.dim_course_week))
    enrollment = stored(spark.createDataFrame(
        [("1_AAA_2013J", 1, "AAA_2013J")], "student_enrollment_id string, student_id bigint, course_id string"))
    with small_partitions(spark):
        text = executed(gold.fact_performance(
            skewed["by_assessment"], skewed["assessments"], dim, courses, enrollment, weeks))
    assert "skew=true" in text


def test_a_hot_enrollment_is_split_in_its_one_lookup(spark, skewed):
    with small_partitions(spark):
        text = executed(structured.evaluate_submissions(
            skewed["by_student"], skewed["assessments"], skewed["info"], skewed["registration"]))
    assert text.count("skew=true") >= 2  # by student, then by student and course
