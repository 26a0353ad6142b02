"""Refused rows: both ways of numbering, hot keys, copies and NULL keys; counts of the books."""

from pyspark.sql import functions as F

from studylake.plans import silver
from studylake.quality import audit, refusals
from tests.test_plans import plan

SPEC = silver.STUDENT_ASSESSMENT
COLUMNS = "id_assessment string, id_student string, date_submitted string, is_banked string, score string"


def _bronze(spark):
    rows = [("1", "7", "3", "0", "50")] * 40 + [("1", "7", "3", "0", None)]
    rows += [("2", "7", "3", "0", "50")] * 2 + [("2", None, "3", "0", "50")] * 3
    rows += [("x", "7", "3", "0", "5"), ("3", "7", "9", "0", "101"), ("4", "7", "9", "1", "60")]
    frame = spark.createDataFrame(rows, COLUMNS).withColumn("_i", F.monotonically_increasing_id())
    return frame.withColumn("ingestion_timestamp", F.when(
        F.col("_i") % 2 == 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-08")).cast("timestamp")
    ).drop("_i").withColumn("ingestion_date", F.to_date("ingestion_timestamp"))


def _rows(frame):
    return sorted(map(str, frame.collect()))


def test_both_ways_of_numbering_agree(spark):
    bronze = _bronze(spark)
    clean = SPEC.clean(bronze)
    whole = refusals.refused_rows(bronze, clean, SPEC)
    assert _rows(whole) == _rows(refusals.refused_rows(bronze, clean, SPEC, most=0))
    assert _rows(whole) == _rows(refusals.refused_rows(bronze, clean, SPEC, most=10))
    reasons = {r[0]: r[1] for r in refusals.refusal_summary(whole).collect()}
    assert reasons == {
        "key_conflict": 41, "duplicate_key_dropped": 1, "student_id_missing_or_unparseable": 3,
        "assessment_id_missing_or_unparseable": 1, "score_out_of_range": 1,
    }
    numbers = sorted(r["row_num"] for r in whole.collect() if r["id_assessment"] == "1")
    assert numbers == list(range(1, 42))


def test_rows_move_once_by_key(spark):
    bronze = _bronze(spark)
    clean = SPEC.clean(bronze).localCheckpoint()
    text = plan(refusals.refused_rows(bronze.localCheckpoint(), clean, SPEC))
    assert text.count("Exchange rangepartitioning") == 0
    assert text.count("Exchange hashpartitioning") <= 2  # the rows, and the keys of silver


def test_books_meet_in_one_aggregate(spark):
    bronze = _bronze(spark)
    clean = SPEC.clean(bronze)
    nobody = spark.createDataFrame([(99, 99), (2, None)], "id_assessment bigint, id_student bigint")
    kept = clean.select(*SPEC.keys).unionByName(nobody)
    lost = refusals.refused_count(SPEC.parse(bronze), kept, SPEC.keys)
    assert lost.first()[0] == refusals.refused_rows(bronze, clean, SPEC).count()
    assert "Join" not in plan(lost)


def test_a_relationship_reads_each_side_once(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,), (5,)], "k int")
    check = audit.relationship_check(child, parent, ["k"], "c_p")
    assert tuple(check.first()) == ("c_p", 6, 1, 2, 2, "FAIL")
    assert "Join" not in plan(check)
    assert plan(check).count("ExistingRDD") == 2
    none = audit.relationship_check(child.limit(0), parent.limit(0), ["k"], "n")
    assert tuple(none.first()) == ("n", 0, 0, 0, 0, "PASS")
