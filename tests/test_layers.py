"""The layers over the small raw files, rule by rule."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

import learning_fixture
from studylake.operators import upsert
from studylake.plans import analytics, gold, pipeline, silver
from studylake.quality import audit, catalog, refusals, structured
from studylake.session import scratch_folder
from studylake.sources.tables import Lake

AS_OF = datetime.datetime(2024, 1, 10)


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    folder = learning_fixture.write(str(tmp_path_factory.mktemp("raw")))
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    bronze = pipeline.load_bronze(lake, folder, AS_OF)
    clean = pipeline.load_silver(lake, bronze)
    star = pipeline.load_gold(lake, clean)
    return bronze, clean, star


def by(df, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]]
            for r in df.collect()}


def test_courses(layers, rows):
    clean = layers[1]["courses"]
    assert rows(clean.select("code_module", "code_presentation", "module_presentation_length")) == [
        ("AAA", "2013J", 268), ("BBB", "2014B", 234)]


def test_assessments(layers):
    got = by(layers[1]["assessments"], "id_assessment", "code_module", "assessment_type", "date",
             "date_source", "weight")
    assert got == {
        1: ("AAA", "TMA", 19, "19", 10.0),
        2: ("AAA", "Exam", None, "?", 100.0),
        3: ("AAA", "CMA", 40, "40", 90.0),
        8: ("BBB", "TMA", 70, "70", 87.0),
        9: ("BBB", "Exam", None, None, 50.0),
        10: ("ZZZ", "TMA", 80, "80", 100.0),
    }


def test_refused_assessments(layers):
    bronze, clean, _ = layers
    refused = refusals.refused_rows(bronze["assessments"], clean["assessments"],
                                    silver.ASSESSMENTS)
    got = sorted((r["id_assessment"], r["refusal_reason"]) for r in refused.collect())
    assert got == [
        ("0", "id_not_positive"), ("3", "duplicate_key_dropped"), ("4", "key_conflict"),
        ("4", "key_conflict"), ("5", "weight_out_of_range"), ("6", "date_out_of_range"),
        ("7", "type_missing_or_invalid"), ("x", "id_missing_or_unparseable"),
    ]
    summary = by(refusals.refusal_summary(refused), "refusal_reason", "rows_refused")
    assert "other_unspecified" not in summary and sum(summary.values()) == 8
    assert refusals.top_refused(refused, ["refusal_reason", "id_assessment"], 2).count() == 2


def test_submissions(layers):
    got = by(layers[1]["student_assessment"].withColumn(
        "key", F.concat_ws("-", "id_assessment", "id_student")), "key", "date_submitted", "score",
        "score_source")
    assert got == {
        "1-11": (18, 80.0, "80"), "1-12": (-5, None, "?"), "2-11": (200, None, None),
        "8-11": (6, None, "abc"), "1-99": (20, 60.0, "60"), "77-11": (20, 60.0, "60"),
    }


def test_refused_submissions(layers):
    bronze, clean, _ = layers
    refused = refusals.refused_rows(
        bronze["student_assessment"], clean["student_assessment"], silver.STUDENT_ASSESSMENT)
    got = {(r["id_assessment"], r["id_student"]): r["refusal_reason"] for r in refused.collect()}
    assert got == {
        ("3", "11"): "date_submitted_out_of_range", ("3", "12"): "date_submitted_out_of_range",
        ("8", "12"): "score_out_of_range", ("9", "11"): "score_out_of_range",
        ("9", "12"): "is_banked_missing_or_invalid",
        ("10", "11"): "is_banked_missing_or_invalid",
    }


@pytest.mark.parametrize("spec", [silver.ASSESSMENTS, silver.STUDENT_ASSESSMENT])
def test_books_balance(layers, spec):
    bronze, clean = layers[0][spec.table], layers[1][spec.table]
    lost = refusals.refused_count(spec.parse(bronze), clean, spec.keys)
    row = refusals.row_accounting(bronze, clean, lost).first()
    assert row["imbalance"] == 0 and row["status"] == "PASS"
    assert row["refused_records"] == refusals.refused_rows(bronze, clean, spec).count()


def test_a_row_refused_later_stays_and_unbalances_the_books(layers, spark):
    bronze, clean = layers[0]["assessments"], layers[1]["assessments"]
    worse = bronze.withColumn("weight", F.when(F.col("id_assessment") == "1", "500").otherwise(
        F.col("weight")))
    merged = upsert.merge_upsert(clean, silver.clean_assessments(worse), ["id_assessment"])
    assert merged.filter("id_assessment = 1").count() == 1
    spec = silver.ASSESSMENTS
    row = refusals.row_accounting(
        worse, silver.clean_assessments(worse),
        refusals.refused_count(spec.parse(worse), merged, spec.keys)).first()
    assert row["status"] == "FAIL"


def test_people(layers):
    got = by(layers[1]["student_info"].withColumn(
        "key", F.concat_ws("-", "code_module", "id_student")), "key", "gender", "region",
        "imd_band", "disability")
    assert got == {
        "AAA-11": ("M", "Wales", "0-10%", False), "AAA-12": ("F", "Ireland", "?", None),
        "BBB-11": ("M", "Wales", "0-10%", False),
    }


def test_registration(layers):
    got = by(layers[1]["student_registration"].withColumn(
        "key", F.concat_ws("-", "code_module", "id_student")), "key", "date_registration",
        "date_unregistration")
    assert got == {"AAA-11": (-30, None), "AAA-12": (None, 12), "BBB-11": (10, 5)}


def test_resources_and_clicks(layers):
    assert by(layers[1]["vle"], "id_site", "activity_type", "week_from", "week_to") == {
        100: ("resource", None, None), 101: ("quiz", 1, 2)}
    clicks = layers[1]["student_vle"]
    assert clicks.filter("date = 0").first()["sum_click"] == 7
    assert clicks.filter("date = 9").count() == 0


def test_conflicting_courses_fail_the_merge(layers, spark):
    bronze = layers[0]["courses"]
    longer = bronze.withColumn("module_presentation_length", F.lit("300")).unionByName(bronze)
    with pytest.raises(Exception, match="several source rows"):
        upsert.merge_upsert(
            None, silver.clean_courses(longer), ["code_module", "code_presentation"]).collect()


# --- gold ------------------------------------------------------------------------

def test_dimensions(layers, rows):
    star = layers[2]
    assert rows(star["dim_course"].select("course_id")) == [("AAA_2013J",), ("BBB_2014B",)]
    assert star["dim_course_week"].count() == 202
    assert star["dim_course_phase"].count() == 3
    people = by(star["dim_student"], "student_id", "gender", "disability")
    assert people == {11: ("M", "false"), 12: ("F", None)}
    enrolled = by(star["dim_student_enrollment"], "student_enrollment_id", "final_result",
                  "date_registration", "date_unregistration")
    assert enrolled == {
        "11_AAA_2013J": ("Pass", -30, None), "12_AAA_2013J": ("Withdrawn", None, 12),
        "11_BBB_2014B": ("Fail", 10, 5),
    }
    wide = by(star["dim_student_info"], "student_course_key", "is_unregistered")
    assert wide == {"11_AAA_2013J": False, "12_AAA_2013J": True, "11_BBB_2014B": True}


def test_engagement(layers):
    fact, clicks = layers[2]["fact_student_engagement"], layers[1]["student_vle"]
    assert fact.agg(F.sum("sum_click")).first() == clicks.agg(F.sum("sum_click")).first()
    mine = fact.filter("student_enrollment_id = '11_AAA_2013J'")
    assert by(mine, "interaction_date", "week_id") == {
        -8: -2, -7: -1, -1: -1, 0: 0, 1: 1, 7: 1, 8: 2, 600: None}
    strangers = fact.filter("student_enrollment_id IS NULL").collect()
    assert [r["sum_click"] for r in strangers] == [11]  # two unknown students merge


def test_unmatched_clicks_can_be_dropped(layers):
    _, clean, star = layers
    kept = gold.fact_engagement(
        clean["student_vle"], star["dim_course"], star["dim_student_enrollment"],
        star["dim_vle"], star["dim_course_week"], unmatched="drop")
    assert kept.filter("student_enrollment_id IS NULL").count() == 0
    with pytest.raises(ValueError):
        gold.fact_engagement(*[None] * 5, unmatched="other")


def test_performance(layers):
    fact = layers[2]["fact_student_performance"].withColumn(
        "key", F.concat_ws("-", "assessment_key", F.coalesce("student_enrollment_id", F.lit("?"))))
    got = by(fact, "key", "days_late", "is_non_submission", "weighted_score", "week_id")
    assert got == {
        "1-11_AAA_2013J": (-1, False, 8.0, 3), "1-12_AAA_2013J": (-24, True, None, -1),
        "2-11_AAA_2013J": (None, True, None, 29), "8-11_BBB_2014B": (-64, True, None, 1),
        "1-?": (1, False, 6.0, 3),
    }


def test_relationships(layers):
    star = layers[2]
    for child, parent, on in gold.RELATIONSHIPS:
        row = audit.relationship_check(star[child], star[parent], [on], child).first()
        assert row["status"] == "PASS"
        assert row["null_keys"] == (1 if child == "fact_student_engagement" else 0)


# --- analytics ----------------------------------------------------------------------

def test_engagement_performance(layers):
    star = layers[2]
    got = analytics.engagement_performance(
        star["fact_student_engagement"], star["fact_student_performance"])
    table = {(r["student_enrollment_id"], r["total_clicks"]): r for r in got.collect()}
    first = table[("11_AAA_2013J", 15)]
    assert (first["active_days"], first["avg_score"], first["assessment_count"]) == (8, 80.0, 2)
    assert table[("12_AAA_2013J", 0)]["active_days"] == 0
    assert (None, 11) in table and (None, 0) in table  # NULL ids stay apart
    assert {r["engagement_quartile"] for r in table.values()} <= {1, 2, 3, 4}


def test_withdrawal(layers, rows):
    star = layers[2]
    enrollment, student = star["dim_student_enrollment"], star["dim_student"]
    assert analytics.withdrawal_by_demographics(enrollment, student).count() == 0
    small = analytics.withdrawal_by_demographics(enrollment, student, min_n=1)
    assert [tuple(r)[4:] for r in small.collect()] == [(1, 1, 100.0), (2, 0, 0.0)]
    assert rows(analytics.withdrawal_by_history(enrollment, student)) == [
        (0, "60-120 Credits", 1, 0, 0.0), (1, "< 60 Credits", 1, 0, 0.0),
        (1, "> 120 Credits", 1, 1, 100.0)]


# --- reports --------------------------------------------------------------------------

def statuses(report):
    return by(report, "check_name", "status", "violation_count")


def test_bronze_assessment_report(layers):
    bronze = layers[0]
    got = statuses(structured.bronze_assessment_report(bronze["assessments"], bronze["courses"]))
    assert len(got) == 17
    assert got["Record Count"] == ("PASS", 0)
    assert got["Invalid id_assessment Format"] == ("FAIL", 1)
    assert got["Duplicate Assessment IDs"] == ("WARNING", 2)
    assert got["Assessment Type Domain"] == ("WARNING", 1)
    assert got["Missing Assessment Date"] == ("WARNING", 2)
    assert got["Assessment Weight Range"] == ("FAIL", 1)
    assert got["Unknown Module Presentation"] == ("WARNING", 1)
    assert got["Missing Assessment Weight"] == ("PASS", 0)


def test_bronze_submission_report(layers):
    bronze = layers[0]
    got = statuses(structured.bronze_submission_report(
        bronze["student_assessment"], bronze["assessments"], bronze["student_info"]))
    assert len(got) == 20
    assert got["Missing is_banked"] == ("FAIL", 1)
    assert got["Invalid is_banked Value"] == ("FAIL", 1)
    assert got["Missing Score"] == ("WARNING", 1)
    assert got["Invalid Score Format"] == ("FAIL", 2)
    assert got["Score Out of Range"] == ("FAIL", 2)
    assert got["Orphan Assessment Reference"] == ("FAIL", 1)
    assert got["Student Not In Any Enrollment"] == ("FAIL", 1)
    assert got["Unusable Assessment Module Mapping"] == ("PASS", 0)
    # 8-12, 9-12: known student, not on that presentation; 10-11: not enrolled on ZZZ; 1-99
    assert got["Orphan Student Enrollment Reference"] == ("FAIL", 4)


def test_an_assessment_of_two_modules_is_unusable(layers):
    bronze = layers[0]
    twice = bronze["assessments"].unionByName(
        bronze["assessments"].filter("id_assessment = '1'").withColumn("code_module", F.lit("BBB")))
    got = statuses(structured.bronze_submission_report(
        bronze["student_assessment"], twice, bronze["student_info"]))
    assert got["Unusable Assessment Module Mapping"] == ("FAIL", 3)


def test_silver_reports(layers):
    bronze, clean, _ = layers
    got = statuses(structured.silver_assessment_report(
        clean["assessments"], clean["courses"], bronze["assessments"]))
    assert len(got) == 13
    assert got["Row Accounting Balances"] == ("PASS", 0)
    assert got["Orphan Module Presentation"] == ("FAIL", 1)
    assert got["Coursework Weight Total"] == ("WARNING", 1)
    assert got["Exam Weight Not 100"] == ("WARNING", 1)
    assert got["Missing Assessment Date"] == ("WARNING", 2)
    assert got["Date Source Not Captured"] == ("FAIL", 1)
    got = statuses(structured.silver_submission_report(
        clean["student_assessment"], clean["assessments"], clean["student_info"],
        clean["student_registration"], bronze["student_assessment"]))
    assert len(got) == 15
    assert got["Row Accounting Balances"] == ("PASS", 0)
    assert got["Banked Without Prior Attempt"] == ("WARNING", 1)
    assert got["Submitted Before Registration"] == ("WARNING", 1)
    assert got["Score Source Not Captured"] == ("FAIL", 1)
    assert got["Missing Score"] == ("WARNING", 3)
    assert got["Orphan Assessment Reference"] == ("FAIL", 1)
    assert got["Student Not In Any Enrollment"] == ("FAIL", 1)


def test_rejected_rows_carry_every_reason(layers):
    clean = layers[1]
    got = by(structured.rejected_assessments(clean["assessments"], clean["courses"]),
             "id_assessment", "reject_reasons")
    assert got == {
        8: ["coursework_weight_total"],
        9: ["exam_weight_not_100", "date_source_not_captured"],
        10: ["orphan_course"],
    }


def test_empty_tables_are_not_evaluated(layers):
    bronze, clean, _ = layers
    nothing = {k: v.limit(0) for k, v in bronze.items()}
    reports = [
        structured.bronze_assessment_report(nothing["assessments"], nothing["courses"]),
        structured.bronze_submission_report(
            nothing["student_assessment"], nothing["assessments"], nothing["student_info"]),
    ]
    for report in reports:
        for row in report.collect():
            if row["check_level"] == "ROW":
                assert row["status"] == "NOT_EVALUATED" and row["violation_rate"] is None
            else:
                assert row["status"] == "FAIL"


def test_the_catalog_has_every_check(layers, spark):
    bronze, clean, star = layers
    sizes = {name: len(make(bronze, clean, star, None)) for name, make in catalog.REPORTS.items()}
    assert sum(sizes.values()) == 117
    assert sizes["gold_dim_student_enrollment"] == 13 and sizes["bronze_vle"] == 11
    specs = (structured.BRONZE_ASSESSMENTS, structured.BRONZE_SUBMISSIONS,
             structured.SILVER_ASSESSMENTS, structured.SILVER_SUBMISSIONS)
    assert [len(s) for s in specs] == [17, 20, 13, 15]


def test_single_statement_reports(layers):
    bronze, clean, star = layers
    day = F.lit("2024-01-25").cast("date")

    def report(name):
        return by(catalog.report(name, bronze, clean, star, day), "check_code", "status")

    assert report("bronze_courses") == {
        "1.1": "PASS", "1.2": "PASS", "1.3": "PASS", "1.4": "FAIL", "2.1": "INFO", "2.2": "INFO",
        "3.1": "INFO"}
    people = report("bronze_student_info")
    assert people["1.4"] == "FAIL" and people["1.5"] == "WARNING" and people["2.3"] == "FAIL"
    assert people["2.1"] == "PASS" and people["2.2"] == "PASS"
    registration = report("silver_student_registration")
    assert registration["1.3"] == "FAIL" and registration["2.2"] == "FAIL"
    assert registration["3.1"] == "PASS" and registration["3.2"] == "PASS"
    assert report("silver_student_info")["2.1"] == "FAIL"  # '?' is kept, and reported
    assert report("silver_vle")["1.2"] == "FAIL"  # NULL weeks are kept, and reported
    weeks = report("gold_dim_course_week")
    assert weeks["1.4"] == "FAIL"  # the calendar starts before week 1
    assert weeks["2.1"] == weeks["2.2"] == "PASS"
    assert set(report("gold_dim_course_phase").values()) == {"PASS", "INFO"}
    assert report("gold_dim_student")["3.1"] == "PASS"


def test_empty_table_fails_row_checks(layers):
    bronze = {k: v.limit(0) for k, v in layers[0].items()}
    got = by(catalog.report("bronze_courses", bronze, {}, {}), "check_code", "status")
    assert got["1.1"] == "FAIL" and got["1.2"] == "WARNING" and got["1.4"] == "FAIL"


def test_gate_and_health(layers, spark):
    def gate(lost):
        return audit.drop_rate_gate(spark.range(1000), spark.range(1000 - lost), "t").first()

    assert [gate(n)["severity"] for n in (0, 49, 50, 100, 101)] == [
        "Acceptable", "Acceptable", "Warning", "Warning", "Unusable"]
    assert gate(101)["halt"] and not gate(100)["halt"]
    flags = spark.createDataFrame([(3,)], "n bigint")
    log = audit.audit_log(audit.drop_rate_gate(spark.range(9), spark.range(9), "t"), flags)
    assert log.first()["health"] == "WARN"
    assert audit.overall_health(log).first()["health"] == "WARN"


# --- the whole run --------------------------------------------------------------------------

def test_pipeline_twice(spark, tmp_path, rows):
    folder = learning_fixture.write(str(tmp_path / "raw"))
    root = str(tmp_path / "lake")
    first = pipeline.run(spark, folder, root, AS_OF)
    stored = {n: rows(first[n].drop("dimension_created_at"))
              for n in ("dim_student", "dim_student_info", "fact_student_engagement",
                        "fact_student_performance", "dim_course_week")}
    assert first["dq_check_results"].count() == 65
    again = pipeline.run(spark, folder, root, AS_OF)
    for name, expected in stored.items():
        assert rows(again[name].drop("dimension_created_at")) == expected
    assert again["dq_check_results"].count() == 65  # the same moment: replaced, not added
    later = pipeline.run(spark, folder, root, AS_OF + datetime.timedelta(days=1))
    assert later["dq_check_results"].count() == 130
    listed = {(r["layer_name"], r["check_code"], r["column_name"])
              for r in later["dq_listed_values"].collect()}
    assert ("BRONZE", "2.4", "ingestion_date") in listed and ("GOLD", "2.1", "final_result") in listed
    assert not [f for f in os.listdir(scratch_folder(spark)) if f.startswith("run-")]
    trail = Lake(spark, root).read("quality", "source_row_count_audit")
    assert trail.count() == 14
