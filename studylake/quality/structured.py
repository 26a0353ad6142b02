"""The four structured reports: counts first, one status row per check after."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studylake import schemas
from studylake.functions import columns as fx
from studylake.operators import aggregates, copies, joins
from studylake.plans import silver as cleaning
from studylake.quality import refusals
from studylake.quality.report import Spec, one_row, severity_report, threshold_report

TYPES_RAW = list(schemas.ASSESSMENT_TYPES)
TYPES_CLEAN = list(schemas.ASSESSMENT_TYPES.values())
EXPECTED_TOTAL = 100


def parse_bronze(
    df: DataFrame,
    texts: Mapping[str, str],
    values: Mapping[str, tuple[str, str]],
    upper: Sequence[str] = (),
) -> DataFrame:
    """Normalised text and safely parsed value side by side.

    ``texts`` maps a text column to its source, ``values`` maps a value column to
    (text column, type). Keeping both lets *missing* and *malformed* be counted apart.
    """
    normal = df.select(
        *[
            (F.upper(fx.clean_text(F.col(source))) if name in upper
             else fx.clean_text(F.col(source))).alias(name)
            for name, source in texts.items()
        ],
        *[c for c in ("ingestion_timestamp", "ingestion_date") if c in df.columns],
    )
    return normal.withColumns({
        name: F.col(text).try_cast(kind) for name, (text, kind) in values.items()
    })


def _count_ifs(rules: Mapping[str, Column]) -> list[Column]:
    return [F.count_if(fx.present(rule)).alias(name) for name, rule in rules.items()]


def _add_up(names: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]


def _sum_where(condition: Column, amount: str) -> Column:
    return F.coalesce(F.sum(F.when(fx.present(condition), F.col(amount))), F.lit(0))


def outside(value: Column, low: float, high: float) -> Column:
    return F.isnan(value) | (value < low) | (value > high)


def _off_total(total: Column) -> Column:
    return total.isNotNull() & (F.round(total, 6) != EXPECTED_TOTAL)


# --- bronze assessments ------------------------------------------------------

def bronze_assessment_stats(assessments: DataFrame, courses: DataFrame) -> DataFrame:
    """One row of counts from one pass over the assessments.

    Every row-level rule is counted per module presentation, which is also the
    grain of the coursework total and of the course reference; both are then
    resolved on the few presentation rows instead of on every assessment.
    """
    parsed = parse_bronze(
        assessments,
        {
            "id_text": "id_assessment", "module_text": "code_module",
            "presentation_text": "code_presentation", "type_text": "assessment_type",
            "date_text": "date", "weight_text": "weight",
        },
        {
            "assessment_id": ("id_text", "bigint"),
            "assessment_day": ("date_text", "int"),
            "weight_num": ("weight_text", "double"),
        },
        upper=("module_text", "presentation_text", "type_text"),
    )
    parents = parse_bronze(
        courses,
        {"module_text": "code_module", "presentation_text": "code_presentation"},
        {},
        upper=("module_text", "presentation_text"),
    ).select("module_text", "presentation_text").distinct().dropna()

    c = F.col
    unknown = schemas.PLACEHOLDER
    rules = {
        "missing_ids": c("id_text").isNull(),
        "invalid_ids": c("id_text").isNotNull() & c("assessment_id").isNull(),
        "missing_modules": c("module_text").isNull(),
        "missing_presentations": c("presentation_text").isNull(),
        "missing_metadata": c("ingestion_timestamp").isNull() | c("ingestion_date").isNull(),
        "missing_types": c("type_text").isNull(),
        "invalid_types": ~c("type_text").isin(TYPES_RAW),
        "missing_dates": c("date_text").isNull() | (c("date_text") == unknown),
        "invalid_dates": (c("date_text") != unknown) & c("assessment_day").isNull(),
        "missing_weights": c("weight_text").isNull(),
        "invalid_weights": c("weight_text").isNotNull() & c("weight_num").isNull(),
        "out_of_range_weights": outside(c("weight_num"), 0, 100),
    }
    coursework = c("type_text") != "EXAM"
    keys = ["module_text", "presentation_text"]
    per_course = parsed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_records"),
        *_count_ifs(rules),
        F.count_if(fx.present(coursework)).alias("coursework_rows"),
        F.sum(F.when(coursework, c("weight_num"))).alias("coursework_total"),
    )
    complete = c("module_text").isNotNull() & c("presentation_text").isNotNull()
    totals = joins.flag_matches(per_course, parents, keys, "_known").agg(
        *_add_up(["total_records", *rules]),
        _sum_where(complete & _off_total(c("coursework_total")), "coursework_rows").alias(
            "weight_total_violations"
        ),
        _sum_where(complete & c("_known").isNull(), "total_records").alias("unknown_courses"),
    )
    surplus = aggregates.duplicate_stats(
        parsed.filter(c("assessment_id").isNotNull()), ["assessment_id"]
    ).select(c("excess_rows").alias("duplicate_excess_rows"))
    return one_row(totals, surplus, parents.agg(F.count(F.lit(1)).alias("parent_keys")))


BRONZE_ASSESSMENTS = [
    Spec("COMPLETENESS", "Record Count", "total_records", "The table holds at least one row.",
         level="TABLE", fail=0),
    Spec("COMPLETENESS", "Missing id_assessment", "missing_ids",
         "Every row carries an assessment id.", fail=0),
    Spec("VALIDITY", "Invalid id_assessment Format", "invalid_ids",
         "A given id is a whole number.", fail=0),
    Spec("COMPLETENESS", "Missing code_module", "missing_modules",
         "Every row names its module.", fail=0),
    Spec("COMPLETENESS", "Missing code_presentation", "missing_presentations",
         "Every row names its presentation.", fail=0),
    Spec("COMPLETENESS", "Missing Ingestion Metadata", "missing_metadata",
         "Load timestamp and date are stamped on every row.", fail=0),
    Spec("UNIQUENESS", "Duplicate Assessment IDs", "duplicate_excess_rows",
         "Rows beyond the first of each parsed id.", warn=0),
    Spec("COMPLETENESS", "Missing Assessment Type", "missing_types",
         "Every row has a type; it cannot be inferred.", fail=0),
    Spec("VALIDITY", "Assessment Type Domain", "invalid_types",
         "A given type is one of the known three.", warn=0),
    Spec("VALIDITY", "Invalid Assessment Date Format", "invalid_dates",
         "A given date is a whole day offset.", warn=0),
    Spec("COMPLETENESS", "Missing Assessment Date", "missing_dates",
         "Exams have no published date; a tenth of the rows may lack one.", warn=0.10),
    Spec("COMPLETENESS", "Missing Assessment Weight", "missing_weights",
         "Every row has a weight.", fail=0),
    Spec("VALIDITY", "Invalid Assessment Weight Format", "invalid_weights",
         "A given weight is a number.", fail=0),
    Spec("BUSINESS_RULE", "Assessment Weight Range", "out_of_range_weights",
         "A weight is finite and between 0 and 100.", fail=0),
    Spec("BUSINESS_RULE", "Coursework Weight Total", "weight_total_violations",
         "Coursework of a presentation adds up to 100; rows of presentations where it does not.",
         warn=0.20),
    Spec("COMPLETENESS", "Course Reference Available", "parent_keys",
         "There is a course to compare with.", level="TABLE", total="parent_keys", fail=0),
    Spec("REFERENTIAL_INTEGRITY", "Unknown Module Presentation", "unknown_courses",
         "A complete course key exists among the courses.", warn=0,
         ready=lambda: F.col("parent_keys") > 0),
]


def bronze_assessment_report(
    assessments: DataFrame, courses: DataFrame, checked_at: Column | None = None
) -> DataFrame:
    return threshold_report(
        bronze_assessment_stats(assessments, courses),
        BRONZE_ASSESSMENTS, "BRONZE", "assessments", checked_at,
    )


# --- bronze student assessment ------------------------------------------------

def bronze_submission_stats(
    submissions: DataFrame, assessments: DataFrame, info: DataFrame
) -> DataFrame:
    """One row of counts; references are resolved once per (assessment, student) pair."""
    parsed = parse_bronze(
        submissions,
        {
            "assessment_id_text": "id_assessment", "student_id_text": "id_student",
            "date_text": "date_submitted", "banked_text": "is_banked", "score_text": "score",
        },
        {
            "assessment_id": ("assessment_id_text", "bigint"),
            "student_id": ("student_id_text", "bigint"),
            "submitted_day": ("date_text", "int"),
            "banked_value": ("banked_text", "int"),
            "score_value": ("score_text", "double"),
        },
    )
    course = ["code_module", "code_presentation"]
    mapping = aggregates.parent_mapping(
        parse_bronze(
            assessments,
            {"_id": "id_assessment", **{k: k for k in course}},
            {"assessment_id": ("_id", "bigint")},
            upper=course,
        ),
        "assessment_id", course,
    )
    enrolled = parse_bronze(
        info,
        {"_id": "id_student", **{k: k for k in course}},
        {"student_id": ("_id", "bigint")},
        upper=course,
    ).select("student_id", *course).distinct().dropna()

    c = F.col
    rules = {
        "assessment_id_missing": c("assessment_id_text").isNull(),
        "assessment_id_invalid": c("assessment_id_text").isNotNull() & c("assessment_id").isNull(),
        "student_id_missing": c("student_id_text").isNull(),
        "student_id_invalid": c("student_id_text").isNotNull() & c("student_id").isNull(),
        "metadata_missing": c("ingestion_timestamp").isNull() | c("ingestion_date").isNull(),
        "date_missing": c("date_text").isNull(),
        "date_invalid": c("date_text").isNotNull() & c("submitted_day").isNull(),
        "banked_missing": c("banked_text").isNull(),
        "banked_invalid": c("banked_text").isNotNull()
        & (c("banked_value").isNull() | ~c("banked_value").isin(0, 1)),
        "score_missing": c("score_text").isNull(),
        "score_invalid": c("score_text").isNotNull() & c("score_value").isNull(),
        "score_out_of_range": outside(c("score_value"), 0, 100),
    }
    pairs = parsed.groupBy("assessment_id", "student_id").agg(
        F.count(F.lit(1)).alias("total_records"), *_count_ifs(rules)
    )
    mapped = joins.lookup(
        pairs, mapping.withColumn("_assessment", F.lit(True)), ["assessment_id"]
    ).withColumn("_usable", fx.present(
        (c("mapping_count") == 1) & c("code_module").isNotNull()
        & c("code_presentation").isNotNull()
    ))
    placed = joins.lookup(
        mapped, enrolled.withColumn("_enrolled", F.lit(True)), ["student_id", *course],
        gate=mapped["mapping_count"] == 1,
    )
    anywhere = joins.flag_matches(placed, enrolled, ["student_id"], "_anywhere")
    known, evaluable = c("_assessment").isNotNull(), c("student_id").isNotNull() & c("_usable")
    n = c("total_records")
    totals = anywhere.agg(
        *_add_up(["total_records", *rules]),
        _sum_where(c("assessment_id").isNotNull() & ~known, "total_records").alias(
            "assessment_orphans"
        ),
        _sum_where(known & ~c("_usable"), "total_records").alias("mapping_unusable"),
        _sum_where(
            c("student_id").isNotNull() & c("_anywhere").isNull(), "total_records"
        ).alias("student_not_in_any_enrollment"),
        _sum_where(evaluable, "total_records").alias("enrollment_evaluable"),
        _sum_where(evaluable & c("_enrolled").isNull(), "total_records").alias(
            "enrollment_orphans"
        ),
        F.coalesce(
            F.sum(F.when(
                c("assessment_id").isNotNull() & c("student_id").isNotNull(), n - 1
            )), F.lit(0),
        ).alias("excess_duplicate_rows"),
    )
    return one_row(
        totals,
        mapping.agg(F.count(F.lit(1)).alias("assessment_parent_count")),
        enrolled.agg(F.count(F.lit(1)).alias("student_parent_count")),
    )


def _assessments_known() -> Column:
    return F.col("assessment_parent_count") > 0


def _students_known() -> Column:
    return F.col("student_parent_count") > 0


def _enrollments_comparable() -> Column:
    return _assessments_known() & _students_known() & (F.col("enrollment_evaluable") > 0)


BRONZE_SUBMISSIONS = [
    Spec("COMPLETENESS", "Record Count", "total_records", "The table holds at least one row.",
         level="TABLE", severity="FAIL"),
    Spec("COMPLETENESS", "Missing id_assessment", "assessment_id_missing",
         "Every row carries an assessment id.", severity="FAIL"),
    Spec("VALIDITY", "Invalid id_assessment Format", "assessment_id_invalid",
         "A given assessment id is a whole number.", severity="FAIL"),
    Spec("COMPLETENESS", "Missing id_student", "student_id_missing",
         "Every row carries a student id.", severity="FAIL"),
    Spec("VALIDITY", "Invalid id_student Format", "student_id_invalid",
         "A given student id is a whole number.", severity="FAIL"),
    Spec("COMPLETENESS", "Missing Ingestion Metadata", "metadata_missing",
         "Load timestamp and date are stamped on every row.", severity="FAIL"),
    Spec("UNIQUENESS", "Duplicate Student-Assessment Keys", "excess_duplicate_rows",
         "Rows beyond the first of each parsed pair.", severity="WARNING"),
    Spec("COMPLETENESS", "Missing date_submitted", "date_missing",
         "A submission day is given; none is invented.", severity="WARNING"),
    Spec("VALIDITY", "Invalid date_submitted Format", "date_invalid",
         "A given submission day is a whole day offset, negative ones included.",
         severity="WARNING"),
    Spec("COMPLETENESS", "Missing is_banked", "banked_missing",
         "The banked flag is given.", severity="FAIL"),
    Spec("VALIDITY", "Invalid is_banked Value", "banked_invalid",
         "A given banked flag is 0 or 1.", severity="FAIL"),
    Spec("COMPLETENESS", "Missing Score", "score_missing",
         "A blank score is a non-submission: counted, kept, never zero.", severity="WARNING"),
    Spec("VALIDITY", "Invalid Score Format", "score_invalid",
         "A given score is a number.", severity="FAIL"),
    Spec("BUSINESS_RULE", "Score Out of Range", "score_out_of_range",
         "A score is finite and between 0 and 100.", severity="FAIL"),
    Spec("REFERENTIAL_INTEGRITY", "Assessment Reference Available", "assessment_parent_count",
         "There is an assessment to compare with.", level="TABLE",
         total="assessment_parent_count", severity="FAIL"),
    Spec("REFERENTIAL_INTEGRITY", "Student Enrollment Reference Available",
         "student_parent_count", "There is an enrollment to compare with.", level="TABLE",
         total="student_parent_count", severity="FAIL"),
    Spec("REFERENTIAL_INTEGRITY", "Orphan Assessment Reference", "assessment_orphans",
         "A parsed assessment id exists among the assessments.", severity="FAIL",
         ready=_assessments_known),
    Spec("REFERENTIAL_INTEGRITY", "Unusable Assessment Module Mapping", "mapping_unusable",
         "A known assessment belongs to exactly one complete course key.", severity="FAIL",
         ready=_assessments_known),
    Spec("REFERENTIAL_INTEGRITY", "Student Not In Any Enrollment",
         "student_not_in_any_enrollment", "A parsed student is enrolled somewhere.",
         severity="FAIL", ready=_students_known),
    Spec("REFERENTIAL_INTEGRITY", "Orphan Student Enrollment Reference", "enrollment_orphans",
         "The student is enrolled on the presentation of the assessment.", severity="FAIL",
         ready=_enrollments_comparable),
]


def bronze_submission_report(
    submissions: DataFrame,
    assessments: DataFrame,
    info: DataFrame,
    checked_at: Column | None = None,
) -> DataFrame:
    return severity_report(
        bronze_submission_stats(submissions, assessments, info),
        BRONZE_SUBMISSIONS, "BRONZE", "student_assessment_bronze", checked_at,
    )


# --- silver assessments --------------------------------------------------------

def evaluate_assessments(assessments: DataFrame, courses: DataFrame) -> DataFrame:
    """Silver assessments with key occurrences, course match and coursework total."""
    course = ["code_module", "code_presentation"]
    keys = courses.select(*course, "module_presentation_length").distinct().withColumn(
        "matched_module", F.col("code_module")
    )
    totals = (
        assessments.filter(F.col("assessment_type") != "Exam")
        .groupBy(*course)
        .agg(F.sum("weight").alias("coursework_total"))
    )
    rows = copies.with_key_occurrences(assessments, ["id_assessment"])
    return joins.lookup(joins.lookup(rows, keys, course), totals, course)


def assessment_rules() -> dict[str, Column]:
    c = F.col
    required = ("id_assessment", "code_module", "code_presentation", "assessment_type",
                "weight", "ingestion_timestamp")
    missing = F.lit(False)
    for column in required:
        missing = missing | c(column).isNull()
    return {
        "required_column_null": missing,
        "id_not_positive": c("id_assessment") <= 0,
        "duplicate_id": c("key_occurrences") > 1,
        "invalid_type": ~c("assessment_type").isin(TYPES_CLEAN),
        "weight_out_of_range": outside(c("weight"), 0, 100),
        "date_out_of_range": (c("date") < 0) | (c("date") > 1000),
        "orphan_course": c("matched_module").isNull(),
        "coursework_weight_total": (c("assessment_type") != "Exam")
        & _off_total(c("coursework_total")),
        "exam_weight_not_100": (c("assessment_type") == "Exam")
        & (c("weight") != EXPECTED_TOTAL),
        "date_source_not_captured": c("date").isNull() & c("date_source").isNull(),
    }


def rejected_assessments(assessments: DataFrame, courses: DataFrame) -> DataFrame:
    return refusals.rejected_rows(
        evaluate_assessments(assessments, courses),
        assessment_rules(),
        ["id_assessment", "code_module", "code_presentation", "assessment_type", "date",
         "date_source", "weight", "module_presentation_length", "coursework_total"],
    )


def silver_assessment_stats(
    assessments: DataFrame, courses: DataFrame, bronze: DataFrame
) -> DataFrame:
    spec = cleaning.ASSESSMENTS
    rules = {**assessment_rules(), "date_missing": F.col("date").isNull()}
    evaluated = evaluate_assessments(assessments, courses)
    return one_row(
        evaluated.agg(F.count(F.lit(1)).alias("total_records"), *_count_ifs(rules)),
        courses.agg(F.count(F.lit(1)).alias("course_parent_count")),
        bronze.agg(F.count(F.lit(1)).alias("bronze_records")),
        refusals.refused_count(spec.parse(bronze), assessments, spec.keys),
    )


def _unbalanced() -> Column:
    return (
        F.col("bronze_records") - F.col("total_records") - F.col("refused_records") != 0
    )


SILVER_ASSESSMENTS = [
    Spec("COMPLETENESS", "Record Count", "total_records", "The table holds at least one row.",
         level="TABLE", severity="FAIL"),
    Spec("COMPLETENESS", "Row Accounting Balances", "bronze_records",
         "Bronze rows equal silver rows plus refused rows.", level="TABLE",
         total="bronze_records", severity="FAIL", broken=_unbalanced),
    Spec("TRANSFORM", "Required Column NULL", "required_column_null",
         "Required columns are filled after cleaning.", severity="FAIL"),
    Spec("TRANSFORM", "Non-Positive id_assessment", "id_not_positive",
         "The id is positive.", severity="FAIL"),
    Spec("UNIQUENESS", "Duplicate id_assessment", "duplicate_id",
         "One row per assessment.", severity="FAIL"),
    Spec("VALIDITY", "Invalid Assessment Type", "invalid_type",
         "The type is one of the three clean values.", severity="FAIL"),
    Spec("VALIDITY", "Weight Out of Range", "weight_out_of_range",
         "The weight is finite and between 0 and 100.", severity="FAIL"),
    Spec("VALIDITY", "Assessment Date Out of Range", "date_out_of_range",
         "A date lies between day 0 and day 1000.", severity="FAIL"),
    Spec("REFERENTIAL_INTEGRITY", "Orphan Module Presentation", "orphan_course",
         "The course exists; cleaning does not test it.", severity="FAIL",
         ready=lambda: F.col("course_parent_count") > 0),
    Spec("BUSINESS_RULE", "Coursework Weight Total", "coursework_weight_total",
         "Coursework of a presentation adds up to 100; rows where it does not.",
         severity="WARNING"),
    Spec("BUSINESS_RULE", "Exam Weight Not 100", "exam_weight_not_100",
         "An exam weighs 100.", severity="WARNING"),
    Spec("COMPLETENESS", "Missing Assessment Date", "date_missing",
         "Exams have no published date; counted, never imputed.", severity="WARNING"),
    Spec("CONSISTENCY", "Date Source Not Captured", "date_source_not_captured",
         "Where the date is unknown, the received text is kept.", severity="FAIL"),
]


def silver_assessment_report(
    assessments: DataFrame,
    courses: DataFrame,
    bronze: DataFrame,
    checked_at: Column | None = None,
) -> DataFrame:
    return severity_report(
        silver_assessment_stats(assessments, courses, bronze),
        SILVER_ASSESSMENTS, "SILVER", "assessments_silver", checked_at,
    )


# --- silver student assessment ---------------------------------------------------

def evaluate_submissions(
    submissions: DataFrame,
    assessments: DataFrame,
    info: DataFrame,
    registration: DataFrame,
) -> DataFrame:
    """Silver submissions with their assessment, enrollment and registration beside them.

    The student is looked up before the assessment, whose codes make the rows wider.
    """
    course = ["code_module", "code_presentation"]
    enrollment = ["id_student", *course]
    parent = assessments.select(
        "id_assessment", *course, F.lit(True).alias("matched_assessment")
    )
    enrolled = info.select(
        *enrollment, "num_of_prev_attempts", F.lit(True).alias("matched_enrollment")
    )
    rows = copies.with_key_occurrences(submissions, ["id_assessment", "id_student"])
    rows = joins.flag_matches(rows, info, ["id_student"], "student_exists_anywhere")
    rows = joins.lookup(rows, parent, ["id_assessment"])
    both = enrolled.dropna(subset=enrollment).join(
        registration.select(*enrollment, "date_registration").dropna(subset=enrollment),
        enrollment, "full")
    return joins.lookup(rows, both, enrollment)


def submission_rules() -> dict[str, Column]:
    c = F.col
    missing = F.lit(False)
    for column in ("id_assessment", "id_student", "date_submitted", "is_banked",
                   "ingestion_timestamp"):
        missing = missing | c(column).isNull()
    resolved = c("matched_assessment").isNotNull() & c("student_exists_anywhere").isNotNull()
    return {
        "required_column_null": missing,
        "key_not_positive": (c("id_assessment") <= 0) | (c("id_student") <= 0),
        "duplicate_key": c("key_occurrences") > 1,
        "is_banked_invalid": ~c("is_banked").isin(0, 1),
        "score_out_of_range": c("score").isNotNull() & outside(c("score"), 0, 100),
        "date_out_of_range": (c("date_submitted") < -365) | (c("date_submitted") > 1825),
        "orphan_assessment": c("matched_assessment").isNull(),
        "student_not_in_any_enrollment": c("student_exists_anywhere").isNull(),
        "orphan_enrollment": resolved & c("matched_enrollment").isNull(),
        "banked_without_prior_attempt": (c("is_banked") == 1)
        & c("matched_enrollment").isNotNull()
        & (F.coalesce("num_of_prev_attempts", F.lit(0)) == 0),
        "submitted_before_registration": c("date_submitted") < c("date_registration"),
        "score_source_not_captured": c("score").isNull() & c("score_source").isNull(),
    }


def rejected_submissions(
    submissions: DataFrame,
    assessments: DataFrame,
    info: DataFrame,
    registration: DataFrame,
) -> DataFrame:
    return refusals.rejected_rows(
        evaluate_submissions(submissions, assessments, info, registration),
        submission_rules(),
        ["id_assessment", "id_student", "date_submitted", "is_banked", "score",
         "score_source", "code_module", "code_presentation", "num_of_prev_attempts",
         "date_registration"],
    )


def silver_submission_stats(
    submissions: DataFrame,
    assessments: DataFrame,
    info: DataFrame,
    registration: DataFrame,
    bronze: DataFrame,
) -> DataFrame:
    spec = cleaning.STUDENT_ASSESSMENT
    c = F.col
    rules = {
        **submission_rules(),
        "enrollment_evaluable": c("matched_assessment").isNotNull()
        & c("student_exists_anywhere").isNotNull(),
        "banked_rows": c("is_banked") == 1,
        "score_missing": c("score").isNull(),
    }
    evaluated = evaluate_submissions(submissions, assessments, info, registration)
    return one_row(
        evaluated.agg(F.count(F.lit(1)).alias("total_records"), *_count_ifs(rules)),
        assessments.agg(F.count(F.lit(1)).alias("assessment_parent_count")),
        info.agg(F.count(F.lit(1)).alias("student_parent_count")),
        bronze.agg(F.count(F.lit(1)).alias("bronze_records")),
        refusals.refused_count(spec.parse(bronze), submissions, spec.keys),
    )


SILVER_SUBMISSIONS = [
    Spec("COMPLETENESS", "Record Count", "total_records", "The table holds at least one row.",
         level="TABLE", severity="FAIL"),
    Spec("COMPLETENESS", "Row Accounting Balances", "bronze_records",
         "Bronze rows equal silver rows plus refused rows.", level="TABLE",
         total="bronze_records", severity="FAIL", broken=_unbalanced),
    Spec("TRANSFORM", "Required Column NULL", "required_column_null",
         "Required columns are filled after cleaning; a score is not required.",
         severity="FAIL"),
    Spec("TRANSFORM", "Non-Positive Keys", "key_not_positive",
         "Both ids are positive.", severity="FAIL"),
    Spec("UNIQUENESS", "Duplicate Student-Assessment Key", "duplicate_key",
         "One row per student and assessment.", severity="FAIL"),
    Spec("VALIDITY", "Invalid is_banked Value", "is_banked_invalid",
         "The banked flag is 0 or 1.", severity="FAIL"),
    Spec("VALIDITY", "Score Out of Range", "score_out_of_range",
         "A score is finite and between 0 and 100.", severity="FAIL"),
    Spec("VALIDITY", "Date Submitted Out of Range", "date_out_of_range",
         "The submission day lies between -365 and 1825.", severity="FAIL"),
    Spec("REFERENTIAL_INTEGRITY", "Orphan Assessment Reference", "orphan_assessment",
         "The assessment reached silver; cleaning does not test it.", severity="FAIL",
         ready=_assessments_known),
    Spec("REFERENTIAL_INTEGRITY", "Student Not In Any Enrollment",
         "student_not_in_any_enrollment", "The student is enrolled somewhere.",
         severity="FAIL", ready=_students_known),
    Spec("REFERENTIAL_INTEGRITY", "Orphan Student Enrollment Reference", "orphan_enrollment",
         "A known student is enrolled on the presentation of a known assessment.",
         severity="FAIL", ready=_enrollments_comparable),
    Spec("BUSINESS_RULE", "Banked Without Prior Attempt", "banked_without_prior_attempt",
         "A banked score needs an earlier attempt.", severity="WARNING",
         ready=lambda: F.col("banked_rows") > 0),
    Spec("BUSINESS_RULE", "Submitted Before Registration", "submitted_before_registration",
         "The submission follows the registration; banked scores may precede it.",
         severity="WARNING"),
    Spec("COMPLETENESS", "Missing Score", "score_missing",
         "A NULL score is a non-submission: counted, kept, never zero.", severity="WARNING"),
    Spec("CONSISTENCY", "Score Source Not Captured", "score_source_not_captured",
         "Where the score is unknown, the received text is kept.", severity="FAIL"),
]


def silver_submission_report(
    submissions: DataFrame,
    assessments: DataFrame,
    info: DataFrame,
    registration: DataFrame,
    bronze: DataFrame,
    checked_at: Column | None = None,
) -> DataFrame:
    return severity_report(
        silver_submission_stats(submissions, assessments, info, registration, bronze),
        SILVER_SUBMISSIONS, "SILVER", "student_assessment_silver", checked_at,
    )
