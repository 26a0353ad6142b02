"""The single-statement checks of every table, as configurations of the builders.

Each function takes the tables it compares and returns the table's checks in
report order. ``as_of`` stands for today, so that a report can be repeated.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studylake import schemas
from studylake.functions import columns as fx
from studylake.quality import builders as b
from studylake.quality.builders import Check, Result

COURSE = ["code_module", "code_presentation"]
ENROLLMENT = [*COURSE, "id_student"]
BANDS_OR_UNKNOWN = [*schemas.IMD_BANDS, schemas.PLACEHOLDER]
RESULTS_UPPER = [r.upper() for r in schemas.FINAL_RESULTS]
MAX_CREDITS = 300


def _named(*columns: str, **renamed: str) -> dict[str, str]:
    """Metric name to column: ``null_<column>`` unless given."""
    return {**{f"null_{c}": c for c in columns}, **{f"null_{k}": c for k, c in renamed.items()}}


def _int(column: str) -> Column:
    return F.col(column).try_cast("int")


def _today(as_of: Column | None) -> Column:
    return F.current_date() if as_of is None else as_of


def _load_span() -> dict[str, Column]:
    return {"earliest_ingestion": F.min("ingestion_date"),
            "latest_ingestion": F.max("ingestion_date")}


def _span(column: Column, what: str) -> dict[str, Column]:
    return {f"min_{what}": F.min(column), f"max_{what}": F.max(column)}


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)))


def _count_distinct(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(F.countDistinct(*columns))


def _standard_codes() -> dict[str, tuple[str, Column]]:
    return {
        "unstandardized_module": ("code_module", fx.norm_code(F.col("code_module"))),
        "unstandardized_presentation": (
            "code_presentation", fx.norm_code(F.col("code_presentation"))
        ),
    }


# --- verdicts that compare two layers -------------------------------------------

def _shrunk(m: Result) -> Column:
    before, after = m("bronze_count"), m("silver_count")
    return (
        F.when((after <= before) & (after > 0), "PASS")
        .when(after > before, "FAIL")
        .otherwise("WARNING")
    )


def _at_least(before: str, after: str):
    def verdict(m: Result) -> Column:
        return (
            F.when(m(after) >= m(before) * 0.95, "PASS")
            .when(m(after) >= m(before) * 0.90, "WARNING")
            .otherwise("FAIL")
        )

    return verdict


def _equal(m: Result) -> Column:
    return F.when(m("source_count") == m("target_count"), "PASS").otherwise("FAIL")


def bronze_to_silver(code: str, bronze: DataFrame, silver: DataFrame) -> Check:
    return b.layer_retention(
        code, "Bronze to Silver Record Count",
        ("bronze_count", _count(bronze)), ("silver_count", _count(silver)), _shrunk,
        derived={
            "records_filtered": lambda m: m("bronze_count") - m("silver_count"),
            "retention_rate_pct": lambda m: fx.pct(m("silver_count"), m("bronze_count")),
        },
    )


def _missing_in_gold(before: str, after: str):
    return {"missing_in_gold": lambda m: m(before) - m(after)}


# --- bronze ------------------------------------------------------------------------

def bronze_courses(bronze: DataFrame) -> list[Check]:
    length = _int("module_presentation_length")
    required = _named(*COURSE, "module_presentation_length")
    return [
        b.row_count("1.1"),
        b.not_null("1.2", "Null Value Assessment", required, bad="WARNING"),
        b.unique("1.3", "Duplicate Business Keys", bronze, COURSE, bad="WARNING"),
        b.in_range("1.4", "VALIDITY", "Presentation Length Range",
                   {"invalid_presentation_length_records": length <= 0},
                   _span(length, "length")),
        b.distinct_list("2.1", "Distinct Module Codes", "code_module"),
        b.distinct_list("2.2", "Distinct Presentation Codes", "code_presentation"),
        b.profile("3.1", {
            "row_count": b.rows(),
            "duplicate_records": b.rows() - F.countDistinct(*COURSE),
            **b.nulls(required),
            "invalid_presentation_length_records": b.violations(length <= 0),
            **_load_span(),
        }),
    ]


def bronze_student_info(bronze: DataFrame, as_of: Column | None = None) -> list[Check]:
    credits = _int("studied_credits")
    return [
        b.row_count("1.1"),
        b.not_null("1.2", "Required Columns",
                   _named(*ENROLLMENT, "ingestion_timestamp", "ingestion_date")),
        b.unique("1.3", "Duplicate Primary Keys", bronze, ENROLLMENT, bad="WARNING", empty=None),
        b.in_domain(
            "1.4", "VALIDITY", "Data Type Conformance",
            {"invalid_gender": (F.col("gender"), schemas.RAW_GENDERS),
             "invalid_disability": (F.col("disability"), ["Y", "N", "y", "n"])},
            also={"negative_prev_attempts": _int("num_of_prev_attempts") < 0,
                  "negative_credits": credits < 0},
        ),
        b.fresh("1.5", _today(as_of)),
        b.in_domain(
            "2.1", "BUSINESS_RULE", "IMD Band Domain Values",
            {"invalid_imd_band": (F.col("imd_band"), BANDS_OR_UNKNOWN)}, total=False,
            counts={"distinct_values": F.countDistinct("imd_band")},
            listed=["imd_band"],
        ),
        b.in_domain(
            "2.2", "BUSINESS_RULE", "Final Result Domain",
            {"invalid_results": (fx.norm_code(F.col("final_result")), RESULTS_UPPER)},
            counts={"distinct_values": F.countDistinct("final_result")},
            listed=["final_result"],
        ),
        b.in_range(
            "2.3", "BUSINESS_RULE", "Reasonable Credit Load",
            {"zero_credits": credits == 0, "excessive_credits": credits > MAX_CREDITS},
            {**_span(credits, "credits"), "avg_credits": F.round(F.avg(credits), 2)},
            warn_below=0.01,
        ),
        b.profile("3.1", {
            "total_records": b.rows(),
            "unique_students": F.countDistinct("id_student"),
            "unique_course_presentations": F.countDistinct(*COURSE),
            **_load_span(),
        }),
    ]


def bronze_student_registration(
    bronze: DataFrame, as_of: Column | None = None
) -> list[Check]:
    """Registration days are compared as the integers they are."""
    start, end = _int("date_registration"), _int("date_unregistration")
    left = bronze.filter(F.col("date_unregistration").isNotNull())
    return [
        b.row_count("1.1"),
        b.not_null("1.2", "Required Columns",
                   _named(*ENROLLMENT, "date_registration", "ingestion_timestamp")),
        b.distribution("1.3", "COMPLETENESS", "Unregistration Date Distribution", {
            "total_records": b.rows(),
            "null_unregistration": b.violations(F.col("date_unregistration").isNull()),
            "has_unregistration": b.violations(F.col("date_unregistration").isNotNull()),
            "unregistration_rate_pct": fx.pct(F.count("date_unregistration"), b.rows()),
        }),
        b.unique("1.4", "Duplicate Primary Keys", bronze, ENROLLMENT, bad="WARNING"),
        b.fresh("1.5", _today(as_of)),
        b.in_range("2.1", "BUSINESS_RULE", "Valid Registration Date",
                   {"future_registration_dates": fx.offset_date(start) > _today(as_of)},
                   {"earliest_registration": F.min(start), "latest_registration": F.max(start)}),
        b.ordered_pair("2.2", "BUSINESS_RULE", "Unregistration After Registration",
                       "invalid_date_sequence", start, end, frame=left,
                       total="total_records_with_unreg"),
        b.distribution("2.3", "BUSINESS_RULE", "Registration Duration", {
            "total_with_duration": b.rows(),
            "avg_days_registered": F.round(F.avg(end - start), 2),
            "min_days_registered": F.min(end - start),
            "max_days_registered": F.max(end - start),
            "same_day_unregistrations": b.violations(end - start == 0),
        }, frame=left),
        b.profile("3.1", {
            "total_records": b.rows(),
            "unique_students": F.countDistinct("id_student"),
            "unique_course_presentations": F.countDistinct(*COURSE),
            **_load_span(),
        }),
    ]


def bronze_vle(bronze: DataFrame) -> list[Check]:
    first, last = _int("week_from"), _int("week_to")
    malformed, inverted = first.isNull() | last.isNull(), first > last
    negative = (first < 0) | (last < 0)
    return [
        b.row_count("1.1"),
        b.not_null("1.2", "Null Value Assessment",
                   _named("id_site", *COURSE, "activity_type", "week_from", "week_to"),
                   bad="WARNING"),
        b.unique("1.3", "Duplicate Site IDs", bronze, ["id_site"], bad="WARNING",
                 metric="duplicate_ids"),
        b.parseable("1.4", "Week Value Format", "malformed_week_records",
                    ["week_from", "week_to"], "int"),
        b.ordered_pair("1.5", "VALIDITY", "Week Range Logic", "invalid_week_range_records",
                       first, last),
        b.in_range("1.6", "VALIDITY", "Non-Negative Week Values",
                   {"negative_week_records": negative}),
        b.distinct_list("2.1", "Distinct Module Codes", "code_module"),
        b.distinct_list("2.2", "Distinct Presentation Codes", "code_presentation"),
        b.distinct_list("2.3", "Distinct Activity Types", "activity_type"),
        b.distinct_list("2.4", "Ingestion Dates", "ingestion_date"),
        b.profile("3.1", {
            "row_count": b.rows(),
            "duplicate_records": b.rows() - F.countDistinct("id_site"),
            **b.nulls(_named("id_site", *COURSE, "activity_type")),
            "malformed_week_records": b.violations(malformed),
            "invalid_week_range_records": b.violations(inverted),
            "negative_week_records": b.violations(negative),
            **_load_span(),
        }),
    ]


# --- silver ------------------------------------------------------------------------

def silver_courses(silver: DataFrame) -> list[Check]:
    length = F.col("module_presentation_length")
    required = _named(*COURSE, "module_presentation_length")
    codes = _standard_codes()
    return [
        b.row_count("1.1"),
        b.not_null("1.2", "Required Columns", required),
        b.unique("1.3", "No Duplicate Business Keys", silver, COURSE),
        b.in_range("1.4", "VALIDITY", "Presentation Length Range",
                   {"invalid_presentation_length_records": length <= 0},
                   _span(length, "length")),
        b.standardized("2.1", "BUSINESS_RULE", "Standardized Course Codes", {
            "invalid_module_codes": codes["unstandardized_module"],
            "invalid_presentation_codes": codes["unstandardized_presentation"],
        }),
        b.profile("3.1", {
            "row_count": b.rows(),
            "duplicate_records": b.rows() - F.countDistinct(*COURSE),
            **b.nulls(required),
            "invalid_presentation_length_records": b.violations(length <= 0),
            **_load_span(),
        }),
    ]


def silver_student_info(silver: DataFrame, bronze: DataFrame) -> list[Check]:
    credits, attempts = F.col("studied_credits"), F.col("num_of_prev_attempts")
    gender = (F.col("gender"), ["M", "F"])
    return [
        b.row_count("1.1"),
        b.not_null("1.2", "Primary Key Completeness", _named(*ENROLLMENT)),
        b.unique("1.3", "No Duplicate Primary Keys", silver, ENROLLMENT),
        b.standardized("1.4", "VALIDITY", "Data Standardization", _standard_codes(), {
            "invalid_gender": gender,
            "invalid_disability": (F.col("disability"), [True, False]),
        }),
        b.not_null("1.5", "Required Business Columns", _named(
            "gender", "region", "imd_band", "age_band", "disability", "final_result",
            education="highest_education",
        )),
        b.in_range("2.1", "BUSINESS_RULE", "IMD Band Valid Values Only",
                   {"records_with_unknown_imd": F.col("imd_band") == schemas.PLACEHOLDER}),
        b.in_range("2.2", "BUSINESS_RULE", "Valid Credit Range",
                   {"zero_or_negative_credits": credits <= 0,
                    "excessive_credits": credits > MAX_CREDITS},
                   _span(credits, "credits")),
        b.in_range("2.3", "BUSINESS_RULE", "Previous Attempts Non-Negative",
                   {"negative_attempts": attempts < 0}, _span(attempts, "attempts")),
        bronze_to_silver("3.1", bronze, silver),
        b.in_domain("3.2", "CONSISTENCY", "Categorical Domain Values", {
            "invalid_gender": gender,
            "invalid_imd": (F.col("imd_band"), schemas.IMD_BANDS),
            "invalid_result": (F.col("final_result"), schemas.FINAL_RESULTS),
        }, total=False),
        b.profile("4.1", {
            "total_records": b.rows(),
            "unique_students": F.countDistinct("id_student"),
            "unique_course_presentations": F.countDistinct(*COURSE),
            "unique_genders": F.countDistinct("gender"),
            "unique_education_levels": F.countDistinct("highest_education"),
            **_load_span(),
        }),
    ]


def silver_student_registration(
    silver: DataFrame, bronze: DataFrame, info: DataFrame, as_of: Column | None = None
) -> list[Check]:
    start, end = F.col("date_registration"), F.col("date_unregistration")

    def plausible(m: Result) -> Column:
        return F.when(m("withdrawal_rate_pct").between(0, 100), "PASS").otherwise("FAIL")

    return [
        b.row_count("1.1"),
        b.not_null("1.2", "Primary Key Completeness", _named(*ENROLLMENT)),
        b.not_null("1.3", "Registration Date Required",
                   {"null_registration_dates": "date_registration"}),
        b.unique("1.4", "No Duplicate Primary Keys", silver, ENROLLMENT),
        b.standardized("1.5", "VALIDITY", "Data Standardization", _standard_codes()),
        b.in_range("2.1", "BUSINESS_RULE", "Valid Registration Date",
                   {"future_registration_dates": fx.offset_date(start) > _today(as_of)},
                   {"earliest_registration": F.min(fx.offset_date(start)),
                    "latest_registration": F.max(fx.offset_date(start))}),
        b.ordered_pair("2.2", "BUSINESS_RULE", "Unregistration After Registration",
                       "invalid_date_sequence", start, end,
                       frame=silver.filter(end.isNotNull()), total="total_records_with_unreg"),
        b.distribution("2.3", "BUSINESS_RULE", "Withdrawal Rate", {
            "total_registrations": b.rows(),
            "total_withdrawals": b.violations(end.isNotNull()),
            "withdrawal_rate_pct": fx.pct(F.count("date_unregistration"), b.rows()),
        }, status=plausible, description="The withdrawal rate is a percentage."),
        bronze_to_silver("3.1", bronze, silver),
        b.foreign_key("3.2", "CONSISTENCY", "Referential Integrity to Student Info",
                      "orphaned_registrations", silver, info, ENROLLMENT, bad="WARNING"),
        b.profile("4.1", {
            "total_records": b.rows(),
            "unique_students": F.countDistinct("id_student"),
            "unique_course_presentations": F.countDistinct(*COURSE),
            "students_who_withdrew": b.violations(end.isNotNull()),
            **_load_span(),
        }),
    ]


def silver_vle(silver: DataFrame) -> list[Check]:
    required = _named("id_site", *COURSE, "activity_type", "week_from", "week_to")
    first, last = F.col("week_from"), F.col("week_to")
    return [
        b.row_count("1.1"),
        b.not_null("1.2", "Required Business Columns", required),
        b.unique("1.3", "No Duplicate Business Keys", silver, ["id_site"],
                 metric="duplicate_ids"),
        b.ordered_pair("1.4", "VALIDITY", "Week Range Logic", "invalid_week_range_records",
                       first, last),
        b.standardized("2.1", "BUSINESS_RULE", "Standardized Activity Types", {
            "unstandardized_activity_types": ("activity_type", F.trim(F.col("activity_type")))
        }),
        b.distribution("2.2", "BUSINESS_RULE", "Activity Type Coverage",
                       {"distinct_activity_types": F.countDistinct("activity_type")},
                       distinct=True),
        b.profile("3.1", {
            "row_count": b.rows(),
            "duplicate_records": b.rows() - F.countDistinct("id_site"),
            **b.nulls(required),
            "invalid_week_range_records": b.violations(first > last),
            **_load_span(),
        }),
    ]


# --- gold ----------------------------------------------------------------------------

def gold_dim_course(dim: DataFrame, courses: DataFrame) -> list[Check]:
    required = _named("course_id", *COURSE, "module_presentation_length")
    return [
        b.row_count("1.1"),
        b.not_null("1.2", "Null Value Assessment", required),
        b.unique_by_distinct("1.3", "Duplicate Dimension Keys", "duplicate_course_id",
                             ["course_id"]),
        b.layer_retention("2.1", "Source to Target Record Count",
                          ("source_count", _count_distinct(courses, *COURSE)),
                          ("target_count", _count(dim)), _equal),
        b.profile("3.1", {
            "total_rows": b.rows(),
            "distinct_course_id": F.countDistinct("course_id"),
            "duplicate_course_id": b.rows() - F.countDistinct("course_id"),
            **b.nulls(required),
        }),
    ]


def gold_dim_course_phase(dim: DataFrame) -> list[Check]:
    required = _named("phase_id", "phase_name")
    return [
        b.row_count("1.1"),
        b.not_null("1.2", "Null Value Assessment", required),
        b.unique_by_distinct("1.3", "Duplicate Dimension Keys", "duplicate_phase_id",
                             ["phase_id"]),
        b.not_blank("2.1", "Valid Phase Names", "blank_phase_names", "phase_name"),
        b.profile("3.1", {
            "total_rows": b.rows(),
            "distinct_phase_id": F.countDistinct("phase_id"),
            "duplicate_phase_id": b.rows() - F.countDistinct("phase_id"),
            **b.nulls(required),
        }),
    ]


def gold_dim_course_week(
    dim: DataFrame, phases: DataFrame, courses: DataFrame
) -> list[Check]:
    """The week rule asks for positive weeks although the calendar starts before week 1."""
    required = _named("course_id", "week_id", "week_number", "phase_id")
    key, week = ["course_id", "week_id"], F.col("week_number")
    return [
        b.row_count("1.1"),
        b.not_null("1.2", "Null Value Assessment", required),
        b.unique_by_distinct("1.3", "Duplicate Course Week Keys", "duplicate_course_week", key),
        b.in_range("1.4", "VALIDITY", "Week Number Range",
                   {"invalid_week_number": week <= 0}, _span(week, "week_number")),
        b.foreign_key("2.1", "CONSISTENCY", "Phase Referential Integrity",
                      "orphan_phase_records", dim, phases, ["phase_id"]),
        b.foreign_key("2.2", "CONSISTENCY", "Course Referential Integrity",
                      "orphan_course_records", dim, courses, ["course_id"]),
        b.profile("3.1", {
            "total_rows": b.rows(),
            "distinct_course_week": F.countDistinct(*key),
            "duplicate_course_week": b.rows() - F.countDistinct(*key),
            **b.nulls(required),
            "invalid_week_number": b.violations(week <= 0),
        }),
    ]


def gold_dim_vle(dim: DataFrame, vle: DataFrame) -> list[Check]:
    required = _named("vle_id", "activity_type")
    first, last = F.col("week_from"), F.col("week_to")
    return [
        b.row_count("1.1"),
        b.not_null("1.2", "Null Value Assessment", required),
        b.unique_by_distinct("1.3", "Duplicate Dimension Keys", "duplicate_vle_id", ["vle_id"]),
        b.ordered_pair("1.4", "VALIDITY", "Week Range Logic", "invalid_week_range", first, last),
        b.layer_retention("2.1", "Source to Target Record Count",
                          ("source_count", _count_distinct(vle, "id_site")),
                          ("target_count", _count(dim)), _equal),
        b.profile("3.1", {
            "total_rows": b.rows(),
            "distinct_vle_id": F.countDistinct("vle_id"),
            "duplicate_vle_id": b.rows() - F.countDistinct("vle_id"),
            **b.nulls(required),
            "invalid_week_range": b.violations(first > last),
        }),
    ]


def gold_dim_student(dim: DataFrame, silver_info: DataFrame) -> list[Check]:
    filled = {
        "student_id": "student_id", "gender": "gender", "region": "region",
        "education": "highest_education", "imd_band": "imd_band", "age_band": "age_band",
        "disability": "disability",
    }
    count = F.countDistinct

    def cardinal(m: Result) -> Column:
        return F.when(m("unique_students") == m("total_records"), "PASS").otherwise("FAIL")

    def share(condition: Column) -> Column:
        return fx.pct(F.count_if(fx.present(condition)), b.rows())

    return [
        b.row_count("1.1"),
        b.unique("1.2", "No Duplicate student_id", dim, ["student_id"],
                 metric="duplicate_student_ids"),
        b.not_null("1.3", "Required Dimension Attributes",
                   {f"null_{name}": c for name, c in filled.items()}),
        b.in_domain("1.4", "VALIDITY", "Standardized Dimension Values", {
            "invalid_gender": (F.col("gender"), ["M", "F"]),
            "invalid_disability": (F.col("disability"), ["true", "false"]),
        }),
        b.in_domain(
            "2.1", "BUSINESS_RULE", "Categorical Domain Values",
            {"invalid_imd_band": (F.col("imd_band"), schemas.IMD_BANDS)},
            counts={"distinct_genders": count("gender"),
                    "distinct_education_levels": count("highest_education"),
                    "distinct_age_bands": count("age_band"),
                    "distinct_imd_bands": count("imd_band"),
                    "distinct_regions": count("region")},
        ),
        b.distribution("2.2", "BUSINESS_RULE", "Dimension Cardinality",
                       {"unique_students": count("student_id"), "total_records": b.rows()},
                       status=cardinal, distinct=True, description="One row per student."),
        b.layer_retention(
            "3.1", "Student Count - Silver vs Gold",
            ("silver_students", _count_distinct(silver_info, "id_student")),
            ("gold_students", _count_distinct(dim, "student_id")),
            _at_least("silver_students", "gold_students"),
            derived=_missing_in_gold("silver_students", "gold_students"),
        ),
        b.distribution("3.2", "CONSISTENCY", "Demographic Distribution", {
            "total_students": b.rows(),
            "female_pct": share(F.col("gender") == "F"),
            "male_pct": share(F.col("gender") == "M"),
            "disability_pct": share(F.col("disability") == "true"),
        }, status=b.pass_if_any("total_students")),
        b.profile("4.1", {
            "total_students": b.rows(),
            "unique_student_ids": count("student_id"),
            "unique_regions": count("region"),
            "unique_education_levels": count("highest_education"),
            "unique_age_bands": count("age_band"),
            "unique_imd_bands": count("imd_band"),
        }, name="Dimension Profile"),
        b.completeness("4.2", filled),
    ]


def gold_dim_student_enrollment(
    dim: DataFrame, students: DataFrame, silver_info: DataFrame
) -> list[Check]:
    filled = {
        "enrollment_id": "student_enrollment_id", "student_id": "student_id",
        "course_id": "course_id", "prev_attempts": "num_of_prev_attempts",
        "credits": "studied_credits", "final_result": "final_result",
    }
    attempts, credits = F.col("num_of_prev_attempts"), F.col("studied_credits")
    result = fx.norm_code(F.col("final_result"))
    per_student = dim.groupBy("student_id").agg(b.rows().alias("enrollment_count"))
    enrollments = F.col("enrollment_count")
    return [
        b.row_count("1.1"),
        b.unique("1.2", "No Duplicate student_enrollment_id", dim, ["student_enrollment_id"],
                 metric="duplicate_enrollment_ids"),
        b.not_null("1.3", "Required Enrollment Attributes",
                   {f"null_{name}": c for name, c in filled.items()}),
        b.in_range("1.4", "VALIDITY", "Value Range Validation",
                   {"negative_attempts": attempts < 0,
                    "zero_or_negative_credits": credits <= 0,
                    "excessive_credits": credits > MAX_CREDITS},
                   {**_span(attempts, "attempts"), **_span(credits, "credits")}),
        b.in_domain(
            "2.1", "BUSINESS_RULE", "Final Result Domain",
            {"invalid_results": (result, RESULTS_UPPER)},
            counts={"distinct_results": F.countDistinct("final_result")},
            listed=["final_result"],
        ),
        b.distribution("2.2", "BUSINESS_RULE", "Enrollment Outcome Distribution", {
            "total_enrollments": b.rows(),
            "pass_count": b.violations(result == "PASS"),
            "fail_count": b.violations(result == "FAIL"),
            "distinction_count": b.violations(result == "DISTINCTION"),
            "withdrawn_count": b.violations(result == "WITHDRAWN"),
            "withdrawal_rate_pct": fx.pct(b.violations(result == "WITHDRAWN"), b.rows()),
        }),
        b.distribution("2.3", "BUSINESS_RULE", "Previous Attempts Distribution", {
            "total_enrollments": b.rows(),
            "first_attempt": b.violations(attempts == 0),
            "second_attempt": b.violations(attempts == 1),
            "three_or_more_attempts": b.violations(attempts >= 2),
            "avg_prev_attempts": F.round(F.avg(attempts), 2),
            "max_prev_attempts": F.max(attempts),
        }),
        b.distribution("2.4", "BUSINESS_RULE", "Credit Load Distribution", {
            "total_enrollments": b.rows(),
            "light_load": b.violations(credits < 60),
            "medium_load": b.violations(credits.between(60, 120)),
            "heavy_load": b.violations(credits > 120),
            "avg_credits": F.round(F.avg(credits), 2),
        }),
        b.foreign_key("3.1", "REFERENTIAL_INTEGRITY", "Valid Student Foreign Keys",
                      "orphaned_enrollments", dim, students, ["student_id"]),
        b.layer_retention(
            "3.2", "Enrollment Count - Silver vs Gold",
            ("silver_enrollments", _count(silver_info)), ("gold_enrollments", _count(dim)),
            _at_least("silver_enrollments", "gold_enrollments"),
            derived={
                **_missing_in_gold("silver_enrollments", "gold_enrollments"),
                "retention_rate_pct": lambda m: fx.pct(
                    m("gold_enrollments"), m("silver_enrollments")
                ),
            },
        ),
        b.distribution("3.3", "CONSISTENCY", "Enrollments per Student", {
            "unique_students": F.count("student_id"),
            "avg_enrollments_per_student": F.round(F.avg(enrollments), 2),
            "min_enrollments": F.min(enrollments),
            "max_enrollments": F.max(enrollments),
            "students_with_one_enrollment": b.violations(enrollments == 1),
            "students_with_multiple_enrollments": b.violations(enrollments > 1),
        }, frame=per_student),
        b.profile("4.1", {
            "total_enrollments": b.rows(),
            "unique_enrollment_ids": F.countDistinct("student_enrollment_id"),
            "unique_students": F.countDistinct("student_id"),
            "unique_courses": F.countDistinct("course_id"),
        }, name="Dimension Profile"),
        b.completeness("4.2", filled),
    ]


Frames = Mapping[str, DataFrame]

# The checks of each table, from bronze (b), silver (s) and gold (g) frames and the day.
REPORTS: dict[str, Callable[[Frames, Frames, Frames, Column | None], list[Check]]] = {
    "bronze_courses": lambda b, s, g, day: bronze_courses(b["courses"]),
    "bronze_student_info": lambda b, s, g, day: bronze_student_info(b["student_info"], day),
    "bronze_student_registration": lambda b, s, g, day: bronze_student_registration(
        b["student_registration"], day
    ),
    "bronze_vle": lambda b, s, g, day: bronze_vle(b["vle"]),
    "silver_courses": lambda b, s, g, day: silver_courses(s["courses"]),
    "silver_student_info": lambda b, s, g, day: silver_student_info(
        s["student_info"], b["student_info"]
    ),
    "silver_student_registration": lambda b, s, g, day: silver_student_registration(
        s["student_registration"], b["student_registration"], s["student_info"], day
    ),
    "silver_vle": lambda b, s, g, day: silver_vle(s["vle"]),
    "gold_dim_course": lambda b, s, g, day: gold_dim_course(g["dim_course"], s["courses"]),
    "gold_dim_course_phase": lambda b, s, g, day: gold_dim_course_phase(g["dim_course_phase"]),
    "gold_dim_course_week": lambda b, s, g, day: gold_dim_course_week(
        g["dim_course_week"], g["dim_course_phase"], g["dim_course"]
    ),
    "gold_dim_vle": lambda b, s, g, day: gold_dim_vle(g["dim_vle"], s["vle"]),
    "gold_dim_student": lambda b, s, g, day: gold_dim_student(
        g["dim_student"], s["student_info"]
    ),
    "gold_dim_student_enrollment": lambda b, s, g, day: gold_dim_student_enrollment(
        g["dim_student_enrollment"], g["dim_student"], s["student_info"]
    ),
}


def _checked(
    name: str, bronze: Frames, silver: Frames, gold: Frames, as_of: Column | None
) -> tuple[DataFrame, list[Check], str, str]:
    layer, table = name.split("_", 1)
    checked = {"bronze": bronze, "silver": silver, "gold": gold}[layer][table]
    return checked, REPORTS[name](bronze, silver, gold, as_of), layer.upper(), table


def report(
    name: str, bronze: Frames, silver: Frames, gold: Frames, as_of: Column | None = None
) -> DataFrame:
    """The report of one table, named ``<layer>_<table>``."""
    return b.run_checks(*_checked(name, bronze, silver, gold, as_of))


def reports(
    bronze: Frames, silver: Frames, gold: Frames, as_of: Column | None = None
) -> dict[str, DataFrame]:
    """All single-statement reports, one lazy frame per checked table."""
    return {name: report(name, bronze, silver, gold, as_of) for name in REPORTS}


#: The reports with checks that list values.
LISTING = ("bronze_courses", "bronze_student_info", "bronze_vle", "gold_dim_student_enrollment")


def report_values(
    name: str, bronze: Frames, silver: Frames, gold: Frames, as_of: Column | None = None
) -> DataFrame:
    """The values that the checks of one report list, as rows."""
    return b.check_values(*_checked(name, bronze, silver, gold, as_of))


def listed_values(
    bronze: Frames, silver: Frames, gold: Frames, as_of: Column | None = None
) -> DataFrame:
    """The values that all reports list, as one table."""
    frames = [report_values(name, bronze, silver, gold, as_of) for name in LISTING]
    return reduce(DataFrame.unionByName, frames)
