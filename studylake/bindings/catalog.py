"""The single-statement reports of all tables, one row per check and metric."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studylake.bindings import ctes as q
from studylake.bindings.learning import AS_OF, Learning
from studylake.bindings.registry import query
from studylake.quality import builders as b
from studylake.quality import catalog
from studylake.session import materialize

TODAY = f"DATE '{AS_OF}'"
BANDS = "('0-10%', '10-20%', '20-30%', '30-40%', '40-50%', '50-60%', '60-70%', '70-80%', '80-90%', '90-100%'"
CODE_STYLE = {
    "module": "code_module <> upper(trim(code_module))",
    "presentation": "code_presentation <> upper(trim(code_presentation))",
}
COMPLETE, VALID, RULE, AGREE = "COMPLETENESS", "VALIDITY", "BUSINESS_RULE", "CONSISTENCY"
UNIQUE, SUMMARY, PROFILE = "UNIQUENESS", "SUMMARY", "PROFILE"
INFO = "'INFO'"


def n(condition: str) -> str:
    return q.big(f"sum(CASE WHEN {condition} THEN 1 ELSE 0 END)")


def empty(*columns: str, **named: str) -> dict[str, str]:
    found = {f"null_{c}": n(f"{c} IS NULL") for c in columns}
    found.update({f"null_{k}": n(f"{c} IS NULL") for k, c in named.items()})
    return found


def missing(*columns: str) -> str:
    return n(" OR ".join(f"{c} IS NULL" for c in columns))


def zero(value: str, bad: str = "FAIL") -> str:
    return f"CASE WHEN {value} = 0 THEN 'PASS' ELSE '{bad}' END"


def span(value: str, what: str) -> dict[str, str]:
    return {f"min_{what}": f"min({value})", f"max_{what}": f"max({value})"}


LOADS = {"earliest_ingestion": "min(ingestion_date)", "latest_ingestion": "max(ingestion_date)"}
ROWS = {"total_records": "count(*)"}


def check(
    code: str, category: str, name: str, source: str, metrics: Mapping[str, str], status: str,
    **hidden: str,
) -> str:
    """One check as metric rows; ``hidden`` aggregates are for the status alone."""
    computed = ", ".join(f"{sql} AS {m}" for m, sql in {**metrics, **hidden}.items())
    names = ", ".join(f"'{m}'" for m in metrics)
    values = ", ".join(f"CAST({m} AS VARCHAR)" for m in metrics)
    return (
        f"SELECT '{code}' AS check_code, '{category}' AS check_category, '{name}' AS check_name, "
        f"{status} AS status, unnest([{names}]) AS metric, unnest([{values}]) AS value "
        f"FROM (SELECT {computed} FROM {source})"
    )


def count_check(source: str) -> str:
    return check("1.1", COMPLETE, "Record Count", source, {"actual_count": "count(*)"},
                 "CASE WHEN actual_count > 0 THEN 'PASS' ELSE 'FAIL' END")


def filled(code: str, name: str, source: str, metrics: dict[str, str], any_missing: str,
           bad: str = "FAIL") -> str:
    return check(code, COMPLETE, name, source, {**ROWS, **metrics}, zero("bad", bad),
                 bad=any_missing)


def repeated(code: str, name: str, source: str, keys: str, bad: str = "FAIL",
             metric: str = "duplicate_combinations", none: str = "0") -> str:
    return check(
        code, UNIQUE, name,
        f"(SELECT count(*) AS n FROM {source} GROUP BY {keys} HAVING count(*) > 1)",
        {metric: "count(*)", "total_duplicate_records": q.big(f"coalesce(sum(n), {none})")},
        zero(metric, bad))


def surplus(code: str, name: str, source: str, metric: str, key: str) -> str:
    return check(code, UNIQUE, name, source, {metric: f"count(*) - count(DISTINCT {key})"},
                 zero(metric))


def values(code: str, name: str, source: str, column: str) -> str:
    return check(code, PROFILE, name, f"(SELECT DISTINCT {column} FROM {source})",
                 {"distinct_values": "count(*)"}, INFO)


def fresh(source: str) -> str:
    return check(
        "1.5", "TIMELINESS", "Data Freshness", source,
        {"latest_ingestion_date": "max(ingestion_date)",
         "days_since_last_ingestion": f"date_diff('day', max(ingestion_date), {TODAY})"},
        "CASE WHEN days_since_last_ingestion <= 7 THEN 'PASS' "
        "WHEN days_since_last_ingestion <= 30 THEN 'WARNING' ELSE 'FAIL' END")


def shrunk(code: str, table: str) -> str:
    return check(
        code, AGREE, "Bronze to Silver Record Count",
        f"(SELECT (SELECT count(*) FROM b_{table}) AS bb, (SELECT count(*) FROM s_{table}) AS ss)",
        {"bronze_count": "any_value(bb)", "silver_count": "any_value(ss)",
         "records_filtered": "any_value(bb - ss)",
         "retention_rate_pct": q.pct("any_value(ss)", "any_value(bb)")},
        "CASE WHEN silver_count > bronze_count THEN 'FAIL' WHEN silver_count > 0 THEN 'PASS' "
        "ELSE 'WARNING' END")


def compared(code: str, name: str, left: tuple[str, str], right: tuple[str, str],
             extra: Mapping[str, str], status: str) -> str:
    return check(
        code, AGREE, name, f"(SELECT ({left[1]}) AS l, ({right[1]}) AS r)",
        {left[0]: "any_value(l)", right[0]: "any_value(r)", **extra}, status)


def kept_95(left: str, right: str) -> str:
    return (f"CASE WHEN {right} >= {left} * 0.95 THEN 'PASS' "
            f"WHEN {right} >= {left} * 0.90 THEN 'WARNING' ELSE 'FAIL' END")


def orphans(code: str, category: str, name: str, metric: str, child: str, parent: str, on: str,
            bad: str = "FAIL") -> str:
    return check(code, category, name, f"{child} ANTI JOIN {parent} USING ({on})",
                 {metric: "count(*)"}, zero(metric, bad))


def courses(source: str, numeric: str, bronze: bool) -> list[str]:
    length = {"invalid_presentation_length_records": n(f"{numeric} <= 0")}
    gaps = empty("code_module", "code_presentation", "module_presentation_length")
    any_gap = missing("code_module", "code_presentation", "module_presentation_length")
    bad = "WARNING" if bronze else "FAIL"
    names = ("Null Value Assessment", "Duplicate Business Keys") if bronze else (
        "Required Columns", "No Duplicate Business Keys")
    common = [
        count_check(source),
        filled("1.2", names[0], source, gaps, any_gap, bad),
        repeated("1.3", names[1], source, "code_module, code_presentation", bad),
        check("1.4", VALID, "Presentation Length Range", source,
              {**ROWS, **length, **span(numeric, "length")},
              zero("invalid_presentation_length_records")),
        check("3.1", SUMMARY, "Table Profile", source, {
            "row_count": "count(*)",
            "duplicate_records":
                "count(*) - count(DISTINCT code_module || '_' || code_presentation)",
            **gaps, **length, **LOADS}, INFO),
    ]
    if bronze:
        return common + [values("2.1", "Distinct Module Codes", source, "code_module"),
                         values("2.2", "Distinct Presentation Codes", source, "code_presentation")]
    return common + [check(
        "2.1", RULE, "Standardized Course Codes", source,
        {**ROWS, "invalid_module_codes": n(CODE_STYLE["module"]),
         "invalid_presentation_codes": n(CODE_STYLE["presentation"])},
        zero("invalid_module_codes + invalid_presentation_codes"))]


def _people(extra: Mapping[str, str]) -> dict[str, str]:
    return {"total_records": "count(*)", "unique_students": "count(DISTINCT id_student)",
            "unique_course_presentations":
                "count(DISTINCT code_module || '-' || code_presentation)", **extra, **LOADS}


KEY = "code_module, code_presentation, id_student"
CREDITS, ATTEMPTS = q.as_int("studied_credits"), q.as_int("num_of_prev_attempts")
START, END = q.as_int("date_registration"), q.as_int("date_unregistration")
FIRST, LAST = q.as_int("week_from"), q.as_int("week_to")


def bronze_student_info(s: str = "b_student_info") -> list[str]:
    gender, disability = "gender NOT IN ('M', 'F', 'm', 'f')", "disability NOT IN ('Y', 'N', 'y', 'n')"
    result = "upper(trim(final_result)) NOT IN ('PASS', 'FAIL', 'DISTINCTION', 'WITHDRAWN')"
    load = f"{CREDITS} = 0 OR {CREDITS} > 300"
    return [
        count_check(s),
        filled("1.2", "Required Columns", s,
               empty("code_module", "code_presentation", "id_student", "ingestion_timestamp",
                     "ingestion_date"),
               missing("code_module", "code_presentation", "id_student", "ingestion_timestamp",
                       "ingestion_date")),
        repeated("1.3", "Duplicate Primary Keys", s, KEY, "WARNING", none="NULL"),
        check("1.4", VALID, "Data Type Conformance", s, {
            **ROWS, "invalid_gender": n(gender), "invalid_disability": n(disability),
            "negative_prev_attempts": n(f"{ATTEMPTS} < 0"),
            "negative_credits": n(f"{CREDITS} < 0")},
            zero("bad"), bad=n(f"{gender} OR {disability} OR {ATTEMPTS} < 0 OR {CREDITS} < 0")),
        fresh(s),
        check("2.1", RULE, "IMD Band Domain Values", s, {
            "invalid_imd_band": n(f"imd_band NOT IN {BANDS}, '?')"),
            "distinct_values": "count(DISTINCT imd_band)"},
            zero("invalid_imd_band")),
        check("2.2", RULE, "Final Result Domain", s, {
            **ROWS, "invalid_results": n(result), "distinct_values": "count(DISTINCT final_result)"},
            zero("invalid_results")),
        check("2.3", RULE, "Reasonable Credit Load", s, {
            **ROWS, "zero_credits": n(f"{CREDITS} = 0"), "excessive_credits": n(f"{CREDITS} > 300"),
            **span(CREDITS, "credits"), "avg_credits": q.rnd(f"avg({CREDITS})", 2)},
            "CASE WHEN bad = 0 THEN 'PASS' WHEN bad < total_records * 0.01 THEN 'WARNING' "
            "ELSE 'FAIL' END", bad=n(load)),
        check("3.1", SUMMARY, "Table Profile", s, _people({}), INFO),
    ]


def bronze_student_registration(s: str = "b_student_registration") -> list[str]:
    left = f"(SELECT * FROM {s} WHERE date_unregistration IS NOT NULL)"
    days = f"({END}) - ({START})"
    return [
        count_check(s),
        filled("1.2", "Required Columns", s,
               empty("code_module", "code_presentation", "id_student", "date_registration",
                     "ingestion_timestamp"),
               missing("code_module", "code_presentation", "id_student", "date_registration",
                       "ingestion_timestamp")),
        check("1.3", COMPLETE, "Unregistration Date Distribution", s, {
            **ROWS, "null_unregistration": n("date_unregistration IS NULL"),
            "has_unregistration": n("date_unregistration IS NOT NULL"),
            "unregistration_rate_pct": q.pct("count(date_unregistration)", "count(*)")}, INFO),
        repeated("1.4", "Duplicate Primary Keys", s, KEY, "WARNING"),
        fresh(s),
        check("2.1", RULE, "Valid Registration Date", s, {
            **ROWS,
            "future_registration_dates": n(f"DATE '1970-01-01' + CAST({START} AS INT) > {TODAY}"),
            "earliest_registration": f"min({START})", "latest_registration": f"max({START})"},
            zero("future_registration_dates")),
        check("2.2", RULE, "Unregistration After Registration", left, {
            "total_records_with_unreg": "count(*)", "invalid_date_sequence": n(f"({START}) > ({END})")},
            zero("invalid_date_sequence")),
        check("2.3", RULE, "Registration Duration", left, {
            "total_with_duration": "count(*)", "avg_days_registered": q.rnd(f"avg({days})", 2),
            "min_days_registered": f"min({days})", "max_days_registered": f"max({days})",
            "same_day_unregistrations": n(f"{days} = 0")}, INFO),
        check("3.1", SUMMARY, "Table Profile", s, _people({}), INFO),
    ]


def bronze_vle(s: str = "b_vle") -> list[str]:
    malformed = n(f"({FIRST}) IS NULL OR ({LAST}) IS NULL")
    inverted, negative = n(f"({FIRST}) > ({LAST})"), n(f"({FIRST}) < 0 OR ({LAST}) < 0")
    all_columns = ("id_site", "code_module", "code_presentation", "activity_type", "week_from",
                   "week_to")
    return [
        count_check(s),
        filled("1.2", "Null Value Assessment", s, empty(*all_columns), missing(*all_columns),
               "WARNING"),
        repeated("1.3", "Duplicate Site IDs", s, "id_site", "WARNING", "duplicate_ids"),
        check("1.4", VALID, "Week Value Format", s, {**ROWS, "malformed_week_records": malformed},
              zero("malformed_week_records")),
        check("1.5", VALID, "Week Range Logic", s, {**ROWS, "invalid_week_range_records": inverted},
              zero("invalid_week_range_records")),
        check("1.6", VALID, "Non-Negative Week Values", s,
              {**ROWS, "negative_week_records": negative}, zero("negative_week_records")),
        values("2.1", "Distinct Module Codes", s, "code_module"),
        values("2.2", "Distinct Presentation Codes", s, "code_presentation"),
        values("2.3", "Distinct Activity Types", s, "activity_type"),
        values("2.4", "Ingestion Dates", s, "ingestion_date"),
        check("3.1", SUMMARY, "Table Profile", s, {
            "row_count": "count(*)", "duplicate_records": "count(*) - count(DISTINCT id_site)",
            **empty(*all_columns[:4]), "malformed_week_records": malformed,
            "invalid_week_range_records": inverted, "negative_week_records": negative, **LOADS},
            INFO),
    ]


def silver_student_info(s: str = "s_student_info") -> list[str]:
    style = {f"unstandardized_{k}": n(c) for k, c in CODE_STYLE.items()}
    gender = "gender NOT IN ('M', 'F')"
    business = ("gender", "region", "imd_band", "age_band", "disability", "final_result")
    bands, result = f"imd_band NOT IN {BANDS})", (
        "final_result NOT IN ('Pass', 'Fail', 'Distinction', 'Withdrawn')")
    return [
        count_check(s),
        filled("1.2", "Primary Key Completeness", s,
               empty("code_module", "code_presentation", "id_student"),
               missing("code_module", "code_presentation", "id_student")),
        repeated("1.3", "No Duplicate Primary Keys", s, KEY),
        check("1.4", VALID, "Data Standardization", s, {
            **ROWS, **style, "invalid_gender": n(gender),
            "invalid_disability": n("disability NOT IN (TRUE, FALSE)")},
            zero("unstandardized_module + unstandardized_presentation + invalid_gender "
                 "+ invalid_disability")),
        filled("1.5", "Required Business Columns", s,
               empty(*business, education="highest_education"),
               missing(*business, "highest_education")),
        check("2.1", RULE, "IMD Band Valid Values Only", s,
              {**ROWS, "records_with_unknown_imd": n("imd_band = '?'")},
              zero("records_with_unknown_imd")),
        check("2.2", RULE, "Valid Credit Range", s, {
            **ROWS, "zero_or_negative_credits": n("studied_credits <= 0"),
            "excessive_credits": n("studied_credits > 300"), **span("studied_credits", "credits")},
            zero("zero_or_negative_credits + excessive_credits")),
        check("2.3", RULE, "Previous Attempts Non-Negative", s, {
            **ROWS, "negative_attempts": n("num_of_prev_attempts < 0"),
            **span("num_of_prev_attempts", "attempts")}, zero("negative_attempts")),
        shrunk("3.1", "student_info"),
        check("3.2", AGREE, "Categorical Domain Values", s, {
            "invalid_gender": n(gender), "invalid_imd": n(bands), "invalid_result": n(result)},
            zero("invalid_gender + invalid_imd + invalid_result")),
        check("4.1", SUMMARY, "Table Profile", s, _people({
            "unique_genders": "count(DISTINCT gender)",
            "unique_education_levels": "count(DISTINCT highest_education)"}), INFO),
    ]


def silver_student_registration(s: str = "s_student_registration") -> list[str]:
    style = {f"unstandardized_{k}": n(c) for k, c in CODE_STYLE.items()}
    day = "DATE '1970-01-01' + date_registration"
    left = f"(SELECT * FROM {s} WHERE date_unregistration IS NOT NULL)"
    return [
        count_check(s),
        filled("1.2", "Primary Key Completeness", s,
               empty("code_module", "code_presentation", "id_student"),
               missing("code_module", "code_presentation", "id_student")),
        filled("1.3", "Registration Date Required", s,
               {"null_registration_dates": n("date_registration IS NULL")},
               n("date_registration IS NULL")),
        repeated("1.4", "No Duplicate Primary Keys", s, KEY),
        check("1.5", VALID, "Data Standardization", s, {**ROWS, **style},
              zero("unstandardized_module + unstandardized_presentation")),
        check("2.1", RULE, "Valid Registration Date", s, {
            **ROWS, "future_registration_dates": n(f"{day} > {TODAY}"),
            "earliest_registration": f"CAST(min({day}) AS DATE)",
            "latest_registration": f"CAST(max({day}) AS DATE)"}, zero("future_registration_dates")),
        check("2.2", RULE, "Unregistration After Registration", left, {
            "total_records_with_unreg": "count(*)",
            "invalid_date_sequence": n("date_registration > date_unregistration")},
            zero("invalid_date_sequence")),
        check("2.3", RULE, "Withdrawal Rate", s, {
            "total_registrations": "count(*)",
            "total_withdrawals": n("date_unregistration IS NOT NULL"),
            "withdrawal_rate_pct": q.pct("count(date_unregistration)", "count(*)")},
            "CASE WHEN withdrawal_rate_pct BETWEEN 0 AND 100 THEN 'PASS' ELSE 'FAIL' END"),
        shrunk("3.1", "student_registration"),
        orphans("3.2", AGREE, "Referential Integrity to Student Info", "orphaned_registrations",
                s, "s_student_info", KEY, "WARNING"),
        check("4.1", SUMMARY, "Table Profile", s, _people({
            "students_who_withdrew": n("date_unregistration IS NOT NULL")}), INFO),
    ]


def silver_vle(s: str = "s_vle") -> list[str]:
    columns = ("id_site", "code_module", "code_presentation", "activity_type", "week_from",
               "week_to")
    inverted = {"invalid_week_range_records": n("week_from > week_to")}
    return [
        count_check(s),
        filled("1.2", "Required Business Columns", s, empty(*columns), missing(*columns)),
        repeated("1.3", "No Duplicate Business Keys", s, "id_site", metric="duplicate_ids"),
        check("1.4", VALID, "Week Range Logic", s, {**ROWS, **inverted},
              zero("invalid_week_range_records")),
        check("2.1", RULE, "Standardized Activity Types", s, {
            **ROWS, "unstandardized_activity_types": n("activity_type <> trim(activity_type)")},
            zero("unstandardized_activity_types")),
        check("2.2", RULE, "Activity Type Coverage", s,
              {"distinct_activity_types": "count(DISTINCT activity_type)"}, INFO),
        check("3.1", SUMMARY, "Table Profile", s, {
            "row_count": "count(*)", "duplicate_records": "count(*) - count(DISTINCT id_site)",
            **empty(*columns), **inverted, **LOADS}, INFO),
    ]


def _dimension(source: str, key: str, short: str, columns: tuple[str, ...],
               unique_name: str = "Duplicate Dimension Keys",
               more: Mapping[str, str] | None = None) -> list[str]:
    gaps = empty(*columns)
    return [
        count_check(source),
        filled("1.2", "Null Value Assessment", source, gaps, missing(*columns)),
        surplus("1.3", unique_name, source, f"duplicate_{short}", key),
        check("3.1", SUMMARY, "Table Profile", source, {
            "total_rows": "count(*)", f"distinct_{short}": f"count(DISTINCT {key})",
            f"duplicate_{short}": f"count(*) - count(DISTINCT {key})", **gaps, **(more or {})},
            INFO),
    ]


SAME = "CASE WHEN source_count = target_count THEN 'PASS' ELSE 'FAIL' END"


def gold_dim_course() -> list[str]:
    return _dimension("g_course", "course_id", "course_id", (
        "course_id", "code_module", "code_presentation", "module_presentation_length")) + [
        compared("2.1", "Source to Target Record Count",
                 ("source_count", "SELECT count(DISTINCT code_module || '_' || code_presentation) "
                                  "FROM s_courses"),
                 ("target_count", "SELECT count(*) FROM g_course"), {}, SAME)]


def gold_dim_course_week() -> list[str]:
    low = {"invalid_week_number": n("week_number <= 0")}
    return _dimension(
        "g_week", "course_id || '_' || CAST(week_id AS VARCHAR)", "course_week",
        ("course_id", "week_id", "week_number", "phase_id"), "Duplicate Course Week Keys", low) + [
        check("1.4", VALID, "Week Number Range", "g_week",
              {**ROWS, **low, **span("week_number", "week_number")}, zero("invalid_week_number")),
        orphans("2.1", AGREE, "Phase Referential Integrity", "orphan_phase_records", "g_week",
                "g_phase", "phase_id"),
        orphans("2.2", AGREE, "Course Referential Integrity", "orphan_course_records", "g_week",
                "g_course", "course_id"),
    ]


def gold_dim_vle() -> list[str]:
    inverted = {"invalid_week_range": n("week_from > week_to")}
    return _dimension("g_vle", "vle_id", "vle_id", ("vle_id", "activity_type"), more=inverted) + [
        check("1.4", VALID, "Week Range Logic", "g_vle", {**ROWS, **inverted},
              zero("invalid_week_range")),
        compared("2.1", "Source to Target Record Count",
                 ("source_count", "SELECT count(DISTINCT id_site) FROM s_vle"),
                 ("target_count", "SELECT count(*) FROM g_vle"), {}, SAME)]


def gold_dim_student(s: str = "g_student") -> list[str]:
    columns = ("student_id", "gender", "region", "imd_band", "age_band", "disability")
    gender, band = "gender NOT IN ('M', 'F')", f"imd_band NOT IN {BANDS})"
    return [
        count_check(s),
        repeated("1.2", "No Duplicate student_id", s, "student_id", metric="duplicate_student_ids"),
        filled("1.3", "Required Dimension Attributes", s,
               empty(*columns, education="highest_education"),
               missing(*columns, "highest_education")),
        check("1.4", VALID, "Standardized Dimension Values", s, {
            **ROWS, "invalid_gender": n(gender),
            "invalid_disability": n("disability NOT IN ('true', 'false')")},
            zero("invalid_gender + invalid_disability")),
        check("2.1", RULE, "Categorical Domain Values", s, {
            **ROWS, "invalid_imd_band": n(band), "distinct_genders": "count(DISTINCT gender)",
            "distinct_education_levels": "count(DISTINCT highest_education)",
            "distinct_age_bands": "count(DISTINCT age_band)",
            "distinct_imd_bands": "count(DISTINCT imd_band)",
            "distinct_regions": "count(DISTINCT region)"}, zero("invalid_imd_band")),
        check("2.2", RULE, "Dimension Cardinality", s, {
            "unique_students": "count(DISTINCT student_id)", "total_records": "count(*)"},
            "CASE WHEN unique_students = total_records THEN 'PASS' ELSE 'FAIL' END"),
        compared("3.1", "Student Count - Silver vs Gold",
                 ("silver_students", "SELECT count(DISTINCT id_student) FROM s_student_info"),
                 ("gold_students", "SELECT count(DISTINCT student_id) FROM g_student"),
                 {"missing_in_gold": "any_value(l - r)"},
                 kept_95("silver_students", "gold_students")),
        check("3.2", AGREE, "Demographic Distribution", s, {
            "total_students": "count(*)",
            "female_pct": q.pct("count(*) FILTER (WHERE gender = 'F')", "count(*)"),
            "male_pct": q.pct("count(*) FILTER (WHERE gender = 'M')", "count(*)"),
            "disability_pct": q.pct("count(*) FILTER (WHERE disability = 'true')", "count(*)")},
            "CASE WHEN total_students > 0 THEN 'PASS' ELSE 'FAIL' END"),
        check("4.1", SUMMARY, "Dimension Profile", s, {
            "total_students": "count(*)", "unique_student_ids": "count(DISTINCT student_id)",
            "unique_regions": "count(DISTINCT region)",
            "unique_education_levels": "count(DISTINCT highest_education)",
            "unique_age_bands": "count(DISTINCT age_band)",
            "unique_imd_bands": "count(DISTINCT imd_band)"}, INFO),
        check("4.2", SUMMARY, "Attribute Completeness %", s, {
            f"{name}_completeness": q.pct(f"count({column})", "count(*)")
            for name, column in [(c, c) for c in columns] + [("education", "highest_education")]},
            INFO),
    ]


def gold_dim_student_enrollment(s: str = "g_enrollment") -> list[str]:
    named = {
        "enrollment_id": "student_enrollment_id", "student_id": "student_id",
        "course_id": "course_id", "prev_attempts": "num_of_prev_attempts",
        "credits": "studied_credits", "final_result": "final_result",
    }
    result = "upper(trim(final_result))"
    low, none, high = "num_of_prev_attempts < 0", "studied_credits <= 0", "studied_credits > 300"
    strange = n(f"{result} NOT IN ('PASS', 'FAIL', 'DISTINCTION', 'WITHDRAWN')")
    per_student = f"(SELECT student_id, count(*) AS c FROM {s} GROUP BY 1)"
    return [
        count_check(s),
        repeated("1.2", "No Duplicate student_enrollment_id", s, "student_enrollment_id",
                 metric="duplicate_enrollment_ids"),
        filled("1.3", "Required Enrollment Attributes", s, empty(**named),
               missing(*named.values())),
        check("1.4", VALID, "Value Range Validation", s, {
            **ROWS, "negative_attempts": n(low), "zero_or_negative_credits": n(none),
            "excessive_credits": n(high), **span("num_of_prev_attempts", "attempts"),
            **span("studied_credits", "credits")},
            zero("negative_attempts + zero_or_negative_credits + excessive_credits")),
        check("2.1", RULE, "Final Result Domain", s, {
            **ROWS, "invalid_results": strange, "distinct_results": "count(DISTINCT final_result)"},
            zero("invalid_results")),
        check("2.2", RULE, "Enrollment Outcome Distribution", s, {
            "total_enrollments": "count(*)", "pass_count": n(f"{result} = 'PASS'"),
            "fail_count": n(f"{result} = 'FAIL'"),
            "distinction_count": n(f"{result} = 'DISTINCTION'"),
            "withdrawn_count": n(f"{result} = 'WITHDRAWN'"),
            "withdrawal_rate_pct": q.pct(
                f"count(*) FILTER (WHERE {result} = 'WITHDRAWN')", "count(*)")}, INFO),
        check("2.3", RULE, "Previous Attempts Distribution", s, {
            "total_enrollments": "count(*)", "first_attempt": n("num_of_prev_attempts = 0"),
            "second_attempt": n("num_of_prev_attempts = 1"),
            "three_or_more_attempts": n("num_of_prev_attempts >= 2"),
            "avg_prev_attempts": q.rnd("avg(num_of_prev_attempts)", 2),
            "max_prev_attempts": "max(num_of_prev_attempts)"}, INFO),
        check("2.4", RULE, "Credit Load Distribution", s, {
            "total_enrollments": "count(*)", "light_load": n("studied_credits < 60"),
            "medium_load": n("studied_credits BETWEEN 60 AND 120"),
            "heavy_load": n("studied_credits > 120"),
            "avg_credits": q.rnd("avg(studied_credits)", 2)}, INFO),
        orphans("3.1", "REFERENTIAL_INTEGRITY", "Valid Student Foreign Keys",
                "orphaned_enrollments", s, "g_student", "student_id"),
        compared("3.2", "Enrollment Count - Silver vs Gold",
                 ("silver_enrollments", "SELECT count(*) FROM s_student_info"),
                 ("gold_enrollments", "SELECT count(*) FROM g_enrollment"),
                 {"missing_in_gold": "any_value(l - r)",
                  "retention_rate_pct": q.pct("any_value(r)", "any_value(l)")},
                 kept_95("silver_enrollments", "gold_enrollments")),
        check("3.3", AGREE, "Enrollments per Student", per_student, {
            "unique_students": "count(student_id)",
            "avg_enrollments_per_student": q.rnd("avg(c)", 2),
            "min_enrollments": "min(c)", "max_enrollments": "max(c)",
            "students_with_one_enrollment": n("c = 1"),
            "students_with_multiple_enrollments": n("c > 1")}, INFO),
        check("4.1", SUMMARY, "Dimension Profile", s, {
            "total_enrollments": "count(*)",
            "unique_enrollment_ids": "count(DISTINCT student_enrollment_id)",
            "unique_students": "count(DISTINCT student_id)",
            "unique_courses": "count(DISTINCT course_id)"}, INFO),
        check("4.2", SUMMARY, "Attribute Completeness %", s, {
            f"{name}_completeness": q.pct(f"count({c})", "count(*)") for name, c in named.items()},
            INFO),
    ]


# The phase dimension is three fixed rows; it is checked in the unit tests alone.
REPORTS = {
    "bronze_courses": courses("b_courses", q.as_int("module_presentation_length"), True),
    "bronze_student_info": bronze_student_info(),
    "bronze_student_registration": bronze_student_registration(),
    "bronze_vle": bronze_vle(),
    "silver_courses": courses("s_courses", "module_presentation_length", False),
    "silver_student_info": silver_student_info(),
    "silver_student_registration": silver_student_registration(),
    "silver_vle": silver_vle(),
    "gold_dim_course": gold_dim_course(),
    "gold_dim_course_week": gold_dim_course_week(),
    "gold_dim_vle": gold_dim_vle(),
    "gold_dim_student": gold_dim_student(),
    "gold_dim_student_enrollment": gold_dim_student_enrollment(),
}


def _metric_rows(report: DataFrame) -> DataFrame:
    return report.select(
        "check_code", "check_category", "check_name", "status",
        F.explode("metrics").alias("metric", "value"),
    )


def _register() -> None:
    for name, parts in REPORTS.items():
        def build(t: Learning, name: str = name) -> DataFrame:
            """The checks look at tables at rest: what they scan repeatedly is stored first."""
            layer, table = name.split("_", 1)
            if layer != "bronze":
                frames = getattr(t, layer)
                frames[table] = materialize(frames[table])
            day = F.lit(AS_OF).cast("date")
            return _metric_rows(catalog.report(name, t.bronze, t.silver, t.gold, day))

        query(f"checks_{name}", q.with_(" UNION ALL ".join(parts)))(build)


_register()


def _values_sql(layer: str, table: str, source: str, *lists: tuple[str, str, str]) -> str:
    """The listed values of a report; each list is (check code, check name, column)."""
    return q.with_(" UNION ALL ".join(
        f"SELECT DISTINCT '{layer}' AS layer_name, '{table}' AS table_name, '{code}' AS check_code, "
        f"'{name}' AS check_name, '{column}' AS column_name, CAST({column} AS VARCHAR) AS value "
        f"FROM {source}" for code, name, column in lists))


def _listed(name: str):
    def build(t: Learning) -> DataFrame:
        day = F.lit(AS_OF).cast("date")
        return catalog.report_values(name, t.bronze, t.silver, t.gold, day)
    return build


query("check_values_bronze_courses", _values_sql(
    "BRONZE", "courses", "b_courses", ("2.1", "Distinct Module Codes", "code_module"),
    ("2.2", "Distinct Presentation Codes", "code_presentation")))(_listed("bronze_courses"))
query("check_values_bronze_vle", _values_sql(
    "BRONZE", "vle", "b_vle", ("2.1", "Distinct Module Codes", "code_module"),
    ("2.2", "Distinct Presentation Codes", "code_presentation"),
    ("2.3", "Distinct Activity Types", "activity_type"),
    ("2.4", "Ingestion Dates", "ingestion_date")))(_listed("bronze_vle"))
query("check_values_student_info", _values_sql(
    "BRONZE", "student_info", "b_student_info", ("2.1", "IMD Band Domain Values", "imd_band"),
    ("2.2", "Final Result Domain", "final_result")))(_listed("bronze_student_info"))
query("check_values_enrollment", _values_sql(
    "GOLD", "dim_student_enrollment", "g_enrollment", ("2.1", "Final Result Domain", "final_result"),
    ))(_listed("gold_dim_student_enrollment"))


@query("distinct_list_check", q.with_(values("1", "Brands", "part", "p_brand")))
def distinct_list_check(t: Learning) -> DataFrame:
    parts = t.table("part")
    return _metric_rows(b.run_checks(parts, [b.distinct_list("1", "Brands", "p_brand")],
                                     "BRONZE", "part"))
