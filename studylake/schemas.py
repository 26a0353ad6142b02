"""Layer schemas and value domains."""

from __future__ import annotations

from pyspark.sql import types as T

# Source columns of the seven raw tables, in file order.
RAW_COLUMNS = {
    "courses": ["code_module", "code_presentation", "module_presentation_length"],
    "assessments": [
        "code_module", "code_presentation", "id_assessment",
        "assessment_type", "date", "weight",
    ],
    "vle": [
        "id_site", "code_module", "code_presentation",
        "activity_type", "week_from", "week_to",
    ],
    "student_info": [
        "code_module", "code_presentation", "id_student", "gender", "region",
        "highest_education", "imd_band", "age_band", "num_of_prev_attempts",
        "studied_credits", "disability", "final_result",
    ],
    "student_registration": [
        "code_module", "code_presentation", "id_student",
        "date_registration", "date_unregistration",
    ],
    "student_assessment": [
        "id_assessment", "id_student", "date_submitted", "is_banked", "score",
    ],
    "student_vle": [
        "code_module", "code_presentation", "id_student", "id_site", "date", "sum_click",
    ],
}

# File of each raw table.
RAW_FILES = {
    "courses": "courses.csv",
    "assessments": "assessments.csv",
    "vle": "vle.csv",
    "student_info": "studentInfo.csv",
    "student_registration": "studentRegistration.csv",
    "student_assessment": "studentAssessment.csv",
    "student_vle": "studentVle.csv",
}

# Domains.
ASSESSMENT_TYPES = {"TMA": "TMA", "CMA": "CMA", "EXAM": "Exam"}
IMD_BANDS = [
    "0-10%", "10-20%", "20-30%", "30-40%", "40-50%",
    "50-60%", "60-70%", "70-80%", "80-90%", "90-100%",
]
FINAL_RESULTS = ["Pass", "Fail", "Distinction", "Withdrawn"]
RAW_GENDERS = ["M", "F", "m", "f"]
PHASES = [(1, "Early"), (2, "Middle"), (3, "Late")]
FIRST_WEEK, LAST_WEEK = -25, 75
PLACEHOLDER = "?"


def raw_schema(table: str) -> T.StructType:
    """Every raw column is text: placeholders and malformed values must survive."""
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[table]])


# Identifiers and click totals are BIGINT: the source declares INT, whose key
# space and sums run out long before the data does.
SILVER = {
    "courses": "code_module string, code_presentation string, "
    "module_presentation_length int, ingestion_timestamp timestamp, ingestion_date date",
    "assessments": "id_assessment bigint, code_module string, code_presentation string, "
    "assessment_type string, date int, date_source string, weight double, "
    "ingestion_timestamp timestamp, ingestion_date date",
    "vle": "id_site bigint, code_module string, code_presentation string, "
    "activity_type string, week_from int, week_to int, "
    "ingestion_timestamp timestamp, ingestion_date date",
    "student_info": "code_module string, code_presentation varchar(50), id_student bigint, "
    "gender char(1), region string, highest_education string, imd_band string, "
    "age_band string, num_of_prev_attempts int, studied_credits int, "
    "disability boolean, final_result string, "
    "ingestion_timestamp timestamp, ingestion_date date",
    "student_registration": "code_module string, code_presentation varchar(50), "
    "id_student bigint, date_registration int, date_unregistration int, "
    "ingestion_timestamp timestamp, ingestion_date date",
    "student_assessment": "id_assessment bigint, id_student bigint, date_submitted int, "
    "is_banked int, score double, score_source string, "
    "ingestion_timestamp timestamp, ingestion_date date",
    "student_vle": "code_module string, code_presentation string, id_student bigint, "
    "id_site bigint, date int, sum_click bigint, "
    "ingestion_timestamp timestamp, ingestion_date date",
}

SILVER_KEYS = {
    "courses": ["code_module", "code_presentation"],
    "assessments": ["id_assessment"],
    "vle": ["id_site"],
    "student_info": ["code_module", "code_presentation", "id_student"],
    "student_registration": ["code_module", "code_presentation", "id_student"],
    "student_assessment": ["id_assessment", "id_student"],
    "student_vle": ["code_module", "code_presentation", "id_student", "id_site", "date"],
}

GOLD = {
    "dim_course": "course_id string, code_module string, code_presentation string, "
    "module_presentation_length int",
    "dim_vle": "vle_id bigint, activity_type string, week_from int, week_to int",
    "dim_assessment": "assessment_key bigint, course_id string, assessment_type string, "
    "assessment_day_offset int, weight double",
    "dim_course_phase": "phase_id int, phase_name string",
    "dim_course_week": "course_id string, week_id int, week_number int, phase_id int",
    "dim_student": "student_id bigint, gender varchar(10), region varchar(100), "
    "highest_education varchar(100), imd_band varchar(50), age_band varchar(50), "
    "disability varchar(10), ingestion_timestamp timestamp",
    "dim_student_enrollment": "student_enrollment_id string, student_id bigint, "
    "course_id varchar(100), num_of_prev_attempts int, studied_credits int, "
    "final_result varchar(50), date_registration int, date_unregistration int, "
    "ingestion_timestamp timestamp",
}

GOLD_KEYS = {
    "dim_course_phase": ["phase_id"],
    "dim_course_week": ["course_id", "week_id"],
    "dim_student": ["student_id"],
    "dim_student_enrollment": ["student_enrollment_id"],
}

CHECK_RESULT = (
    "layer_name string, table_name string, check_category string, check_name string, "
    "check_level string, status string, total_records bigint, violation_count bigint, "
    "violation_rate double, warning_threshold double, fail_threshold double, "
    "description string, checked_at timestamp"
)

#: One run's results of one table.
CHECK_RESULT_KEYS = ["layer_name", "table_name", "checked_at"]

AUDIT = "LoadDate date, source_file string, row_count bigint, EntryTime timestamp"
