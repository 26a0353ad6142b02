"""What each line of the structured reports must say, apart from the code that says it.

Fixed values: the checks of the four reports in report order, as (category, name,
level, warning rate, failure rate, severity, metric, description).
"""

from __future__ import annotations

Line = tuple[str, str, str, float | None, float | None, str | None, str, str]


BRONZE_ASSESSMENTS: list[Line] = [
    ("COMPLETENESS", "Record Count", "TABLE", None, 0, None,
     "total_records", "The table holds at least one row."),
    ("COMPLETENESS", "Missing id_assessment", "ROW", None, 0, None,
     "missing_ids", "Every row carries an assessment id."),
    ("VALIDITY", "Invalid id_assessment Format", "ROW", None, 0, None,
     "invalid_ids", "A given id is a whole number."),
    ("COMPLETENESS", "Missing code_module", "ROW", None, 0, None,
     "missing_modules", "Every row names its module."),
    ("COMPLETENESS", "Missing code_presentation", "ROW", None, 0, None,
     "missing_presentations", "Every row names its presentation."),
    ("COMPLETENESS", "Missing Ingestion Metadata", "ROW", None, 0, None,
     "missing_metadata", "Load timestamp and date are stamped on every row."),
    ("UNIQUENESS", "Duplicate Assessment IDs", "ROW", 0, None, None,
     "duplicate_excess_rows", "Rows beyond the first of each parsed id."),
    ("COMPLETENESS", "Missing Assessment Type", "ROW", None, 0, None,
     "missing_types", "Every row has a type; it cannot be inferred."),
    ("VALIDITY", "Assessment Type Domain", "ROW", 0, None, None,
     "invalid_types", "A given type is one of the known three."),
    ("VALIDITY", "Invalid Assessment Date Format", "ROW", 0, None, None,
     "invalid_dates", "A given date is a whole day offset."),
    ("COMPLETENESS", "Missing Assessment Date", "ROW", 0.1, None, None,
     "missing_dates", "Exams have no published date; a tenth of the rows may lack one."),
    ("COMPLETENESS", "Missing Assessment Weight", "ROW", None, 0, None,
     "missing_weights", "Every row has a weight."),
    ("VALIDITY", "Invalid Assessment Weight Format", "ROW", None, 0, None,
     "invalid_weights", "A given weight is a number."),
    ("BUSINESS_RULE", "Assessment Weight Range", "ROW", None, 0, None,
     "out_of_range_weights", "A weight is finite and between 0 and 100."),
    ("BUSINESS_RULE", "Coursework Weight Total", "ROW", 0.2, None, None,
     "weight_total_violations", "Coursework of a presentation adds up to 100; rows of presentations where it does not."),
    ("COMPLETENESS", "Course Reference Available", "TABLE", None, 0, None,
     "parent_keys", "There is a course to compare with."),
    ("REFERENTIAL_INTEGRITY", "Unknown Module Presentation", "ROW", 0, None, None,
     "unknown_courses", "A complete course key exists among the courses."),
]

BRONZE_SUBMISSIONS: list[Line] = [
    ("COMPLETENESS", "Record Count", "TABLE", None, None, "FAIL",
     "total_records", "The table holds at least one row."),
    ("COMPLETENESS", "Missing id_assessment", "ROW", None, None, "FAIL",
     "assessment_id_missing", "Every row carries an assessment id."),
    ("VALIDITY", "Invalid id_assessment Format", "ROW", None, None, "FAIL",
     "assessment_id_invalid", "A given assessment id is a whole number."),
    ("COMPLETENESS", "Missing id_student", "ROW", None, None, "FAIL",
     "student_id_missing", "Every row carries a student id."),
    ("VALIDITY", "Invalid id_student Format", "ROW", None, None, "FAIL",
     "student_id_invalid", "A given student id is a whole number."),
    ("COMPLETENESS", "Missing Ingestion Metadata", "ROW", None, None, "FAIL",
     "metadata_missing", "Load timestamp and date are stamped on every row."),
    ("UNIQUENESS", "Duplicate Student-Assessment Keys", "ROW", None, None, "WARNING",
     "excess_duplicate_rows", "Rows beyond the first of each parsed pair."),
    ("COMPLETENESS", "Missing date_submitted", "ROW", None, None, "WARNING",
     "date_missing", "A submission day is given; none is invented."),
    ("VALIDITY", "Invalid date_submitted Format", "ROW", None, None, "WARNING",
     "date_invalid", "A given submission day is a whole day offset, negative ones included."),
    ("COMPLETENESS", "Missing is_banked", "ROW", None, None, "FAIL",
     "banked_missing", "The banked flag is given."),
    ("VALIDITY", "Invalid is_banked Value", "ROW", None, None, "FAIL",
     "banked_invalid", "A given banked flag is 0 or 1."),
    ("COMPLETENESS", "Missing Score", "ROW", None, None, "WARNING",
     "score_missing", "A blank score is a non-submission: counted, kept, never zero."),
    ("VALIDITY", "Invalid Score Format", "ROW", None, None, "FAIL",
     "score_invalid", "A given score is a number."),
    ("BUSINESS_RULE", "Score Out of Range", "ROW", None, None, "FAIL",
     "score_out_of_range", "A score is finite and between 0 and 100."),
    ("REFERENTIAL_INTEGRITY", "Assessment Reference Available", "TABLE", None, None, "FAIL",
     "assessment_parent_count", "There is an assessment to compare with."),
    ("REFERENTIAL_INTEGRITY", "Student Enrollment Reference Available", "TABLE", None, None, "FAIL",
     "student_parent_count", "There is an enrollment to compare with."),
    ("REFERENTIAL_INTEGRITY", "Orphan Assessment Reference", "ROW", None, None, "FAIL",
     "assessment_orphans", "A parsed assessment id exists among the assessments."),
    ("REFERENTIAL_INTEGRITY", "Unusable Assessment Module Mapping", "ROW", None, None, "FAIL",
     "mapping_unusable", "A known assessment belongs to exactly one complete course key."),
    ("REFERENTIAL_INTEGRITY", "Student Not In Any Enrollment", "ROW", None, None, "FAIL",
     "student_not_in_any_enrollment", "A parsed student is enrolled somewhere."),
    ("REFERENTIAL_INTEGRITY", "Orphan Student Enrollment Reference", "ROW", None, None, "FAIL",
     "enrollment_orphans", "The student is enrolled on the presentation of the assessment."),
]

SILVER_ASSESSMENTS: list[Line] = [
    ("COMPLETENESS", "Record Count", "TABLE", None, None, "FAIL",
     "total_records", "The table holds at least one row."),
    ("COMPLETENESS", "Row Accounting Balances", "TABLE", None, None, "FAIL",
     "bronze_records", "Bronze rows equal silver rows plus refused rows."),
    ("TRANSFORM", "Required Column NULL", "ROW", None, None, "FAIL",
     "required_column_null", "Required columns are filled after cleaning."),
    ("TRANSFORM", "Non-Positive id_assessment", "ROW", None, None, "FAIL",
     "id_not_positive", "The id is positive."),
    ("UNIQUENESS", "Duplicate id_assessment", "ROW", None, None, "FAIL",
     "duplicate_id", "One row per assessment."),
    ("VALIDITY", "Invalid Assessment Type", "ROW", None, None, "FAIL",
     "invalid_type", "The type is one of the three clean values."),
    ("VALIDITY", "Weight Out of Range", "ROW", None, None, "FAIL",
     "weight_out_of_range", "The weight is finite and between 0 and 100."),
    ("VALIDITY", "Assessment Date Out of Range", "ROW", None, None, "FAIL",
     "date_out_of_range", "A date lies between day 0 and day 1000."),
    ("REFERENTIAL_INTEGRITY", "Orphan Module Presentation", "ROW", None, None, "FAIL",
     "orphan_course", "The course exists; cleaning does not test it."),
    ("BUSINESS_RULE", "Coursework Weight Total", "ROW", None, None, "WARNING",
     "coursework_weight_total", "Coursework of a presentation adds up to 100; rows where it does not."),
    ("BUSINESS_RULE", "Exam Weight Not 100", "ROW", None, None, "WARNING",
     "exam_weight_not_100", "An exam weighs 100."),
    ("COMPLETENESS", "Missing Assessment Date", "ROW", None, None, "WARNING",
     "date_missing", "Exams have no published date; counted, never imputed."),
    ("CONSISTENCY", "Date Source Not Captured", "ROW", None, None, "FAIL",
     "date_source_not_captured", "Where the date is unknown, the received text is kept."),
]

SILVER_SUBMISSIONS: list[Line] = [
    ("COMPLETENESS", "Record Count", "TABLE", None, None, "FAIL",
     "total_records", "The table holds at least one row."),
    ("COMPLETENESS", "Row Accounting Balances", "TABLE", None, None, "FAIL",
     "bronze_records", "Bronze rows equal silver rows plus refused rows."),
    ("TRANSFORM", "Required Column NULL", "ROW", None, None, "FAIL",
     "required_column_null", "Required columns are filled after cleaning; a score is not required."),
    ("TRANSFORM", "Non-Positive Keys", "ROW", None, None, "FAIL",
     "key_not_positive", "Both ids are positive."),
    ("UNIQUENESS", "Duplicate Student-Assessment Key", "ROW", None, None, "FAIL",
     "duplicate_key", "One row per student and assessment."),
    ("VALIDITY", "Invalid is_banked Value", "ROW", None, None, "FAIL",
     "is_banked_invalid", "The banked flag is 0 or 1."),
    ("VALIDITY", "Score Out of Range", "ROW", None, None, "FAIL",
     "score_out_of_range", "A score is finite and between 0 and 100."),
    ("VALIDITY", "Date Submitted Out of Range", "ROW", None, None, "FAIL",
     "date_out_of_range", "The submission day lies between -365 and 1825."),
    ("REFERENTIAL_INTEGRITY", "Orphan Assessment Reference", "ROW", None, None, "FAIL",
     "orphan_assessment", "The assessment reached silver; cleaning does not test it."),
    ("REFERENTIAL_INTEGRITY", "Student Not In Any Enrollment", "ROW", None, None, "FAIL",
     "student_not_in_any_enrollment", "The student is enrolled somewhere."),
    ("REFERENTIAL_INTEGRITY", "Orphan Student Enrollment Reference", "ROW", None, None, "FAIL",
     "orphan_enrollment", "A known student is enrolled on the presentation of a known assessment."),
    ("BUSINESS_RULE", "Banked Without Prior Attempt", "ROW", None, None, "WARNING",
     "banked_without_prior_attempt", "A banked score needs an earlier attempt."),
    ("BUSINESS_RULE", "Submitted Before Registration", "ROW", None, None, "WARNING",
     "submitted_before_registration", "The submission follows the registration; banked scores may precede it."),
    ("COMPLETENESS", "Missing Score", "ROW", None, None, "WARNING",
     "score_missing", "A NULL score is a non-submission: counted, kept, never zero."),
    ("CONSISTENCY", "Score Source Not Captured", "ROW", None, None, "FAIL",
     "score_source_not_captured", "Where the score is unknown, the received text is kept."),
]
