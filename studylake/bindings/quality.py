"""Quality queries: refusals, structured reports, builders, audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studylake import schemas
from studylake.bindings import ctes as q
from studylake.bindings import report_rows
from studylake.bindings.learning import AS_OF, Learning
from studylake.bindings.registry import query
from studylake.functions import columns as fx
from studylake.operators import joins
from studylake.plans import gold
from studylake.plans import silver as cleaning
from studylake.quality import audit, refusals, structured
from studylake.quality import builders as b
from studylake.quality.catalog import bronze_to_silver
from studylake.bindings.report_rows import Line

TEXT = "concat_ws(',', list_filter([{}], lambda x: x IS NOT NULL))"


def _as_of():
    return F.lit(AS_OF).cast("date")


# --- refused rows ---------------------------------------------------------------

_REFUSED_ASSESSMENTS = """
SELECT r.code_module, r.code_presentation, r.id_assessment, r.assessment_type, r.date, r.weight,
  r.ingestion_timestamp, r.row_num, r.key_conflict,
  CASE WHEN key_id IS NULL THEN 'id_missing_or_unparseable'
       WHEN key_id <= 0 THEN 'id_not_positive'
       WHEN r.key_conflict THEN 'key_conflict'
       WHEN r.row_num > 1 THEN 'duplicate_key_dropped'
       WHEN coalesce(m, '') = '' THEN 'module_missing'
       WHEN coalesce(p, '') = '' THEN 'presentation_missing'
       WHEN coalesce(kind, '') NOT IN ('TMA', 'CMA', 'EXAM') THEN 'type_missing_or_invalid'
       WHEN points IS NULL THEN 'weight_missing_or_unparseable'
       WHEN points < 0 OR points > 100 THEN 'weight_out_of_range'
       WHEN due < 0 OR due > 1000 THEN 'date_out_of_range'
       ELSE 'other_unspecified' END AS refusal_reason
FROM r_assessments r LEFT JOIN s_assessments s ON r.key_id = s.id_assessment
WHERE s.id_assessment IS NULL OR r.row_num > 1"""

_REFUSED_SUBMISSIONS = """
SELECT r.id_assessment, r.id_student, r.date_submitted, r.is_banked, r.score,
  r.ingestion_timestamp, r.row_num, r.key_conflict,
  CASE WHEN aid IS NULL THEN 'assessment_id_missing_or_unparseable'
       WHEN aid <= 0 THEN 'assessment_id_not_positive'
       WHEN sid IS NULL THEN 'student_id_missing_or_unparseable'
       WHEN sid <= 0 THEN 'student_id_not_positive'
       WHEN r.key_conflict THEN 'key_conflict'
       WHEN r.row_num > 1 THEN 'duplicate_key_dropped'
       WHEN day IS NULL THEN 'date_submitted_missing_or_unparseable'
       WHEN day < -365 OR day > 1825 THEN 'date_submitted_out_of_range'
       WHEN banked IS NULL OR banked NOT IN (0, 1) THEN 'is_banked_missing_or_invalid'
       WHEN points IS NOT NULL AND (points < 0 OR points > 100) THEN 'score_out_of_range'
       ELSE 'other_unspecified' END AS refusal_reason
FROM r_student_assessment r
LEFT JOIN s_student_assessment s ON r.aid = s.id_assessment AND r.sid = s.id_student
WHERE s.id_assessment IS NULL OR r.row_num > 1"""


def _refused(t: Learning, spec: cleaning.CleanSpec) -> DataFrame:
    bronze = t.store("bronze", spec.table)
    return refusals.refused_rows(bronze, t.silver[spec.table], spec)


@query("refused_rows", q.with_(_REFUSED_ASSESSMENTS))
def refused_assessments(t: Learning) -> DataFrame:
    return _refused(t, cleaning.ASSESSMENTS)


@query("refused_submissions", q.with_(_REFUSED_SUBMISSIONS))
def refused_submissions(t: Learning) -> DataFrame:
    return _refused(t, cleaning.STUDENT_ASSESSMENT)


_SUMMARY = "SELECT refusal_reason, count(*) AS rows_refused FROM refused GROUP BY 1"


@query("refusal_summary", q.with_(_SUMMARY, refused=_REFUSED_ASSESSMENTS))
def refusal_summary(t: Learning) -> DataFrame:
    return refusals.refusal_summary(refused_assessments(t))


@query("refusal_summary_submissions", q.with_(_SUMMARY, refused=_REFUSED_SUBMISSIONS))
def refusal_summary_submissions(t: Learning) -> DataFrame:
    return refusals.refusal_summary(refused_submissions(t))


@query("topk_refused", q.with_("""
SELECT * FROM refused
ORDER BY refusal_reason, id_assessment NULLS FIRST, id_student NULLS FIRST, row_num LIMIT 200""",
                               refused=_REFUSED_SUBMISSIONS))
def topk_refused(t: Learning) -> DataFrame:
    order = ["refusal_reason", "id_assessment", "id_student", "row_num"]
    return refusals.top_refused(refused_submissions(t), order, 200)


def _accounting_sql(table: str) -> str:
    return q.with_(f"""
SELECT bronze_records, silver_records, refused_records,
       bronze_records - silver_records - refused_records AS imbalance,
       CASE WHEN bronze_records = silver_records + refused_records THEN 'PASS' ELSE 'FAIL' END
         AS status
FROM (SELECT (SELECT count(*) FROM b_{table}) AS bronze_records,
             (SELECT count(*) FROM s_{table}) AS silver_records,
             (SELECT count(*) FROM refused) AS refused_records)""",
        refused=_REFUSED_ASSESSMENTS if table == "assessments" else _REFUSED_SUBMISSIONS)


def _accounting(t: Learning, spec: cleaning.CleanSpec) -> DataFrame:
    bronze, silver = t.store("bronze", spec.table), t.store("silver", spec.table)
    lost = refusals.refused_count(spec.parse(bronze), silver, spec.keys)
    return refusals.row_accounting(bronze, silver, lost)


@query("row_accounting", _accounting_sql("assessments"))
def row_accounting(t: Learning) -> DataFrame:
    return _accounting(t, cleaning.ASSESSMENTS)


@query("row_accounting_submissions", _accounting_sql("student_assessment"))
def row_accounting_submissions(t: Learning) -> DataFrame:
    return _accounting(t, cleaning.STUDENT_ASSESSMENT)


# --- rejected rows -----------------------------------------------------------------

_EVAL_ASSESSMENTS = """
SELECT a.*, count(*) OVER (PARTITION BY a.id_assessment) AS key_occurrences,
       c.code_module AS matched_module, c.module_presentation_length, t.coursework_total
FROM s_assessments a
LEFT JOIN (SELECT DISTINCT code_module, code_presentation, module_presentation_length
           FROM s_courses) c USING (code_module, code_presentation)
LEFT JOIN (SELECT code_module, code_presentation, sum(weight) AS coursework_total
           FROM s_assessments WHERE assessment_type <> 'Exam' GROUP BY 1, 2) t
  USING (code_module, code_presentation)"""

_ASSESSMENT_RULES = {
    "required_column_null": "id_assessment IS NULL OR code_module IS NULL "
    "OR code_presentation IS NULL OR assessment_type IS NULL OR weight IS NULL "
    "OR ingestion_timestamp IS NULL",
    "id_not_positive": "id_assessment <= 0",
    "duplicate_id": "key_occurrences > 1",
    "invalid_type": "assessment_type NOT IN ('TMA', 'CMA', 'Exam')",
    "weight_out_of_range": "isnan(weight) OR weight < 0 OR weight > 100",
    "date_out_of_range": "date < 0 OR date > 1000",
    "orphan_course": "matched_module IS NULL",
    "coursework_weight_total": "assessment_type <> 'Exam' AND round(coursework_total, 6) <> 100",
    "exam_weight_not_100": "assessment_type = 'Exam' AND weight <> 100",
    "date_source_not_captured": "date IS NULL AND date_source IS NULL",
}

_EVAL_SUBMISSIONS = """
SELECT sa.*, count(*) OVER (PARTITION BY sa.id_assessment, sa.id_student) AS key_occurrences,
       a.id_assessment AS matched_assessment, a.code_module, a.code_presentation,
       y.id_student AS student_exists_anywhere, e.id_student AS matched_enrollment,
       e.num_of_prev_attempts, r.date_registration
FROM s_student_assessment sa
LEFT JOIN s_assessments a ON sa.id_assessment = a.id_assessment
LEFT JOIN (SELECT DISTINCT id_student FROM s_student_info) y ON sa.id_student = y.id_student
LEFT JOIN s_student_info e ON sa.id_student = e.id_student AND a.code_module = e.code_module
  AND a.code_presentation = e.code_presentation
LEFT JOIN s_student_registration r ON sa.id_student = r.id_student
  AND a.code_module = r.code_module AND a.code_presentation = r.code_presentation"""

_SUBMISSION_RULES = {
    "required_column_null": "id_assessment IS NULL OR id_student IS NULL "
    "OR date_submitted IS NULL OR is_banked IS NULL OR ingestion_timestamp IS NULL",
    "key_not_positive": "id_assessment <= 0 OR id_student <= 0",
    "duplicate_key": "key_occurrences > 1",
    "is_banked_invalid": "is_banked NOT IN (0, 1)",
    "score_out_of_range": "isnan(score) OR score < 0 OR score > 100",
    "date_out_of_range": "date_submitted < -365 OR date_submitted > 1825",
    "orphan_assessment": "matched_assessment IS NULL",
    "student_not_in_any_enrollment": "student_exists_anywhere IS NULL",
    "orphan_enrollment": "matched_assessment IS NOT NULL "
    "AND student_exists_anywhere IS NOT NULL AND matched_enrollment IS NULL",
    "banked_without_prior_attempt": "is_banked = 1 AND matched_enrollment IS NOT NULL "
    "AND coalesce(num_of_prev_attempts, 0) = 0",
    "submitted_before_registration": "date_submitted < date_registration",
    "score_source_not_captured": "score IS NULL AND score_source IS NULL",
}


def _rejected_sql(columns: str, rules: Mapping[str, str], evaluated: str) -> str:
    listed = ", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in rules.items())
    return q.with_(
        f"SELECT * FROM (SELECT {columns}, {TEXT.format(listed)} AS reject_reasons "
        "FROM evaluated) WHERE reject_reasons <> ''",
        evaluated=evaluated,
    )


def _as_text(rejected: DataFrame) -> DataFrame:
    return rejected.withColumn("reject_reasons", F.concat_ws(",", "reject_reasons"))


@query("rejected_reasons", _rejected_sql(
    "id_assessment, code_module, code_presentation, assessment_type, date, date_source, weight, "
    "module_presentation_length, coursework_total", _ASSESSMENT_RULES, _EVAL_ASSESSMENTS))
def rejected_reasons(t: Learning) -> DataFrame:
    return _as_text(structured.rejected_assessments(t.silver["assessments"], t.silver["courses"]))


def _submission_layers(t: Learning) -> list[DataFrame]:
    names = ("student_assessment", "assessments", "student_info", "student_registration")
    t.store("silver", "student_assessment")
    return [t.silver[n] for n in names]


@query("rejected_submissions", _rejected_sql(
    "id_assessment, id_student, date_submitted, is_banked, score, score_source, code_module, "
    "code_presentation, num_of_prev_attempts, date_registration",
    _SUBMISSION_RULES, _EVAL_SUBMISSIONS))
def rejected_submissions(t: Learning) -> DataFrame:
    return _as_text(structured.rejected_submissions(*_submission_layers(t)))


# --- structured reports -----------------------------------------------------------------

def _literal(value: str | float | None, kind: str) -> str:
    if value is None:
        return f"CAST(NULL AS {kind})"
    return f"CAST('{value}' AS {kind})" if isinstance(value, str) else f"CAST({value} AS {kind})"


def _report_sql(
    lines: Sequence[Line],
    layer: str,
    table: str,
    by_threshold: bool,
    violations: Mapping[str, str],
    totals: Mapping[str, str],
    ready: Mapping[str, str],
    **frames: str,
) -> str:
    """A row-level restatement: every count is its own aggregate over ``evaluated``."""
    metrics = ", ".join(
        [f"CAST(({sql}) AS BIGINT) AS v{i}" for i, sql in enumerate(violations.values())]
    )
    number = {name: f"v{i}" for i, name in enumerate(violations)}
    rows = " UNION ALL ".join(
        f"SELECT '{category}' AS check_category, '{name}' AS check_name, "
        f"'{level}' AS check_level, {totals.get(name, 'total')} AS total_records, "
        f"{number[name]} AS violations, {_literal(warn, 'DOUBLE')} AS warn, "
        f"{_literal(fail, 'DOUBLE')} AS fail, {_literal(severity, 'VARCHAR')} AS severity, "
        f"{ready.get(name, 'TRUE')} AS ready, '{description}' AS description FROM stats"
        for category, name, level, warn, fail, severity, _, description in lines
    )
    measured = f"""SELECT *, CASE WHEN check_level = 'ROW' AND total_records > 0 AND ready
        THEN {q.rate('violations', 'total_records')} END AS violation_rate FROM checks"""
    if by_threshold:
        status = """CASE WHEN check_level = 'TABLE'
              THEN CASE WHEN violations > 0 THEN 'FAIL' ELSE 'PASS' END
            WHEN total_records = 0 OR NOT ready THEN 'NOT_EVALUATED'
            WHEN violation_rate > fail THEN 'FAIL' WHEN violation_rate > warn THEN 'WARNING'
            ELSE 'PASS' END"""
        limits = "warn AS warning_threshold, fail AS fail_threshold"
    else:
        status = """CASE WHEN (check_level = 'ROW' AND total_records = 0) OR NOT ready
              THEN 'NOT_EVALUATED' WHEN violations = 0 THEN 'PASS' ELSE severity END"""
        limits = """CASE WHEN check_level = 'ROW' AND severity = 'WARNING' THEN CAST(0 AS DOUBLE) END
              AS warning_threshold,
            CASE WHEN check_level = 'ROW' AND severity = 'FAIL' THEN CAST(0 AS DOUBLE) END
              AS fail_threshold"""
    return q.with_(
        f"""SELECT '{layer}' AS layer_name, '{table}' AS table_name, check_category, check_name,
       check_level, {status} AS status, total_records,
       CASE WHEN ready THEN violations END AS violation_count, violation_rate, {limits},
       description, TIMESTAMP '2024-01-10 00:00:00' AS checked_at
FROM measured""",
        **frames,
        stats=f"SELECT count(*) AS total, {metrics} FROM evaluated",
        checks=rows,
        measured=measured,
    )


def _blank_to_null(column: str, upper: bool = False) -> str:
    text = f"nullif(regexp_replace({column}, '^\\s+|\\s+$', '', 'g'), '')"
    return f"upper({text})" if upper else text


_ASSESSMENT_TEXTS = f"""
SELECT *, {q.as_int('id_text')} AS aid, {q.as_int('date_text')} AS day,
       {q.as_double('weight_text')} AS points
FROM (SELECT {_blank_to_null('id_assessment')} AS id_text,
        {_blank_to_null('code_module', True)} AS m, {_blank_to_null('code_presentation', True)} AS p,
        {_blank_to_null('assessment_type', True)} AS kind, {_blank_to_null('date')} AS date_text,
        {_blank_to_null('weight')} AS weight_text, ingestion_timestamp, ingestion_date
      FROM b_assessments)"""
_COURSE_KEYS = f"""
SELECT DISTINCT {_blank_to_null('code_module', True)} AS m,
       {_blank_to_null('code_presentation', True)} AS p FROM b_courses"""


def _if(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


@query("dq_threshold_report", _report_sql(
    report_rows.BRONZE_ASSESSMENTS, "BRONZE", "assessments", True,
    {
        "Record Count": "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END",
        "Missing id_assessment": _if("id_text IS NULL"),
        "Invalid id_assessment Format": _if("id_text IS NOT NULL AND aid IS NULL"),
        "Missing code_module": _if("m IS NULL"),
        "Missing code_presentation": _if("p IS NULL"),
        "Missing Ingestion Metadata": _if("ingestion_timestamp IS NULL OR ingestion_date IS NULL"),
        "Duplicate Assessment IDs": "count(aid) - count(DISTINCT aid)",
        "Missing Assessment Type": _if("kind IS NULL"),
        "Assessment Type Domain": _if("kind NOT IN ('TMA', 'CMA', 'EXAM')"),
        "Invalid Assessment Date Format": _if(
            "date_text IS NOT NULL AND date_text <> '?' AND day IS NULL"),
        "Missing Assessment Date": _if("date_text IS NULL OR date_text = '?'"),
        "Missing Assessment Weight": _if("weight_text IS NULL"),
        "Invalid Assessment Weight Format": _if("weight_text IS NOT NULL AND points IS NULL"),
        "Assessment Weight Range": _if("isnan(points) OR points < 0 OR points > 100"),
        "Coursework Weight Total": _if("kind <> 'EXAM' AND round(coursework, 6) <> 100"),
        "Course Reference Available":
            "CASE WHEN (SELECT count(*) FROM parents) = 0 THEN 1 ELSE 0 END",
        "Unknown Module Presentation": _if(
            "m IS NOT NULL AND p IS NOT NULL AND known IS NULL"),
    },
    {"Course Reference Available": "(SELECT count(*) FROM parents)"},
    {"Unknown Module Presentation": "(SELECT count(*) FROM parents) > 0"},
    texts=_ASSESSMENT_TEXTS,
    parents=f"SELECT * FROM ({_COURSE_KEYS}) WHERE m IS NOT NULL AND p IS NOT NULL",
    coursework="SELECT m, p, sum(points) AS coursework FROM texts WHERE kind <> 'EXAM' GROUP BY 1, 2",
    evaluated="""SELECT t.*, c.m AS known, w.coursework FROM texts t
      LEFT JOIN parents c ON t.m = c.m AND t.p = c.p
      LEFT JOIN coursework w ON t.m = w.m AND t.p = w.p""",
))
def dq_threshold_report(t: Learning) -> DataFrame:
    return structured.bronze_assessment_report(
        t.bronze["assessments"], t.bronze["courses"], _as_of().cast("timestamp")
    )


_SUBMISSION_TEXTS = f"""
SELECT *, {q.as_int('aid_text')} AS aid, {q.as_int('sid_text')} AS sid,
       {q.as_int('date_text')} AS day, {q.as_int('banked_text')} AS banked,
       {q.as_double('score_text')} AS points
FROM (SELECT {_blank_to_null('id_assessment')} AS aid_text, {_blank_to_null('id_student')} AS sid_text,
        {_blank_to_null('date_submitted')} AS date_text, {_blank_to_null('is_banked')} AS banked_text,
        {_blank_to_null('score')} AS score_text, ingestion_timestamp, ingestion_date
      FROM b_student_assessment)"""
_MAPPING = f"""
SELECT aid, count(*) AS mapping_count, min(m) AS m, min(p) AS p
FROM (SELECT DISTINCT {q.as_int('id_assessment')} AS aid, {_blank_to_null('code_module', True)} AS m,
             {_blank_to_null('code_presentation', True)} AS p FROM b_assessments)
WHERE aid IS NOT NULL GROUP BY 1"""
_ENROLLED = f"""
SELECT DISTINCT {q.as_int('id_student')} AS sid, {_blank_to_null('code_module', True)} AS m,
       {_blank_to_null('code_presentation', True)} AS p FROM b_student_info
WHERE {q.as_int('id_student')} IS NOT NULL AND {_blank_to_null('code_module')} IS NOT NULL
  AND {_blank_to_null('code_presentation')} IS NOT NULL"""
_USABLE = "known IS NOT NULL AND mapping_count = 1 AND m IS NOT NULL AND p IS NOT NULL"
_HAS_ASSESSMENTS = "(SELECT count(*) FROM mapping) > 0"
_HAS_STUDENTS = "(SELECT count(*) FROM enrolled) > 0"


@query("dq_severity_report", _report_sql(
    report_rows.BRONZE_SUBMISSIONS, "BRONZE", "student_assessment_bronze", False,
    {
        "Record Count": "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END",
        "Missing id_assessment": _if("aid_text IS NULL"),
        "Invalid id_assessment Format": _if("aid_text IS NOT NULL AND aid IS NULL"),
        "Missing id_student": _if("sid_text IS NULL"),
        "Invalid id_student Format": _if("sid_text IS NOT NULL AND sid IS NULL"),
        "Missing Ingestion Metadata": _if("ingestion_timestamp IS NULL OR ingestion_date IS NULL"),
        "Duplicate Student-Assessment Keys":
            f"{_if('aid IS NOT NULL AND sid IS NOT NULL')} - count(DISTINCT (aid, sid)) "
            "FILTER (WHERE aid IS NOT NULL AND sid IS NOT NULL)",
        "Missing date_submitted": _if("date_text IS NULL"),
        "Invalid date_submitted Format": _if("date_text IS NOT NULL AND day IS NULL"),
        "Missing is_banked": _if("banked_text IS NULL"),
        "Invalid is_banked Value": _if(
            "banked_text IS NOT NULL AND (banked IS NULL OR banked NOT IN (0, 1))"),
        "Missing Score": _if("score_text IS NULL"),
        "Invalid Score Format": _if("score_text IS NOT NULL AND points IS NULL"),
        "Score Out of Range": _if("isnan(points) OR points < 0 OR points > 100"),
        "Assessment Reference Available":
            "CASE WHEN (SELECT count(*) FROM mapping) = 0 THEN 1 ELSE 0 END",
        "Student Enrollment Reference Available":
            "CASE WHEN (SELECT count(*) FROM enrolled) = 0 THEN 1 ELSE 0 END",
        "Orphan Assessment Reference": _if("aid IS NOT NULL AND known IS NULL"),
        "Unusable Assessment Module Mapping": _if(
            "known IS NOT NULL AND (mapping_count <> 1 OR m IS NULL OR p IS NULL)"),
        "Student Not In Any Enrollment": _if("sid IS NOT NULL AND anywhere IS NULL"),
        "Orphan Student Enrollment Reference": _if(
            f"sid IS NOT NULL AND {_USABLE} AND enrolled_sid IS NULL"),
    },
    {
        "Assessment Reference Available": "(SELECT count(*) FROM mapping)",
        "Student Enrollment Reference Available": "(SELECT count(*) FROM enrolled)",
    },
    {
        "Orphan Assessment Reference": _HAS_ASSESSMENTS,
        "Unusable Assessment Module Mapping": _HAS_ASSESSMENTS,
        "Student Not In Any Enrollment": _HAS_STUDENTS,
        "Orphan Student Enrollment Reference":
            f"{_HAS_ASSESSMENTS} AND {_HAS_STUDENTS} AND "
            f"(SELECT count(*) FROM evaluated WHERE sid IS NOT NULL AND {_USABLE}) > 0",
    },
    texts=_SUBMISSION_TEXTS, mapping=_MAPPING, enrolled=_ENROLLED,
    evaluated="""SELECT t.*, a.aid AS known, a.mapping_count, a.m, a.p, e.sid AS enrolled_sid,
        y.sid AS anywhere FROM texts t
      LEFT JOIN mapping a ON t.aid = a.aid
      LEFT JOIN enrolled e ON t.sid = e.sid AND a.m = e.m AND a.p = e.p AND a.mapping_count = 1
      LEFT JOIN (SELECT DISTINCT sid FROM enrolled) y ON t.sid = y.sid""",
))
def dq_severity_report(t: Learning) -> DataFrame:
    return structured.bronze_submission_report(
        t.bronze["student_assessment"], t.bronze["assessments"], t.bronze["student_info"],
        _as_of().cast("timestamp"),
    )


def _unbalanced_sql(table: str) -> str:
    return (
        f"CASE WHEN (SELECT count(*) FROM b_{table}) - count(*) "
        "- (SELECT count(*) FROM refused) <> 0 THEN 1 ELSE 0 END"
    )


def _silver_violations(
    lines: Sequence[Line], rules: Mapping[str, str], table: str, **more: str
) -> dict[str, str]:
    found = {
        "Record Count": "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END",
        "Row Accounting Balances": _unbalanced_sql(table),
    }
    conditions = {**rules, **more}
    for _, name, *_, metric, _ in lines:
        if name not in found:
            found[name] = _if(conditions[metric])
    return found


@query("dq_silver_assessments", _report_sql(
    report_rows.SILVER_ASSESSMENTS, "SILVER", "assessments_silver", False,
    _silver_violations(report_rows.SILVER_ASSESSMENTS, _ASSESSMENT_RULES, "assessments",
                       date_missing="date IS NULL"),
    {"Row Accounting Balances": "(SELECT count(*) FROM b_assessments)"},
    {"Orphan Module Presentation": "(SELECT count(*) FROM s_courses) > 0"},
    refused=_REFUSED_ASSESSMENTS, evaluated=_EVAL_ASSESSMENTS,
))
def dq_silver_assessments(t: Learning) -> DataFrame:
    return structured.silver_assessment_report(
        t.silver["assessments"], t.silver["courses"], t.bronze["assessments"],
        _as_of().cast("timestamp"),
    )


_SOME_ASSESSMENT = "(SELECT count(*) FROM s_assessments) > 0"
_SOME_STUDENT = "(SELECT count(*) FROM s_student_info) > 0"


@query("dq_silver_submissions", _report_sql(
    report_rows.SILVER_SUBMISSIONS, "SILVER", "student_assessment_silver", False,
    _silver_violations(report_rows.SILVER_SUBMISSIONS, _SUBMISSION_RULES, "student_assessment",
                       score_missing="score IS NULL"),
    {"Row Accounting Balances": "(SELECT count(*) FROM b_student_assessment)"},
    {
        "Orphan Assessment Reference": _SOME_ASSESSMENT,
        "Student Not In Any Enrollment": _SOME_STUDENT,
        "Orphan Student Enrollment Reference":
            f"{_SOME_ASSESSMENT} AND {_SOME_STUDENT} AND (SELECT count(*) FROM evaluated "
            "WHERE matched_assessment IS NOT NULL AND student_exists_anywhere IS NOT NULL) > 0",
        "Banked Without Prior Attempt":
            "(SELECT count(*) FROM evaluated WHERE is_banked = 1) > 0",
    },
    refused=_REFUSED_SUBMISSIONS, evaluated=_EVAL_SUBMISSIONS,
))
def dq_silver_submissions(t: Learning) -> DataFrame:
    t.store("bronze", "student_assessment")
    return structured.silver_submission_report(
        *_submission_layers(t), t.bronze["student_assessment"], _as_of().cast("timestamp")
    )


# --- the builders one by one ----------------------------------------------------------------

def _check_sql(
    category: str, name: str, metrics: str, status: str, source: str, description: str
) -> str:
    return q.with_(
        f"SELECT '{category}' AS check_category, '{name}' AS check_name, *, "
        f"CASE {status} END AS status, '{description}' AS description "
        f"FROM (SELECT {metrics} FROM {source})"
    )


_ZERO = "WHEN {0} = 0 THEN 'PASS' ELSE 'FAIL'"


def _sums(**conditions: str) -> str:
    return ", ".join(
        f"{q.big(f'sum(CASE WHEN {c} THEN 1 ELSE 0 END)')} AS {n}" for n, c in conditions.items()
    )


@query("dq_row_count", _check_sql(
    "COMPLETENESS", "Record Count", "count(*) AS actual_count",
    "WHEN actual_count > 0 THEN 'PASS' ELSE 'FAIL'", "events",
    "The table holds at least one row."))
def dq_row_count(t: Learning) -> DataFrame:
    return b.run_check(t.table("events"), b.row_count("1"))


@query("dq_not_null", _check_sql(
    "COMPLETENESS", "Required Columns",
    "count(*) AS total_records, " + _sums(
        null_disability="disability IS NULL", null_region="region IS NULL"),
    "WHEN null_disability = 0 AND null_region = 0 THEN 'PASS' ELSE 'FAIL'", "b_student_info",
    "Required columns are filled."))
def dq_not_null(t: Learning) -> DataFrame:
    return b.run_check(t.bronze["student_info"], b.not_null(
        "1", "Required Columns", {"null_disability": "disability", "null_region": "region"}))


@query("dq_not_blank", _check_sql(
    "BUSINESS_RULE", "Valid Texts", "count(*) AS total_records, " + _sums(
        blank_texts="trim(text) = ''"),
    _ZERO.format("blank_texts"), "documents", "Text is not blank."))
def dq_not_blank(t: Learning) -> DataFrame:
    return b.run_check(
        t.table("documents"), b.not_blank("1", "Valid Texts", "blank_texts", "text"))


@query("dq_parseable", _check_sql(
    "VALIDITY", "Week Value Format", "count(*) AS total_records, " + _sums(
        malformed=f"({q.as_int('week_from')}) IS NULL OR ({q.as_int('week_to')}) IS NULL"),
    _ZERO.format("malformed"), "b_vle", "Values have the declared type."))
def dq_parseable(t: Learning) -> DataFrame:
    return b.run_check(t.bronze["vle"], b.parseable(
        "1", "Week Value Format", "malformed", ["week_from", "week_to"], "int"))


@query("dq_unique", _check_sql(
    "UNIQUENESS", "Line Keys",
    f"count(*) AS duplicate_combinations, "
    f"{q.big('coalesce(sum(n), 0)')} AS total_duplicate_records",
    "WHEN duplicate_combinations = 0 THEN 'PASS' ELSE 'WARNING'",
    "(SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)",
    "One row per key."))
def dq_unique(t: Learning) -> DataFrame:
    lines = t.table("lineitem")
    return b.run_check(lines, b.unique(
        "1", "Line Keys", lines, ["l_orderkey", "l_linenumber"], bad="WARNING"))


@query("dq_in_domain", _check_sql(
    "VALIDITY", "Segments and Genders", "count(*) AS total_records, " + _sums(
        invalid_gender="gender NOT IN ('M', 'F', 'm', 'f')",
        invalid_disability="disability NOT IN ('Y', 'N', 'y', 'n')"),
    "WHEN invalid_gender + invalid_disability = 0 THEN 'PASS' ELSE 'FAIL'", "b_student_info",
    "Values belong to their domain."))
def dq_in_domain(t: Learning) -> DataFrame:
    return b.run_check(t.bronze["student_info"], b.in_domain(
        "1", "VALIDITY", "Segments and Genders",
        {"invalid_gender": (F.col("gender"), schemas.RAW_GENDERS),
         "invalid_disability": (F.col("disability"), ["Y", "N", "y", "n"])}))


@query("dq_in_range", _check_sql(
    "BUSINESS_RULE", "Account Balance",
    "count(*) AS total_records, " + _sums(
        negative="c_acctbal < 0", excessive="c_acctbal > 9999")
    + ", min(c_acctbal) AS lowest, max(c_acctbal) AS highest, "
    + _sums(_any="c_acctbal < 0 OR c_acctbal > 9999"),
    "WHEN _any = 0 THEN 'PASS' WHEN _any < total_records * 0.2 THEN 'WARNING' ELSE 'FAIL'",
    "customer", "Values lie in their range.").replace(", *,", ", * EXCLUDE (_any),"))
def dq_in_range(t: Learning) -> DataFrame:
    balance = F.col("c_acctbal")
    return b.run_check(t.table("customer"), b.in_range(
        "1", "BUSINESS_RULE", "Account Balance",
        {"negative": balance < 0, "excessive": balance > 9999},
        {"lowest": F.min(balance), "highest": F.max(balance)}, warn_below=0.2))


@query("dq_ordered_pair", _check_sql(
    "VALIDITY", "Shipped After Order",
    "count(*) AS total_records, " + _sums(inverted="o_orderdate > l_shipdate"),
    _ZERO.format("inverted"), "lineitem JOIN orders ON l_orderkey = o_orderkey",
    "The first value does not exceed the second."))
def dq_ordered_pair(t: Learning) -> DataFrame:
    return b.run_check(t._lines(), b.ordered_pair(
        "1", "VALIDITY", "Shipped After Order", "inverted",
        F.col("o_orderdate"), F.col("l_shipdate")))


@query("dq_standardized", _check_sql(
    "BUSINESS_RULE", "Standardized Codes", "count(*) AS total_records, " + _sums(
        invalid_module_codes="code_module <> upper(trim(code_module))",
        invalid_presentation_codes="code_presentation <> upper(trim(code_presentation))"),
    "WHEN invalid_module_codes + invalid_presentation_codes = 0 THEN 'PASS' ELSE 'FAIL'",
    "b_assessments", "Texts have their standard form."))
def dq_standardized(t: Learning) -> DataFrame:
    return b.run_check(t.bronze["assessments"], b.standardized(
        "1", "BUSINESS_RULE", "Standardized Codes",
        {f"invalid_{c}_codes": (f"code_{c}", fx.norm_code(F.col(f"code_{c}")))
         for c in ("module", "presentation")}))


@query("dq_fresh", _check_sql(
    "TIMELINESS", "Data Freshness",
    "max(day) AS latest_ingestion_date, "
    "CAST(date_diff('day', max(day), DATE '2024-02-20') AS INT) AS days_since_last_ingestion",
    "WHEN days_since_last_ingestion <= 7 THEN 'PASS' "
    "WHEN days_since_last_ingestion <= 30 THEN 'WARNING' ELSE 'FAIL'",
    "(SELECT CAST(ts AS DATE) AS day FROM events)",
    "The last load is at most 7 days old, at worst 30."))
def dq_fresh(t: Learning) -> DataFrame:
    events = t.table("events").select(F.to_date("ts").alias("ingestion_date"))
    return b.run_check(events, b.fresh("1", F.lit("2024-02-20").cast("date")))


@query("dq_foreign_key", _check_sql(
    "CONSISTENCY", "Lines of Open Orders", "count(*) AS orphans",
    _ZERO.format("orphans"),
    "lineitem ANTI JOIN (SELECT * FROM orders WHERE o_orderstatus = 'O') "
    "ON l_orderkey = o_orderkey", "Every row has its parent."))
def dq_foreign_key(t: Learning) -> DataFrame:
    parents = t.table("orders").filter(F.col("o_orderstatus") == "O").select(
        F.col("o_orderkey").alias("l_orderkey"))
    lines = t.table("lineitem")
    return b.run_check(lines, b.foreign_key(
        "1", "CONSISTENCY", "Lines of Open Orders", "orphans", lines, parents, ["l_orderkey"]))


@query("dq_layer_retention", q.with_(f"""
SELECT 'CONSISTENCY' AS check_category, 'Bronze to Silver Record Count' AS check_name, *,
  bronze_count - silver_count AS records_filtered,
  {q.pct('silver_count', 'bronze_count')} AS retention_rate_pct,
  CASE WHEN silver_count > bronze_count THEN 'FAIL' WHEN silver_count > 0 THEN 'PASS'
       ELSE 'WARNING' END AS status,
  'The next layer keeps what it should.' AS description
FROM (SELECT (SELECT count(*) FROM b_student_info) AS bronze_count,
             (SELECT count(*) FROM s_student_info) AS silver_count)"""))
def dq_layer_retention(t: Learning) -> DataFrame:
    bronze = t.bronze["student_info"]
    return b.run_check(bronze, bronze_to_silver("1", bronze, t.silver["student_info"]))


@query("dq_group_total", q.with_("""
SELECT code_module, code_presentation, sum(weight) AS group_total, count(*) AS group_rows
FROM s_assessments WHERE assessment_type <> 'Exam' GROUP BY 1, 2
HAVING round(sum(weight), 6) <> 100"""))
def dq_group_total(t: Learning) -> DataFrame:
    coursework = t.silver["assessments"].filter(F.col("assessment_type") != "Exam")
    return b.group_total(coursework, ["code_module", "code_presentation"], "weight", 100)


@query("dq_cross_row_rule", """
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, o_orderdate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate""")
def dq_cross_row_rule(t: Learning) -> DataFrame:
    lines = t.table("lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_orderkey", "l_linenumber", "l_partkey",
        "l_shipdate")
    orders = t.table("orders").select("o_orderkey", "o_orderdate")
    broken = F.col("l_shipdate") < F.col("o_orderdate")
    return b.cross_row_rule(lines, orders, ["o_orderkey"], broken).drop("o_orderkey")


@query("dq_distribution", _check_sql(
    "BUSINESS_RULE", "Order Status",
    "count(*) AS total_orders, " + _sums(open_orders="o_orderstatus = 'O'",
                                         finished_orders="o_orderstatus = 'F'")
    + f", {q.pct(_if('''o_orderstatus = 'F' '''), 'count(*)')} AS finished_pct, "
    "max(o_totalprice) AS max_price", "WHEN TRUE THEN 'INFO'", "orders",
    "Distribution, for information."))
def dq_distribution(t: Learning) -> DataFrame:
    status = F.col("o_orderstatus")
    return b.run_check(t.table("orders"), b.distribution("1", "BUSINESS_RULE", "Order Status", {
        "total_orders": b.rows(),
        "open_orders": b.violations(status == "O"),
        "finished_orders": b.violations(status == "F"),
        "finished_pct": fx.pct(F.count_if(status == "F"), b.rows()),
        "max_price": F.max("o_totalprice"),
    }))


@query("dq_profile", _check_sql(
    "SUMMARY", "Table Profile",
    "count(*) AS total_records, count(DISTINCT user_id) AS users, "
    "count(DISTINCT event_type) AS event_types, min(CAST(ts AS DATE)) AS earliest, "
    "max(CAST(ts AS DATE)) AS latest", "WHEN TRUE THEN 'INFO'", "events", "Overview of the table."))
def dq_profile(t: Learning) -> DataFrame:
    return b.run_check(t.table("events"), _event_profile())


def _event_profile() -> b.Check:
    return b.profile("1", {
        "total_records": b.rows(),
        "users": F.countDistinct("user_id"),
        "event_types": F.countDistinct("event_type"),
        "earliest": F.min(F.to_date("ts")),
        "latest": F.max(F.to_date("ts")),
    }, listed=["event_type"])


@query("dq_profile_values", """
SELECT DISTINCT 'BRONZE' AS layer_name, 'events' AS table_name, '1' AS check_code,
       'Table Profile' AS check_name, 'event_type' AS column_name, event_type AS value FROM events""")
def dq_profile_values(t: Learning) -> DataFrame:
    """The values that the profile counts, as rows."""
    return b.check_values(t.table("events"), [_event_profile()], "BRONZE", "events")


@query("dq_completeness", _check_sql(
    "SUMMARY", "Attribute Completeness %",
    f"{q.pct('count(date_registration)', 'count(*)')} AS registration_completeness, "
    f"{q.pct('count(date_unregistration)', 'count(*)')} AS unregistration_completeness",
    "WHEN TRUE THEN 'INFO'", "s_student_registration", "Share of filled values per attribute."))
def dq_completeness(t: Learning) -> DataFrame:
    return b.run_check(t.silver["student_registration"], b.completeness(
        "1", {"registration": "date_registration", "unregistration": "date_unregistration"}))


@query("dq_distinct_values", q.with_(
    " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM b_vle"
        for c in ("code_module", "code_presentation", "activity_type", "ingestion_date"))))
def dq_distinct_values(t: Learning) -> DataFrame:
    return b.distinct_values(
        t.bronze["vle"], "code_module", "code_presentation", "activity_type", "ingestion_date")


# --- relationships, gate, audit ----------------------------------------------------------------

_GOLD_SQL = {
    "dim_student_enrollment": "g_enrollment", "dim_student": "g_student", "dim_course": "g_course",
    "fact_student_engagement": "g_engagement",
}


def _relationship_sql(child: str, parent: str, on: str) -> str:
    c, p = _GOLD_SQL[child], _GOLD_SQL[parent]
    return f"""
SELECT '{child}_{parent}' AS relationship, child_rows, null_keys, orphans, repeated_parents,
       CASE WHEN orphans = 0 AND repeated_parents = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT (SELECT count(*) FROM {c}) AS child_rows,
             (SELECT count(*) FROM {c} WHERE {on} IS NULL) AS null_keys,
             (SELECT count(*) FROM {c} x WHERE x.{on} IS NOT NULL AND NOT EXISTS (
                SELECT 1 FROM {p} y WHERE y.{on} = x.{on})) AS orphans,
             (SELECT count(*) FROM (SELECT {on} FROM {p} GROUP BY 1 HAVING count(*) > 1))
               AS repeated_parents)"""


@query("relationship_check", q.with_(
    " UNION ALL ".join(_relationship_sql(*r) for r in (
        ("dim_student_enrollment", "dim_student", "student_id"),
        ("dim_student_enrollment", "dim_course", "course_id"),
        ("fact_student_engagement", "dim_student_enrollment", "student_enrollment_id")))))
def relationship_check(t: Learning) -> DataFrame:
    t.store("gold", "dim_student_enrollment")
    checks = [
        audit.relationship_check(t.gold[child], t.gold[parent], [on], f"{child}_{parent}")
        for child, parent, on in gold.RELATIONSHIPS
    ]
    first, *rest = checks
    for frame in rest:
        first = first.unionByName(frame)
    return first


_GATED = ("courses", "vle", "assessments", "student_info", "student_registration")


def _gate_sql(table: str) -> str:
    return f"""
SELECT '{table}' AS dataset, pre_check, post_check, pre_check - post_check AS rows_dropped,
       {q.pct('(pre_check - post_check)', 'pre_check')} AS percent_dropped,
       CASE WHEN (pre_check - post_check) * 100.0 / pre_check < 5 THEN 'Acceptable'
            WHEN (pre_check - post_check) * 100.0 / pre_check <= 10 THEN 'Warning'
            ELSE 'Unusable' END AS severity,
       (pre_check - post_check) * 100.0 / pre_check > 10 AS halt
FROM (SELECT (SELECT count(*) FROM b_{table}) AS pre_check,
             (SELECT count(*) FROM s_{table}) AS post_check)"""


def _gate(t: Learning, table: str) -> DataFrame:
    return audit.drop_rate_gate(t.bronze[table], t.silver[table], table)


@query("drop_rate_gate", q.with_(" UNION ALL ".join(_gate_sql(n) for n in _GATED)))
def drop_rate_gate(t: Learning) -> DataFrame:
    first, *rest = [_gate(t, n) for n in _GATED]
    for frame in rest:
        first = first.unionByName(frame)
    return first


_FLAGS = {
    "courses": "TRY_CAST(module_presentation_length AS INT) IS NULL",
    "vle": "week_from = '?' OR week_to = '?'",
}


def _log_sql(table: str) -> str:
    return f"""
SELECT *, CASE WHEN halt THEN 'FAIL' WHEN severity = 'Warning' OR flags_triggered > 0 THEN 'WARN'
          ELSE 'PASS' END AS health
FROM (SELECT *, (SELECT count(*) FROM b_{table} WHERE {_FLAGS[table]}) AS flags_triggered
      FROM ({_gate_sql(table)}))"""


def _logs(t: Learning) -> DataFrame:
    placeholder = (F.col("week_from") == "?") | (F.col("week_to") == "?")
    unparsed = F.col("module_presentation_length").try_cast("int").isNull()
    courses = t.bronze["courses"].agg(F.count_if(unparsed))
    vle = t.bronze["vle"].agg(F.count_if(fx.present(placeholder)))
    return audit.audit_log(_gate(t, "courses"), courses).unionByName(
        audit.audit_log(_gate(t, "vle"), vle))


@query("dq_audit_log", q.with_(" UNION ALL ".join(_log_sql(n) for n in _FLAGS)))
def dq_audit_log(t: Learning) -> DataFrame:
    return _logs(t)


@query("overall_health", q.with_(f"""
SELECT count(*) AS datasets, {q.big('sum(rows_dropped)')} AS rows_dropped,
       {q.big('sum(flags_triggered)')} AS flags_triggered,
       CASE WHEN bool_or(health = 'FAIL') THEN 'FAIL' WHEN bool_or(health = 'WARN') THEN 'WARN'
            ELSE 'PASS' END AS health
FROM ({' UNION ALL '.join(_log_sql(n) for n in _FLAGS)})"""))
def overall_health(t: Learning) -> DataFrame:
    return audit.overall_health(_logs(t))


@query("gated_lookup", """
SELECT l_orderkey, l_linenumber, o_custkey, o_orderstatus FROM lineitem
LEFT JOIN orders ON l_orderkey = o_orderkey AND l_linenumber = 1""")
def gated_lookup(t: Learning) -> DataFrame:
    lines = t.table("lineitem").select("l_orderkey", "l_linenumber")
    orders = t.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return joins.lookup(
        lines, orders, {"l_orderkey": "o_orderkey"}, gate=lines["l_linenumber"] == 1)
