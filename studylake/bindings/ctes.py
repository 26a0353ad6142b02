"""DuckDB text of the same tables: bronze, silver and gold as named subqueries.

Written for the comparison only. Each subquery lists what it needs, and ``with_``
puts the needed ones in front of a query.
"""

from __future__ import annotations

import re

T1, T2 = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-08 00:00:00'"


def as_int(text: str) -> str:
    """Whole numbers only: a plain TRY_CAST would round decimals."""
    return (
        f"CASE WHEN regexp_full_match(trim({text}), '[+-]?[0-9]+') "
        f"THEN TRY_CAST(trim({text}) AS BIGINT) END"
    )


def as_double(text: str) -> str:
    return f"TRY_CAST({text} AS DOUBLE)"


def rnd(value: str, digits: int) -> str:
    """Half-up rounding of the decimal value, free of binary ties."""
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def share(part: str, whole: str, scale: int, digits: int) -> str:
    """``scale * part / whole`` rounded half up, in integers; NULL without rows."""
    unit = scale * 10**digits
    return (
        f"CASE WHEN ({whole}) > 0 THEN CAST((CAST({part} AS BIGINT) * {2 * unit} + ({whole})) "
        f"// (2 * ({whole})) AS DOUBLE) / {10**digits} END"
    )


def pct(part: str, whole: str) -> str:
    return share(part, whole, 100, 2)


def rate(part: str, whole: str) -> str:
    return share(part, whole, 1, 4)


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


CODES = "upper(trim(code_module)) AS code_module, upper(trim(code_presentation)) AS code_presentation"

CTES: dict[str, str] = {}

CTES["b_courses"] = f"""
  SELECT m AS code_module, p AS code_presentation, len AS module_presentation_length,
         {T1} AS ingestion_timestamp, CAST({T1} AS DATE) AS ingestion_date FROM b_courses_base
  UNION ALL
  SELECT ' ' || lower(m) || ' ', lower(p), len, {T2}, CAST({T2} AS DATE) FROM b_courses_base"""
CTES["b_courses_base"] = """
  SELECT o_orderpriority AS m, CAST(year(o_orderdate) AS VARCHAR) || 'J' AS p,
         CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) AS VARCHAR) AS len
  FROM orders GROUP BY 1, 2"""

CTES["b_parts"] = """
  SELECT *, CASE WHEN p_size <= 10 THEN '1-URGENT' WHEN p_size <= 20 THEN ' 2-high'
                 WHEN p_size <= 30 THEN '3-Medium ' WHEN p_size <= 40 THEN '4-NOT SPECIFIED'
                 ELSE '5-LOW' END AS code_module,
         CAST(1995 + (brand - 1) // 3 AS VARCHAR) || 'j' AS code_presentation
  FROM (SELECT *, CAST(substr(p_brand, 7, 2) AS INTEGER) AS brand FROM part)"""

CTES["b_assessments"] = f"""
  SELECT code_module, code_presentation, id_assessment, assessment_type, date, weight,
         {T1} AS ingestion_timestamp, CAST({T1} AS DATE) AS ingestion_date
  FROM b_assessments_base
  UNION ALL
  SELECT code_module, code_presentation, id_assessment, assessment_type, date,
         CASE WHEN p_type = 'ECONOMY' AND p_size < 5 THEN '1' ELSE weight END,
         {T2}, CAST({T2} AS DATE)
  FROM b_assessments_base WHERE brand > 12"""
CTES["b_assessments_base"] = """
  SELECT code_module, code_presentation, brand, p_type, p_size,
    CASE WHEN p_type = 'LARGE' AND p_size > 45 THEN 'A' || CAST(p_partkey AS VARCHAR)
         ELSE CAST(p_partkey AS VARCHAR) END AS id_assessment,
    CASE p_type WHEN 'STANDARD' THEN 'tma' WHEN 'ECONOMY' THEN ' CMA' WHEN 'PROMO' THEN 'exam'
                WHEN 'LARGE' THEN 'TMA' WHEN 'SMALL' THEN 'Cma'
                ELSE CASE WHEN p_size > 40 THEN 'QUIZ' WHEN p_size > 35 THEN NULL
                          ELSE 'EXAM' END END AS assessment_type,
    CASE WHEN p_type = 'PROMO' THEN '?'
         WHEN p_type = 'MEDIUM' AND p_size <= 5 THEN NULL
         WHEN p_type = 'MEDIUM' THEN '?'
         WHEN p_type = 'SMALL' AND p_size = 7 THEN '12.5'
         WHEN p_type = 'SMALL' AND p_size = 8 THEN 'soon'
         ELSE CAST(p_size * 25 - 20 AS VARCHAR) END AS date,
    CASE WHEN p_type = 'SMALL' AND p_size = 9 THEN 'n/a'
         WHEN p_type = 'LARGE' AND p_size = 3 THEN NULL
         WHEN p_type = 'PROMO' THEN '100'
         ELSE CAST(CAST(floor(p_retailprice) AS BIGINT) - 895 AS VARCHAR) END AS weight
  FROM b_parts"""

CTES["b_vle"] = f"""
  SELECT id_site, code_module, code_presentation, activity_type, week_from, week_to,
         {T1} AS ingestion_timestamp, CAST({T1} AS DATE) AS ingestion_date FROM b_vle_base
  UNION ALL
  SELECT id_site, code_module, code_presentation, lower(activity_type), week_from, week_to,
         {T2}, CAST({T2} AS DATE) FROM b_vle_base WHERE brand > 12"""
CTES["b_vle_base"] = """
  SELECT CAST(p_partkey AS VARCHAR) AS id_site, code_module, code_presentation, brand,
    CASE WHEN p_type = 'PROMO' AND p_size > 48 THEN NULL ELSE ' ' || p_type END AS activity_type,
    CASE WHEN p_type IN ('STANDARD', 'LARGE') THEN '?' ELSE CAST(p_size AS VARCHAR) END AS week_from,
    CASE WHEN p_type IN ('STANDARD', 'LARGE') THEN '?'
         WHEN p_type = 'ECONOMY' AND p_size > 45 THEN 'x'
         WHEN p_type = 'SMALL' THEN CAST(p_size - 1 AS VARCHAR)
         ELSE CAST(p_size + 2 AS VARCHAR) END AS week_to
  FROM b_parts"""

CTES["b_student_info"] = """
  SELECT CASE WHEN o_orderstatus = 'P' THEN lower(o_orderpriority) ELSE o_orderpriority END
           AS code_module,
    CAST(year(o_orderdate) AS VARCHAR) || 'J' AS code_presentation,
    CAST(o_custkey AS VARCHAR) AS id_student,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'M' WHEN 'MACHINERY' THEN 'f' WHEN 'HOUSEHOLD' THEN 'F'
      WHEN 'AUTOMOBILE' THEN 'm' ELSE CASE WHEN c_acctbal < 0 THEN 'U' ELSE 'M' END END AS gender,
    n_name || ' ' AS region,
    c_mktsegment AS highest_education,
    CASE WHEN c_acctbal < 0 THEN '?'
         ELSE CAST(CAST(floor(c_acctbal / 1000) AS INT) * 10 AS VARCHAR) || '-' ||
              CAST(CAST(floor(c_acctbal / 1000) AS INT) * 10 + 10 AS VARCHAR) || '%' END AS imd_band,
    CASE WHEN n_regionkey <= 1 THEN '0-35' WHEN n_regionkey <= 3 THEN '35-55' ELSE '55<=' END
      AS age_band,
    CAST(CAST(floor(o_totalprice / 150000) AS BIGINT) AS VARCHAR) AS num_of_prev_attempts,
    CAST(CAST(floor(o_totalprice / 1500) AS BIGINT) AS VARCHAR) AS studied_credits,
    CASE WHEN n_regionkey = 2 THEN 'Y' WHEN n_regionkey = 3 THEN '?' WHEN c_acctbal > 9000 THEN NULL
         ELSE 'n' END AS disability,
    CASE WHEN o_orderstatus = 'F' THEN 'Withdrawn' WHEN o_orderstatus = 'P' THEN ' Fail '
         WHEN o_totalprice > 400000 THEN 'Distinction' ELSE 'Pass' END AS final_result,
    o_orderdate AS ingestion_timestamp, CAST(o_orderdate AS DATE) AS ingestion_date
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

CTES["b_student_registration"] = """
  SELECT CASE WHEN o_orderstatus = 'P' THEN lower(o_orderpriority) ELSE o_orderpriority END
           AS code_module,
    CAST(year(o_orderdate) AS VARCHAR) || 'J' AS code_presentation,
    CAST(o_custkey AS VARCHAR) AS id_student,
    CASE WHEN o_totalprice < 20000 THEN '?' WHEN o_totalprice < 25000 THEN NULL
         ELSE CAST(dayofyear(o_orderdate) - 200 AS VARCHAR) END AS date_registration,
    CASE WHEN o_orderstatus = 'F'
         THEN CAST(dayofyear(o_orderdate) - 200 + CAST(floor(o_totalprice / 2500) AS INT) - 10
                   AS VARCHAR) END AS date_unregistration,
    o_orderdate AS ingestion_timestamp, CAST(o_orderdate AS DATE) AS ingestion_date
  FROM orders"""

CTES["b_lines"] = """
  SELECT *, date_diff('day', o_orderdate, l_shipdate) AS day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTES["b_student_assessment"] = f"""
  SELECT id_assessment, id_student, date_submitted, is_banked, score,
         {T1} AS ingestion_timestamp, CAST({T1} AS DATE) AS ingestion_date
  FROM b_student_assessment_base
  UNION ALL
  SELECT id_assessment, id_student, date_submitted, is_banked, score, {T2}, CAST({T2} AS DATE)
  FROM b_student_assessment_base WHERE l_returnflag = 'R'"""
CTES["b_student_assessment_base"] = """
  SELECT CAST(l_partkey AS VARCHAR) AS id_assessment, l_returnflag,
    CASE WHEN l_linenumber = 7 AND l_tax = 0 THEN 'S' || CAST(o_custkey AS VARCHAR)
         ELSE CAST(o_custkey AS VARCHAR) END AS id_student,
    CAST(day AS VARCHAR) AS date_submitted,
    CASE WHEN l_tax = CAST(0.08 AS DOUBLE) THEN '2' WHEN l_tax = 0 AND l_returnflag = 'R' THEN NULL
         WHEN l_returnflag = 'A' THEN '1' ELSE '0' END AS is_banked,
    CASE WHEN l_discount = CAST(0.1 AS DOUBLE) THEN '?'
         WHEN l_discount = CAST(0.09 AS DOUBLE) THEN NULL
         WHEN l_discount = 0 THEN 'NaN'
         WHEN l_discount = CAST(0.08 AS DOUBLE) AND l_quantity > 48 THEN 'abc'
         WHEN l_quantity > 49 THEN '101'
         ELSE CAST(CAST(l_quantity AS INT) * 2 AS VARCHAR) END AS score
  FROM b_lines"""

CTES["b_student_vle"] = f"""
  SELECT lower(o_orderpriority) AS code_module,
    CAST(year(o_orderdate) AS VARCHAR) || 'J' AS code_presentation,
    CAST(o_custkey AS VARCHAR) AS id_student, CAST(l_partkey AS VARCHAR) AS id_site,
    CAST(day AS VARCHAR) AS date, CAST(CAST(l_quantity AS INT) - 1 AS VARCHAR) AS sum_click,
    {T1} AS ingestion_timestamp, CAST({T1} AS DATE) AS ingestion_date
  FROM b_lines"""

# --- silver ---------------------------------------------------------------------

CTES["s_courses"] = f"""
  SELECT code_module, code_presentation, len AS module_presentation_length,
         max(ingestion_timestamp) AS ingestion_timestamp, max(ingestion_date) AS ingestion_date
  FROM (SELECT {CODES}, CAST({as_int('module_presentation_length')} AS INT) AS len,
               ingestion_timestamp, ingestion_date FROM b_courses)
  WHERE code_module IS NOT NULL AND code_presentation IS NOT NULL AND len > 0
  GROUP BY ALL"""

CTES["s_vle"] = f"""
  SELECT site AS id_site, code_module, code_presentation, kind AS activity_type,
         first_week AS week_from, last_week AS week_to,
         max(ingestion_timestamp) AS ingestion_timestamp, max(ingestion_date) AS ingestion_date
  FROM (SELECT {as_int('id_site')} AS site, {CODES}, lower(trim(activity_type)) AS kind,
               CAST({as_int("nullif(week_from, '?')")} AS INT) AS first_week,
               CAST({as_int("nullif(week_to, '?')")} AS INT) AS last_week,
               ingestion_timestamp, ingestion_date FROM b_vle)
  WHERE site IS NOT NULL AND code_module IS NOT NULL AND code_presentation IS NOT NULL
    AND kind IS NOT NULL
  GROUP BY site, code_module, code_presentation, kind, first_week, last_week"""

CTES["p_assessments"] = f"""
  SELECT *, {as_int('id_assessment')} AS key_id, upper(trim(code_module)) AS m,
         upper(trim(code_presentation)) AS p, upper(trim(assessment_type)) AS kind,
         CAST({as_int('date')} AS INT) AS due, {as_double('weight')} AS points,
         concat_ws('|', coalesce(upper(trim(code_module)), '~'),
           coalesce(upper(trim(code_presentation)), '~'),
           coalesce(upper(trim(assessment_type)), '~'), coalesce(date, '~'),
           coalesce(weight, '~')) AS content
  FROM b_assessments"""
CTES["r_assessments"] = """
  SELECT *, row_number() OVER (PARTITION BY key_id
              ORDER BY ingestion_timestamp DESC, points DESC NULLS LAST, due DESC NULLS LAST,
                       m DESC NULLS LAST, p DESC NULLS LAST,
                       CASE kind WHEN 'EXAM' THEN 'Exam' WHEN 'QUIZ' THEN NULL ELSE kind END
                         DESC NULLS LAST, code_module DESC NULLS LAST,
                       code_presentation DESC NULLS LAST, id_assessment DESC NULLS LAST,
                       assessment_type DESC NULLS LAST, date DESC NULLS LAST,
                       weight DESC NULLS LAST) AS row_num,
         min(content) OVER (PARTITION BY key_id) <> max(content) OVER (PARTITION BY key_id)
           AS key_conflict
  FROM p_assessments"""
CTES["s_assessments"] = """
  SELECT key_id AS id_assessment, m AS code_module, p AS code_presentation,
         CASE kind WHEN 'EXAM' THEN 'Exam' ELSE kind END AS assessment_type,
         due AS date, date AS date_source, points AS weight, ingestion_timestamp,
         CAST(ingestion_timestamp AS DATE) AS ingestion_date
  FROM r_assessments
  WHERE row_num = 1 AND NOT key_conflict AND key_id > 0 AND m IS NOT NULL AND p IS NOT NULL
    AND kind IN ('TMA', 'CMA', 'EXAM') AND points BETWEEN 0 AND 100
    AND (due IS NULL OR due BETWEEN 0 AND 1000) AND ingestion_timestamp IS NOT NULL"""

CTES["p_student_assessment"] = f"""
  SELECT *, {as_int('id_assessment')} AS aid, {as_int('id_student')} AS sid,
         CAST({as_int('date_submitted')} AS INT) AS day, CAST({as_int('is_banked')} AS INT) AS banked,
         {as_double('score')} AS points,
         concat_ws('|', coalesce(date_submitted, '~'), coalesce(is_banked, '~'),
           coalesce(score, '~')) AS content
  FROM b_student_assessment"""
CTES["r_student_assessment"] = """
  SELECT *, row_number() OVER (PARTITION BY aid, sid
              ORDER BY ingestion_timestamp DESC, day DESC NULLS LAST, points DESC NULLS LAST,
                       banked DESC NULLS LAST, id_assessment DESC NULLS LAST,
                       id_student DESC NULLS LAST, date_submitted DESC NULLS LAST,
                       is_banked DESC NULLS LAST, score DESC NULLS LAST) AS row_num,
         min(content) OVER (PARTITION BY aid, sid) <> max(content) OVER (PARTITION BY aid, sid)
           AS key_conflict
  FROM p_student_assessment"""
CTES["s_student_assessment"] = """
  SELECT aid AS id_assessment, sid AS id_student, day AS date_submitted, banked AS is_banked,
         points AS score, score AS score_source, ingestion_timestamp,
         CAST(ingestion_timestamp AS DATE) AS ingestion_date
  FROM r_student_assessment
  WHERE row_num = 1 AND NOT key_conflict AND aid > 0 AND sid > 0
    AND day BETWEEN -365 AND 1825 AND banked IN (0, 1)
    AND (points IS NULL OR (NOT isnan(points) AND points BETWEEN 0 AND 100))
    AND ingestion_timestamp IS NOT NULL"""

CTES["s_student_info"] = f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY code_module, code_presentation, id_student
        ORDER BY ingestion_timestamp DESC, gender DESC, region DESC, highest_education DESC,
          imd_band DESC, age_band DESC, num_of_prev_attempts DESC, studied_credits DESC,
          disability DESC NULLS LAST, final_result DESC) AS rn
    FROM (
      SELECT {CODES}, {as_int('id_student')} AS id_student, upper(trim(gender)) AS gender,
        trim(region) AS region, trim(highest_education) AS highest_education,
        trim(imd_band) AS imd_band, trim(age_band) AS age_band,
        CAST({as_int('num_of_prev_attempts')} AS INT) AS num_of_prev_attempts,
        CAST({as_int('studied_credits')} AS INT) AS studied_credits,
        CASE upper(trim(disability)) WHEN 'Y' THEN TRUE WHEN 'N' THEN FALSE END AS disability,
        trim(final_result) AS final_result, ingestion_timestamp,
        CAST(ingestion_timestamp AS DATE) AS ingestion_date
      FROM b_student_info
      WHERE code_module IS NOT NULL AND code_presentation IS NOT NULL
        AND {as_int('id_student')} IS NOT NULL AND gender IN ('M', 'F', 'm', 'f')
        AND region IS NOT NULL AND highest_education IS NOT NULL AND imd_band IS NOT NULL
        AND age_band IS NOT NULL AND {as_int('num_of_prev_attempts')} >= 0
        AND {as_int('studied_credits')} > 0 AND disability IS NOT NULL
        AND final_result IS NOT NULL AND ingestion_timestamp IS NOT NULL))
  WHERE rn = 1"""

CTES["s_student_registration"] = f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY code_module, code_presentation, id_student
        ORDER BY ingestion_timestamp DESC, date_registration DESC NULLS LAST,
                 date_unregistration DESC NULLS LAST) AS rn
    FROM (
      SELECT {CODES}, {as_int('id_student')} AS id_student,
        CAST({as_int('b.date_registration')} AS INT) AS date_registration,
        CAST({as_int('b.date_unregistration')} AS INT) AS date_unregistration,
        ingestion_timestamp, CAST(ingestion_timestamp AS DATE) AS ingestion_date
      FROM b_student_registration b
      WHERE code_module IS NOT NULL AND code_presentation IS NOT NULL
        AND {as_int('id_student')} IS NOT NULL AND b.date_registration IS NOT NULL
        AND ingestion_timestamp IS NOT NULL))
  WHERE rn = 1"""

CTES["s_student_vle"] = f"""
  SELECT code_module, code_presentation, sid AS id_student, site AS id_site, day AS date,
         {big('sum(clicks)')} AS sum_click, max(ingestion_timestamp) AS ingestion_timestamp,
         CAST(max(ingestion_timestamp) AS DATE) AS ingestion_date
  FROM (SELECT {CODES}, {as_int('id_student')} AS sid, {as_int('id_site')} AS site,
               CAST({as_int('date')} AS INT) AS day, {as_int('sum_click')} AS clicks,
               ingestion_timestamp FROM b_student_vle)
  WHERE code_module IS NOT NULL AND code_presentation IS NOT NULL AND sid IS NOT NULL
    AND site IS NOT NULL AND day IS NOT NULL AND clicks > 0 AND ingestion_timestamp IS NOT NULL
  GROUP BY code_module, code_presentation, sid, site, day"""

# --- gold -------------------------------------------------------------------------


def week(day: str) -> str:
    return (
        f"CAST(CASE WHEN {day} >= 0 THEN ceil({day} / 7.0) ELSE floor({day} / 7.0) END AS INT)"
    )


COURSE_ID = "code_module || '_' || code_presentation"

CTES["g_course"] = f"""
  SELECT DISTINCT {COURSE_ID} AS course_id, code_module, code_presentation,
         module_presentation_length FROM s_courses"""
CTES["g_vle"] = """
  SELECT DISTINCT id_site AS vle_id, activity_type, week_from, week_to FROM s_vle"""
CTES["g_assessment"] = f"""
  SELECT id_assessment AS assessment_key, {COURSE_ID} AS course_id, assessment_type,
         date AS assessment_day_offset, weight FROM s_assessments"""
CTES["g_phase"] = """
  SELECT * FROM (VALUES (1, 'Early'), (2, 'Middle'), (3, 'Late')) v(phase_id, phase_name)"""
CTES["g_week"] = f"""
  SELECT course_id, w AS week_id, w AS week_number,
         CASE WHEN w <= 10 THEN 1 WHEN w <= 20 THEN 2 ELSE 3 END AS phase_id
  FROM (SELECT DISTINCT {COURSE_ID} AS course_id FROM s_courses)
  CROSS JOIN (SELECT CAST(range AS INT) AS w FROM range(-25, 76))"""
CTES["g_student"] = """
  SELECT * EXCLUDE (rn) FROM (
    SELECT id_student AS student_id, gender, region, highest_education, imd_band, age_band,
           CAST(disability AS VARCHAR) AS disability, ingestion_timestamp,
           row_number() OVER (PARTITION BY id_student ORDER BY ingestion_timestamp DESC,
             gender DESC, region DESC, highest_education DESC, imd_band DESC, age_band DESC,
             disability DESC NULLS LAST) AS rn
    FROM s_student_info WHERE id_student IS NOT NULL)
  WHERE rn = 1"""
CTES["g_enrollment"] = f"""
  SELECT CAST(i.id_student AS VARCHAR) || '_' || i.code_module || '_' || i.code_presentation
           AS student_enrollment_id,
         i.id_student AS student_id, i.code_module || '_' || i.code_presentation AS course_id,
         i.num_of_prev_attempts, i.studied_credits, trim(i.final_result) AS final_result,
         r.date_registration, r.date_unregistration,
         greatest(i.ingestion_timestamp, r.ingestion_timestamp) AS ingestion_timestamp
  FROM s_student_info i JOIN s_student_registration r
    USING (code_module, code_presentation, id_student)"""
CTES["g_student_info"] = """
  SELECT CAST(i.id_student AS VARCHAR) || '_' || i.code_module || '_' || i.code_presentation
           AS student_course_key,
         i.id_student, i.code_module, i.code_presentation, i.gender, i.region,
         i.highest_education, i.imd_band, i.age_band, i.num_of_prev_attempts, i.studied_credits,
         i.disability, i.final_result, r.date_registration, r.date_unregistration,
         r.date_unregistration IS NOT NULL AS is_unregistered,
         greatest(i.ingestion_timestamp, r.ingestion_timestamp) AS last_updated_timestamp,
         TIMESTAMP '2024-01-10 00:00:00' AS dimension_created_at
  FROM s_student_info i JOIN s_student_registration r
    USING (code_module, code_presentation, id_student)"""
CTES["g_engagement"] = f"""
  SELECT e.student_enrollment_id, v.vle_id, c.course_id, s.date AS interaction_date, w.week_id,
         {big('sum(s.sum_click)')} AS sum_click
  FROM s_student_vle s
  LEFT JOIN g_course c USING (code_module, code_presentation)
  LEFT JOIN g_enrollment e ON s.id_student = e.student_id AND c.course_id = e.course_id
  LEFT JOIN g_vle v ON s.id_site = v.vle_id
  LEFT JOIN g_week w ON c.course_id = w.course_id AND w.week_id = {week('s.date')}
  GROUP BY ALL"""
CTES["g_performance"] = f"""
  SELECT sp.id_student, e.student_enrollment_id, d.assessment_key, c.course_id, w.week_id,
         d.assessment_day_offset AS assessment_date, sp.date_submitted AS submission_day_offset,
         sp.is_banked, sp.score, sp.date_submitted - d.assessment_day_offset AS days_late,
         sp.score IS NULL AS is_non_submission, sp.score * d.weight / 100.0 AS weighted_score
  FROM s_student_assessment sp
  JOIN s_assessments a ON sp.id_assessment = a.id_assessment
  JOIN g_assessment d ON sp.id_assessment = d.assessment_key
  JOIN g_course c ON a.code_module = c.code_module AND a.code_presentation = c.code_presentation
  LEFT JOIN g_enrollment e ON sp.id_student = e.student_id AND c.course_id = e.course_id
  LEFT JOIN g_week w ON c.course_id = w.course_id AND w.week_id = {week('sp.date_submitted')}"""
CTES["g_activity"] = f"""
  SELECT coalesce(e.id, p.id) AS student_enrollment_id,
         coalesce(total_clicks, 0) AS total_clicks, coalesce(active_days, 0) AS active_days,
         avg_score, total_weighted_score, assessment_count
  FROM (SELECT student_enrollment_id AS id, {big('sum(sum_click)')} AS total_clicks,
               count(DISTINCT interaction_date) AS active_days
        FROM g_engagement GROUP BY 1) e
  FULL OUTER JOIN (SELECT student_enrollment_id AS id, avg(score) AS avg_score,
               sum(weighted_score) AS total_weighted_score, count(*) AS assessment_count
        FROM g_performance GROUP BY 1) p ON e.id = p.id"""
CTES["g_people"] = """
  SELECT e.*, s.gender, s.region, s.highest_education, s.imd_band, s.age_band, s.disability,
         CASE WHEN upper(trim(e.final_result)) = 'WITHDRAWN' THEN 1 ELSE 0 END AS is_withdrawn
  FROM g_enrollment e JOIN g_student s USING (student_id)"""


def needed(sql: str) -> list[str]:
    """Names of the subqueries a text uses, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"\b{name}\b", text):
                visit_name(name)

    def visit_name(name: str) -> None:
        text = CTES[name]
        for other in CTES:
            if other != name and other not in order and re.search(rf"\b{other}\b", text):
                visit_name(other)
        if name not in order:
            order.append(name)

    visit(sql)
    return order


def with_(sql: str, **extra: str) -> str:
    """``sql`` behind the subqueries it uses; ``extra`` are further ones, in order."""
    text = " ".join([*extra.values(), sql])
    parts = [f"{name} AS ({CTES[name]})" for name in needed(text)]
    parts += [f"{name} AS ({body})" for name, body in extra.items()]
    return f"WITH {', '.join(parts)}\n{sql}" if parts else sql
