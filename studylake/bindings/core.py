"""Queries over the operators, each with the SQL it is compared with."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studylake.bindings import ctes as q
from studylake.bindings.learning import AS_OF, Learning
from studylake.bindings.registry import query
from studylake.functions import columns as fx
from studylake.operators import aggregates, copies, joins, ranking, upsert
from studylake.plans import analytics, silver
from studylake.quality import audit
from studylake.session import scratch_folder
from studylake.sources import raw, tables

LINE = ["l_orderkey", "l_linenumber"]
LINE_REST = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus",
]


def _as_of():
    return F.lit(AS_OF).cast("date")


# --- copies, positions, upsert -----------------------------------------------------

@query("dedup_latest", f"""
SELECT {', '.join(LINE + LINE_REST)} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {', '.join(c + ' DESC' for c in LINE_REST)}) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_latest(t: Learning) -> DataFrame:
    lines = t.table("lineitem").select(*LINE, *LINE_REST)
    return copies.latest_per_key(lines, LINE, ["l_shipdate"])


_CONTENT = "concat_ws('|', " + ", ".join(
    f"CAST({c} AS VARCHAR)" for c in ("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
) + ")"


@query("dedup_refuse_conflicts", f"""
WITH loads AS (
  SELECT *, 1 AS load FROM lineitem UNION ALL SELECT *, 2 FROM lineitem WHERE l_linestatus = 'F'),
marked AS (
  SELECT *, {_CONTENT} AS content FROM loads),
agreeing AS (
  SELECT l_orderkey, l_linenumber FROM marked GROUP BY 1, 2
  HAVING min(content) = max(content)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
     ORDER BY load DESC, l_shipdate DESC, l_quantity DESC) AS rn
  FROM marked SEMI JOIN agreeing USING (l_orderkey, l_linenumber))
SELECT l_orderkey, l_linenumber, load, l_shipdate, l_quantity, l_partkey, l_suppkey,
       l_returnflag, l_linestatus
FROM ranked WHERE rn = 1""")
def dedup_refuse_conflicts(t: Learning) -> DataFrame:
    lines = t.table("lineitem")
    resent = lines.filter(F.col("l_linestatus") == "F").withColumn("load", F.lit(2))
    loads = lines.withColumn("load", F.lit(1)).unionByName(resent)
    content = ["l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"]
    return copies.keep_agreeing_latest(
        loads, LINE, ["load", "l_shipdate", "l_quantity"],
        fx.fingerprint([F.col(c) for c in content]),
        [*LINE, "load", "l_shipdate", "l_quantity", *content],
    )


def _resent(t: Learning) -> DataFrame:
    """All orders, and the finished ones of 1997 a second time, a day later and at a round price."""
    orders = t.table("orders").select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    late = (F.col("o_orderstatus") == "F") & (F.year("o_orderdate") == 1997)
    again = orders.filter(late).withColumns({
        "o_orderdate": F.expr("o_orderdate + INTERVAL 1 DAY").cast(orders.schema["o_orderdate"].dataType),
        "o_totalprice": F.floor("o_totalprice").cast("double")})
    return orders.unionByName(again)


_RESENT = """
WITH loads AS (
  SELECT o_orderkey, o_orderdate, o_totalprice, o_orderstatus FROM orders UNION ALL
  SELECT o_orderkey, o_orderdate + INTERVAL 1 DAY, floor(o_totalprice), o_orderstatus FROM orders
  WHERE o_orderstatus = 'F' AND year(o_orderdate) = 1997),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey
    ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderstatus DESC) AS rn,
    count(DISTINCT o_totalprice) OVER (PARTITION BY o_orderkey) AS contents FROM loads)
SELECT o_orderkey, o_orderdate, o_totalprice, o_orderstatus FROM ranked WHERE rn = 1"""


@query("dedup_few_copies", _RESENT)
def dedup_few_copies(t: Learning) -> DataFrame:
    return copies.latest_by_key_facts(_resent(t), ["o_orderkey"], ["o_orderdate"])


@query("dedup_few_conflicts", _RESENT + " AND contents = 1")
def dedup_few_conflicts(t: Learning) -> DataFrame:
    return copies.agreeing_by_key_facts(
        _resent(t), ["o_orderkey"], ["o_orderdate"], fx.fingerprint([F.col("o_totalprice")]))


@query("key_occurrences", """
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
       count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS key_occurrences FROM lineitem""")
def key_occurrences(t: Learning) -> DataFrame:
    lines = t.table("lineitem").select(*LINE, "l_partkey", "l_shipdate")
    return copies.with_key_occurrences(lines, LINE)


@query("number_copies", f"""
SELECT {', '.join(LINE + LINE_REST)}, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {', '.join(c + ' DESC' for c in LINE_REST)}) AS row_num FROM lineitem""")
def number_copies(t: Learning) -> DataFrame:
    lines = t.table("lineitem").select(*LINE, *LINE_REST)
    return copies.number_copies(lines, LINE, ["l_shipdate"])


@query("ntile_distributed", """
SELECT o_orderkey, o_totalprice,
       CAST(ntile(4) OVER (ORDER BY o_totalprice, o_orderkey) AS INT) AS quartile FROM orders""")
def ntile_distributed(t: Learning) -> DataFrame:
    orders = t.table("orders").select("o_orderkey", "o_totalprice")
    return ranking.with_ntile_by_selection(orders, 4, ["o_totalprice", "o_orderkey"], "quartile")


@query("ntile_dominant_value", """
SELECT l_orderkey, l_linenumber, least(l_quantity, 30) AS units,
       CAST(ntile(7) OVER (ORDER BY least(l_quantity, 30), l_shipdate, l_orderkey, l_linenumber) AS INT) AS part
FROM lineitem""")
def ntile_dominant_value(t: Learning) -> DataFrame:
    """Two rows in five have one value, so most buckets begin inside it."""
    lines = t.table("lineitem").select(
        "l_orderkey", "l_linenumber", F.least("l_quantity", F.lit(30.0)).alias("units"), "l_shipdate")
    order = ["units", "l_shipdate", "l_orderkey", "l_linenumber"]
    return ranking.with_ntile_by_selection(lines, 7, order, "part").drop("l_shipdate")


def _order_versions(t: Learning) -> tuple[DataFrame, DataFrame]:
    orders = t.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    target = orders.filter(F.col("o_orderstatus") != "P")
    batch = orders.filter(F.col("o_orderstatus") != "O").withColumns({
        "o_totalprice": F.col("o_totalprice") + 1, "o_custkey": F.col("o_custkey") + 1,
    })
    return target, batch


_MERGED = """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN {cust} ELSE o_custkey END AS o_custkey,
       o_orderstatus,
       CASE WHEN o_orderstatus <> 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM orders"""


@query("upsert_merge", _MERGED.format(cust="o_custkey + 1"))
def upsert_merge(t: Learning) -> DataFrame:
    target, batch = _order_versions(t)
    return upsert.merge_upsert(target, batch, ["o_orderkey"])


@query("upsert_idempotent", _MERGED.format(cust="o_custkey + 1"))
def upsert_idempotent(t: Learning) -> DataFrame:
    target, batch = _order_versions(t)
    once = upsert.merge_upsert(target, batch, ["o_orderkey"])
    return upsert.merge_upsert(once, batch, ["o_orderkey"])


@query("upsert_some_columns", _MERGED.format(
    cust="CASE WHEN o_orderstatus = 'P' THEN o_custkey + 1 ELSE o_custkey END"))
def upsert_some_columns(t: Learning) -> DataFrame:
    target, batch = _order_versions(t)
    return upsert.merge_upsert(target, batch, ["o_orderkey"], ["o_totalprice", "o_orderstatus"])


@query("upsert_partitions", _MERGED.format(cust="o_custkey + 1"))
def upsert_partitions(t: Learning) -> DataFrame:
    """A stored table, of which a batch rewrites only the parts that hold its keys."""
    target, batch = _order_versions(t)
    path = f"{scratch_folder(t.spark)}/{uuid.uuid4().hex}"
    by = upsert.key_range(F.col("o_orderkey"), 10_000)
    for rows in (target, batch):
        upsert.upsert_partitions(rows, path, ["o_orderkey"], by)
    return upsert.read_partitions(t.spark, path, target.schema)


# --- sources and sinks ---------------------------------------------------------------

@query("bronze_stamp", """
SELECT *, TIMESTAMP '2024-01-10 00:00:00' AS ingestion_timestamp,
       DATE '2024-01-10' AS ingestion_date FROM orders""")
def bronze_stamp(t: Learning) -> DataFrame:
    return tables.ingest_bronze(t.table("orders"), _as_of())


@query("overwrite_distinct", """
SELECT DISTINCT p_brand AS brand, p_type AS kind, p_size AS size FROM part""")
def overwrite_distinct(t: Learning) -> DataFrame:
    rows = aggregates.distinct_rows(t.table("part"), "p_brand", "p_type", "p_size")
    return tables.to_schema(
        rows.toDF("brand", "kind", "size"), "brand varchar(10), kind varchar(25), size int"
    )


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _count_sql(day: str) -> str:
    return " UNION ALL ".join(
        f"SELECT DATE '{day}' AS LoadDate, '{n}' AS source_file, count(*) AS row_count, "
        f"TIMESTAMP '2024-01-10 00:00:00' AS EntryTime FROM {n}" for n in TABLES
    )


def _counts(t: Learning, day: str) -> DataFrame:
    opened = {n: t.table(n) for n in TABLES}
    return raw.table_row_counts(opened, F.lit(day), _as_of())


@query("source_counts", _count_sql("2024-01-09"))
def source_counts(t: Learning) -> DataFrame:
    return raw.table_row_counts({n: t.table(n) for n in TABLES}, raw.load_date(_as_of()), _as_of())


@query("audit_upsert", f"{_count_sql('2024-01-08')} UNION ALL {_count_sql('2024-01-09')}")
def audit_upsert(t: Learning) -> DataFrame:
    trail = audit.record_audit(None, _counts(t, "2024-01-08"))
    for day in ("2024-01-09", "2024-01-09"):
        trail = audit.record_audit(trail, _counts(t, day))
    return audit.audit_report(trail)


@query("semantic_count", q.with_("""
SELECT final_result, course_id, count(*) AS count FROM g_enrollment GROUP BY 1, 2"""))
def semantic_count(t: Learning) -> DataFrame:
    return aggregates.measure_count(t.gold["dim_student_enrollment"], "final_result", "course_id")


# --- expressions ------------------------------------------------------------------------

@query("week_of_offset", f"""
SELECT CAST(day AS INT) AS day, {q.week('day')} AS week,
       CASE WHEN {q.week('day')} <= 10 THEN 1 WHEN {q.week('day')} <= 20 THEN 2 ELSE 3 END AS phase,
       count(*) AS line_count
FROM (SELECT date_diff('day', o_orderdate, l_shipdate) AS day
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY 1, 2, 3""")
def week_of_offset(t: Learning) -> DataFrame:
    per_day = t._lines().groupBy("day").agg(F.count(F.lit(1)).alias("line_count"))
    week = fx.week_of(F.col("day"))
    return per_day.select("day", week.alias("week"), fx.phase_of(week).alias("phase"), "line_count")


@query("day_arithmetic", """
SELECT o_orderkey, day, DATE '1970-01-01' + day AS as_date,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2024-01-10') AS INT) AS age_days,
       DATE '1970-01-01' + day > DATE '2024-01-10' AS in_future
FROM (SELECT *, CAST(floor(o_totalprice / 10) AS INT) - 20000 AS day FROM orders)""")
def day_arithmetic(t: Learning) -> DataFrame:
    day = F.floor(F.col("o_totalprice") / 10).cast("int") - 20000
    return t.table("orders").select(
        "o_orderkey", day.alias("day"), fx.offset_date(day).alias("as_date"),
        fx.age_days(F.to_date("o_orderdate"), _as_of()).alias("age_days"),
        (fx.offset_date(day) > _as_of()).alias("in_future"),
    )


@query("text_clean_parse", rf"""
SELECT 'document' AS kind, doc_id AS id, md5(cleaned) AS digest, length(cleaned) AS chars,
       CAST(NULL AS INT) AS parsed
FROM (SELECT doc_id, nullif(regexp_replace(text, '^\s+|\s+$', '', 'g'), '') AS cleaned FROM documents)
UNION ALL
SELECT 'event', event_id, md5(cleaned), length(cleaned), CAST({q.as_int('cleaned')} AS INT)
FROM (SELECT event_id, nullif(regexp_replace(
        regexp_replace(props, '[^0-9 ]', '', 'g'), '^\s+|\s+$', '', 'g'), '') AS cleaned FROM events)""")
def text_clean_parse(t: Learning) -> DataFrame:
    def parsed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("cleaned", fx.clean_text(F.col("body"))).select(
            "kind", "id", F.md5("cleaned").alias("digest"), F.length("cleaned").cast("bigint")
            .alias("chars"),
            F.when(F.col("kind") == "event", F.col("cleaned").try_cast("int")).alias("parsed"),
        )

    documents = t.table("documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("body")
    )
    events = t.table("events").select(
        F.lit("event").alias("kind"), F.col("event_id").alias("id"),
        F.regexp_replace("props", "[^0-9 ]", "").alias("body"),
    )
    return parsed(documents).unionByName(parsed(events))


@query("hash_surrogate_key", """
SELECT o_custkey, o_orderpriority, o_orderdate, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_keys,
       CAST(1 AS BIGINT) AS n_holders, CAST(0 AS BIGINT) AS null_keys
FROM orders GROUP BY 1, 2, 3""")
def hash_surrogate_key(t: Learning) -> DataFrame:
    """Per distinct parts: rows, their keys, the parts that hold that key, rows without a key."""
    parts = ["o_custkey", "o_orderpriority", "o_orderdate"]
    keyed = t.table("orders").select(*parts, fx.surrogate_key(*map(F.col, parts)).alias("key"))
    holders = keyed.distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n_holders"))
    per_parts = keyed.groupBy(*parts).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("key").alias("n_keys"),
        F.count_if(F.col("key").isNull()).alias("null_keys"), F.max("key").alias("key"))
    return per_parts.join(holders, "key").select(*parts, "n_rows", "n_keys", "n_holders", "null_keys")


# --- silver -------------------------------------------------------------------------------

def _register_silver() -> None:
    names = {
        "clean_spec_courses": "courses", "clean_spec_resources": "vle",
        "clean_spec_assessments": "assessments", "clean_spec_people": "student_info",
        "clean_spec_registration": "student_registration",
        "clean_spec_submissions": "student_assessment", "clean_spec_clicks": "student_vle",
    }
    for name, table in names.items():
        query(name, q.with_(f"SELECT * FROM s_{table}"))(
            lambda t, table=table: t.silver[table]
        )


_register_silver()


@query("daily_visit_sum", f"""
SELECT user_id, event_type, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS date,
       {q.big('sum(ceil(value))')} AS clicks, max(ts) AS ingestion_timestamp,
       CAST(max(ts) AS DATE) AS ingestion_date
FROM events GROUP BY 1, 2, 3""")
def daily_visit_sum(t: Learning) -> DataFrame:
    visits = t.table("events").select(
        "user_id", "event_type",
        F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).cast("bigint").alias("date"),
        F.ceil("value").alias("clicks"), F.col("ts").alias("ingestion_timestamp"),
    )
    return silver.daily_totals(visits, ["user_id", "event_type", "date"], "clicks")


# --- gold ------------------------------------------------------------------------------------

@query("dim_course", q.with_("SELECT * FROM g_course"))
def dim_course(t: Learning) -> DataFrame:
    return t.gold["dim_course"]


@query("dim_resource", q.with_("SELECT * FROM g_vle"))
def dim_resource(t: Learning) -> DataFrame:
    return t.gold["dim_vle"]


@query("dim_week_spine", q.with_("""
SELECT course_id, week_id, week_number, phase_id, phase_name FROM g_week JOIN g_phase USING (phase_id)"""))
def dim_week_spine(t: Learning) -> DataFrame:
    phases = t.gold["dim_course_phase"]  # three fixed rows
    return t.gold["dim_course_week"].join(F.broadcast(phases), "phase_id").select(
        "course_id", "week_id", "week_number", "phase_id", "phase_name"
    )


@query("dim_assessment_keys", q.with_("SELECT * FROM g_assessment"))
def dim_assessment_keys(t: Learning) -> DataFrame:
    return t.gold["dim_assessment"]


@query("dim_student_latest", q.with_("SELECT * FROM g_student"))
def dim_student_latest(t: Learning) -> DataFrame:
    return t.gold["dim_student"]


@query("dim_enrollment", q.with_("SELECT * FROM g_enrollment"))
def dim_enrollment(t: Learning) -> DataFrame:
    return t.gold["dim_student_enrollment"]


@query("dim_student_wide", q.with_("SELECT * FROM g_student_info"))
def dim_student_wide(t: Learning) -> DataFrame:
    return t.gold["dim_student_info"].withColumn(
        "dimension_created_at", _as_of().cast("timestamp")
    )


@query("fact_engagement", q.with_("SELECT * FROM g_engagement"))
def fact_engagement(t: Learning) -> DataFrame:
    return t.gold["fact_student_engagement"].drop("engagement_id")


@query("fact_performance", q.with_("SELECT * EXCLUDE (id_student) FROM g_performance"))
def fact_performance(t: Learning) -> DataFrame:
    return t.gold["fact_student_performance"].drop("student_performance_key")


def _key_report(fact: DataFrame, key: str, parts: list[str]) -> DataFrame:
    """Rows, distinct keys and distinct parts of a fact, and keys that several parts share."""
    pairs = fact.groupBy(key, *parts).agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(key).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("holders")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(key).alias("n_keys"),
        F.coalesce(F.sum("holders"), F.lit(0)).alias("n_parts"),
        F.count_if(F.col("holders") > 1).alias("shared_keys"),
        F.count_if(F.col(key).isNull()).alias("null_keys"))


def _key_sql(source: str, parts: str) -> str:
    return q.with_(f"""
SELECT {q.big('sum(n)')} AS n_rows, count(*) AS n_keys, count(*) AS n_parts,
       CAST(0 AS BIGINT) AS shared_keys, CAST(0 AS BIGINT) AS null_keys
FROM (SELECT {parts}, count(*) AS n FROM {source} GROUP BY ALL)""")


@query("fact_engagement_keys", _key_sql(
    "g_engagement", "student_enrollment_id, vle_id, interaction_date"))
def fact_engagement_keys(t: Learning) -> DataFrame:
    return _key_report(t.gold["fact_student_engagement"], "engagement_id",
                       ["student_enrollment_id", "vle_id", "interaction_date"])


@query("fact_performance_keys", _key_sql("s_student_assessment SEMI JOIN g_performance p "
       "ON s_student_assessment.id_student = p.id_student "
       "AND s_student_assessment.id_assessment = p.assessment_key", "id_student, id_assessment"))
def fact_performance_keys(t: Learning) -> DataFrame:
    """The key stands for one submission: student and assessment of a fact row give it again."""
    fact = t.gold["fact_student_performance"].select("student_performance_key", "assessment_key")
    submitted = t.silver["student_assessment"].select(
        "id_student", "id_assessment",
        fx.surrogate_key(F.col("id_student"), F.col("id_assessment")).alias("_key"))
    linked = fact.join(submitted, (F.col("student_performance_key") == F.col("_key"))
                       & (F.col("assessment_key") == F.col("id_assessment")))
    return _key_report(linked, "student_performance_key", ["id_student", "id_assessment"])


@query("semi_join_orphan_rule", q.with_("""
SELECT * FROM s_assessments a WHERE EXISTS (
  SELECT 1 FROM s_courses c
  WHERE c.code_module = a.code_module AND c.code_presentation = a.code_presentation)"""))
def semi_join_orphan_rule(t: Learning) -> DataFrame:
    return joins.with_parent(
        t.silver["assessments"], t.silver["courses"], ["code_module", "code_presentation"]
    )


@query("orphan_rows", """
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')""")
def orphan_rows(t: Learning) -> DataFrame:
    parents = t.table("orders").filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("l_orderkey")
    )
    lines = t.table("lineitem").select(*LINE, "l_partkey", "l_shipdate")
    return joins.orphans(lines, parents, ["l_orderkey"]).select(lines.columns)


# --- analytics ---------------------------------------------------------------------------------

def _withdrawal_sql(by: str, having: str = "") -> str:
    return q.with_(f"""
SELECT {by}, count(student_enrollment_id) AS total_enrollments,
       {q.big('sum(is_withdrawn)')} AS total_withdrawals,
       {q.pct('sum(is_withdrawn)', 'count(*)')} AS withdrawal_rate_pct
FROM g_people GROUP BY ALL {having}""")


@query("withdrawal_by_demographics", _withdrawal_sql(
    "highest_education, age_band, imd_band, disability", "HAVING count(*) >= 50"))
def withdrawal_by_demographics(t: Learning) -> DataFrame:
    return analytics.withdrawal_by_demographics(
        t.gold["dim_student_enrollment"], t.gold["dim_student"]
    )


@query("withdrawal_by_education_and_age", _withdrawal_sql(
    "highest_education, age_band", "HAVING count(*) >= 50"))
def withdrawal_by_education_and_age(t: Learning) -> DataFrame:
    return analytics.withdrawal_by_demographics(
        t.gold["dim_student_enrollment"], t.gold["dim_student"],
        by=("highest_education", "age_band"),
    )


@query("withdrawal_by_history", _withdrawal_sql(
    "num_of_prev_attempts, CASE WHEN studied_credits < 60 THEN '< 60 Credits' "
    "WHEN studied_credits <= 120 THEN '60-120 Credits' ELSE '> 120 Credits' END "
    "AS credit_load_band"))
def withdrawal_by_history(t: Learning) -> DataFrame:
    return analytics.withdrawal_by_history(
        t.gold["dim_student_enrollment"], t.gold["dim_student"]
    )


def _facts(t: Learning) -> tuple[DataFrame, DataFrame]:
    return t.gold["fact_student_engagement"], t.gold["fact_student_performance"]


def _enrolled(t: Learning, *columns: str) -> DataFrame:
    """Enrollment ids and ``columns``, stored for queries that meet them more than once; the courses too."""
    t.store("silver", "courses")
    ids = ("student_enrollment_id", "student_id", "course_id")
    return t.store("gold", "dim_student_enrollment", *ids, *columns)


@query("engagement_performance", q.with_(f"""
SELECT student_enrollment_id, total_clicks, active_days, {q.rnd('avg_score', 4)} AS avg_score,
       {q.rnd('total_weighted_score', 4)} AS total_weighted_score, assessment_count,
       CAST(ntile(4) OVER (ORDER BY total_clicks, student_enrollment_id NULLS FIRST,
            assessment_count NULLS FIRST) AS INT) AS engagement_quartile
FROM g_activity"""))
def engagement_performance(t: Learning) -> DataFrame:
    _enrolled(t)
    return analytics.engagement_performance(*_facts(t)).withColumns({
        "avg_score": F.round("avg_score", 4),
        "total_weighted_score": F.round("total_weighted_score", 4),
    })


@query("profile_enrollment", q.with_(f"""
SELECT count(*) AS rows, count(DISTINCT student_enrollment_id) AS distinct_keys,
       count(date_unregistration) AS withdrew, min(date_registration) AS min_reg,
       max(date_registration) AS max_reg FROM g_enrollment"""))
def profile_enrollment(t: Learning) -> DataFrame:
    return analytics.profile_enrollment(t.gold["dim_student_enrollment"])


@query("profile_student_info", q.with_("""
SELECT count(*) AS total_records, count(DISTINCT id_student) AS unique_students,
       count(DISTINCT code_module) AS unique_courses,
       count(DISTINCT code_module || code_presentation) AS unique_presentations,
       CAST(count_if(is_unregistered) AS BIGINT) AS unregistered_count,
       count(DISTINCT gender) AS gender_categories, count(DISTINCT region) AS regions
FROM g_student_info"""))
def profile_student_info(t: Learning) -> DataFrame:
    return analytics.profile_student_info(t.gold["dim_student_info"])


@query("q1_correlation", q.with_(f"""
SELECT count(*) AS enrollments, {q.rnd('corr(total_clicks, avg_score)', 6)} AS clicks_vs_score,
       {q.rnd('corr(active_days, avg_score)', 6)} AS days_vs_score
FROM g_activity WHERE student_enrollment_id IS NOT NULL AND avg_score IS NOT NULL"""))
def q1_correlation(t: Learning) -> DataFrame:
    _enrolled(t)
    return analytics.activity_score_correlation(*_facts(t)).withColumns({
        c: F.round(c, 6) for c in ("clicks_vs_score", "days_vs_score")
    })


def _by_result_sql(source: str) -> str:
    return q.with_(f"""
SELECT final_result, count(*) AS enrollments, {q.big('sum(coalesce(clicks, 0))')} AS total_clicks,
       {q.rnd('avg(coalesce(clicks, 0))', 4)} AS avg_clicks,
       {q.rnd('avg(coalesce(days, 0))', 4)} AS avg_active_days,
       {q.big('max(coalesce(clicks, 0))')} AS max_clicks
FROM g_enrollment LEFT JOIN (
  SELECT student_enrollment_id, sum(sum_click) AS clicks,
         count(DISTINCT interaction_date) AS days
  FROM {source} GROUP BY 1) USING (student_enrollment_id)
GROUP BY 1""")


@query("q2_engagement_by_result", _by_result_sql("g_engagement"))
def q2_engagement_by_result(t: Learning) -> DataFrame:
    enrolled = _enrolled(t, "final_result")
    return analytics.engagement_by_result(_facts(t)[0], enrolled)


@query("q3_early_indicators", _by_result_sql("(SELECT * FROM g_engagement WHERE week_id <= 4)"))
def q3_early_indicators(t: Learning) -> DataFrame:
    enrolled = _enrolled(t, "final_result")
    return analytics.early_engagement_by_result(_facts(t)[0], enrolled)


@query("q4_withdrawal_timing", q.with_(f"""
SELECT CASE WHEN week <= 10 THEN 1 WHEN week <= 20 THEN 2 ELSE 3 END AS phase_id,
       highest_education, age_band, count(*) AS withdrawals,
       {q.rnd('avg(date_unregistration)', 4)} AS avg_day
FROM (SELECT *, {q.week('date_unregistration')} AS week FROM g_people
      WHERE is_withdrawn = 1 AND date_unregistration IS NOT NULL)
GROUP BY 1, 2, 3"""))
def q4_withdrawal_timing(t: Learning) -> DataFrame:
    return analytics.withdrawal_timing(t.gold["dim_student_enrollment"], t.gold["dim_student"])


@query("q5_decline_before_withdrawal", q.with_(f"""
SELECT weeks_to_exit, {q.big('sum(sum_click)')} AS clicks,
       count(DISTINCT student_enrollment_id) AS active_enrollments
FROM (SELECT *, {q.week('(interaction_date - date_unregistration)')} AS weeks_to_exit
      FROM g_engagement JOIN g_enrollment USING (student_enrollment_id)
      WHERE date_unregistration IS NOT NULL)
WHERE weeks_to_exit BETWEEN -8 AND 0 GROUP BY 1"""))
def q5_decline_before_withdrawal(t: Learning) -> DataFrame:
    enrolled = _enrolled(t, "date_unregistration")
    return analytics.activity_before_withdrawal(_facts(t)[0], enrolled)


@query("q6_score_trajectory", q.with_(f"""
SELECT CAST(nth AS INT) AS nth_submission, count(*) AS submissions, count(score) AS scored,
       {q.rnd('avg(score)', 4)} AS avg_score
FROM (SELECT *, row_number() OVER (PARTITION BY student_enrollment_id
               ORDER BY submission_day_offset, assessment_key) AS nth
      FROM g_performance SEMI JOIN (SELECT * FROM g_people WHERE is_withdrawn = 1)
      USING (student_enrollment_id))
GROUP BY 1"""))
def q6_score_trajectory(t: Learning) -> DataFrame:
    enrolled = _enrolled(t, "final_result")
    return analytics.scores_before_withdrawal(_facts(t)[1], enrolled)


@query("q7_peak_weeks", q.with_(f"""
SELECT course_id, week_id, clicks, CAST(rank AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY course_id ORDER BY clicks DESC, week_id) AS rank
  FROM (SELECT course_id, week_id, {q.big('sum(sum_click)')} AS clicks FROM g_engagement
        WHERE course_id IS NOT NULL AND week_id IS NOT NULL GROUP BY 1, 2))
WHERE rank <= 3"""))
def q7_peak_weeks(t: Learning) -> DataFrame:
    return analytics.peak_weeks(_facts(t)[0])


@query("q8_drop_off", q.with_("""
SELECT course_id, last_week, count(*) AS enrollments
FROM (SELECT course_id, student_enrollment_id, max(week_id) AS last_week FROM g_engagement
      WHERE student_enrollment_id IS NOT NULL AND week_id IS NOT NULL GROUP BY 1, 2)
GROUP BY 1, 2"""))
def q8_drop_off(t: Learning) -> DataFrame:
    return analytics.drop_off(_facts(t)[0])


@query("q9_resource_over_time", q.with_(f"""
SELECT activity_type, week_id, {q.big('sum(sum_click)')} AS clicks,
       count(DISTINCT vle_id) AS resources
FROM g_engagement LEFT JOIN g_vle USING (vle_id) GROUP BY 1, 2"""))
def q9_resource_over_time(t: Learning) -> DataFrame:
    return analytics.resource_access(_facts(t)[0], t.gold["dim_vle"])


