"""Star schema: eight dimensions and two facts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake.functions import columns as fx
from studylake.operators import copies, joins

Frames = Mapping[str, DataFrame]
COURSE = ["code_module", "code_presentation"]
ENROLLMENT = ["code_module", "code_presentation", "id_student"]


def _course_id() -> Column:
    return fx.course_key(F.col("code_module"), F.col("code_presentation"))


def dim_course(courses: DataFrame) -> DataFrame:
    return courses.select(
        _course_id().alias("course_id"), *COURSE, "module_presentation_length"
    ).distinct()


def dim_vle(vle: DataFrame) -> DataFrame:
    return vle.select(
        F.col("id_site").alias("vle_id"), "activity_type", "week_from", "week_to"
    ).distinct()


def dim_assessment(assessments: DataFrame) -> DataFrame:
    return assessments.select(
        F.col("id_assessment").alias("assessment_key"),
        _course_id().alias("course_id"),
        "assessment_type",
        F.col("date").alias("assessment_day_offset"),
        "weight",
    )


def dim_course_phase(spark: SparkSession) -> DataFrame:
    return fx.phases(spark)


def dim_course_week(courses: DataFrame) -> DataFrame:
    """Every course over every week of the calendar: the cross join as an explode."""
    return (
        courses.select(*COURSE)
        .distinct()
        .select(_course_id().alias("course_id"), fx.week_spine().alias("week_id"))
        .select(
            "course_id",
            "week_id",
            F.col("week_id").alias("week_number"),
            fx.phase_of(F.col("week_id")).alias("phase_id"),
        )
    )


def dim_student(info: DataFrame) -> DataFrame:
    """Latest demographics per student."""
    texts = ["gender", "region", "highest_education", "imd_band", "age_band"]
    rows = info.filter(F.col("id_student").isNotNull()).select(
        "id_student", *texts, "disability", "ingestion_timestamp"
    )
    latest = copies.latest_per_key(rows, ["id_student"], ["ingestion_timestamp"])
    return latest.select(
        F.col("id_student").alias("student_id"),
        *[F.trim(F.col(c)).alias(c) for c in texts],
        fx.bool_text(F.col("disability")).alias("disability"),
        "ingestion_timestamp",
    )


def _complete(df: DataFrame) -> DataFrame:
    condition = F.lit(True)
    for column in ENROLLMENT:
        condition = condition & F.col(column).isNotNull()
    return df.filter(condition)


def dim_student_enrollment(info: DataFrame, registration: DataFrame) -> DataFrame:
    """One row per student and presentation, from the latest rows of both sides."""
    person = copies.latest_per_key(
        _complete(info).select(
            *ENROLLMENT, "num_of_prev_attempts", "studied_credits", "final_result",
            "ingestion_timestamp",
        ),
        ENROLLMENT,
        ["ingestion_timestamp"],
    )
    dates = copies.latest_per_key(
        _complete(registration).select(
            *ENROLLMENT, "date_registration", "date_unregistration", "ingestion_timestamp"
        ),
        ENROLLMENT,
        ["ingestion_timestamp"],
    ).withColumnRenamed("ingestion_timestamp", "registered_at")
    module, presentation = fx.norm_code(F.col("code_module")), fx.norm_code(
        F.col("code_presentation")
    )
    return person.join(dates, ENROLLMENT).select(
        fx.enrollment_key(F.col("id_student"), module, presentation).alias(
            "student_enrollment_id"
        ),
        F.col("id_student").alias("student_id"),
        fx.course_key(module, presentation).alias("course_id"),
        F.col("num_of_prev_attempts").cast("int").alias("num_of_prev_attempts"),
        F.col("studied_credits").cast("int").alias("studied_credits"),
        F.trim(F.col("final_result")).alias("final_result"),
        F.col("date_registration").cast("int").alias("date_registration"),
        F.col("date_unregistration").cast("int").alias("date_unregistration"),
        F.greatest("ingestion_timestamp", "registered_at").alias("ingestion_timestamp"),
    )


def dim_student_info(
    info: DataFrame, registration: DataFrame, created_at: Column | None = None
) -> DataFrame:
    """Demographics, outcome and registration of each enrollment, side by side."""
    dates = registration.select(
        *ENROLLMENT,
        "date_registration",
        "date_unregistration",
        F.col("ingestion_timestamp").alias("registered_at"),
    )
    return info.join(dates, ENROLLMENT).select(
        fx.enrollment_key(
            F.col("id_student"), F.col("code_module"), F.col("code_presentation")
        ).alias("student_course_key"),
        "id_student", *COURSE, "gender", "region", "highest_education", "imd_band",
        "age_band", "num_of_prev_attempts", "studied_credits", "disability",
        "final_result", "date_registration", "date_unregistration",
        F.col("date_unregistration").isNotNull().alias("is_unregistered"),
        F.greatest("ingestion_timestamp", "registered_at").alias("last_updated_timestamp"),
        (F.current_timestamp() if created_at is None else created_at).alias(
            "dimension_created_at"
        ),
    )


def _enrollment_lookup(enrollment: DataFrame) -> DataFrame:
    return enrollment.select("student_enrollment_id", "student_id", "course_id")


def _week_lookup(weeks: DataFrame) -> DataFrame:
    return weeks.select("course_id", F.col("week_id").alias("_week"), "week_id")


def fact_engagement(
    log: DataFrame,
    courses: DataFrame,
    enrollment: DataFrame,
    vle: DataFrame,
    weeks: DataFrame,
    unmatched: str = "merge",
) -> DataFrame:
    """Clicks per enrollment, resource and day.

    Courses and weeks are small and ride on adaptive broadcasts; the week comes last, as
    it follows from the day and would only widen the rows shuffled for the resource and
    for the enrollment, which is looked up once on (student, course), hashed so that
    the rows need no sort by these texts. Log rows without an
    enrollment are merged under a NULL enrollment, or left out with
    ``unmatched="drop"``. The fact is dealt out by enrollment and day, so sums per enrollment
    and day need no further shuffle, and a hot enrollment is split by its days.
    """
    if unmatched not in ("merge", "drop"):
        raise ValueError("unmatched must be 'merge' or 'drop'")
    placed = (
        log.select(*COURSE, "id_student", "id_site", "date", "sum_click")
        .join(courses.select("course_id", *COURSE), COURSE, "left")
        .join(vle.select(F.col("vle_id").alias("id_site"), "vle_id"), "id_site", "left")
        .withColumnRenamed("id_student", "student_id")
    )
    matched = placed.join(
        _enrollment_lookup(enrollment).hint("shuffle_hash"),
        ["student_id", "course_id"],
        "left" if unmatched == "merge" else "inner",
    )
    matched = matched.withColumn("_week", fx.week_of(F.col("date"))).join(
        _week_lookup(weeks), ["course_id", "_week"], "left"
    )
    keys = ["student_enrollment_id", "vle_id", "course_id", "date", "week_id"]
    dealt = matched.repartition("student_enrollment_id", "date")
    return dealt.groupBy(*keys).agg(F.sum("sum_click").alias("sum_click")).select(
        fx.surrogate_key(
            F.col("student_enrollment_id"), F.col("vle_id"), F.col("date")
        ).alias("engagement_id"),
        "student_enrollment_id", "vle_id", "course_id",
        F.col("date").alias("interaction_date"),
        "week_id", "sum_click",
    )


def fact_performance(
    submissions: DataFrame,
    assessments: DataFrame,
    assessment_dim: DataFrame,
    courses: DataFrame,
    enrollment: DataFrame,
    weeks: DataFrame,
) -> DataFrame:
    """One row per submission of a known assessment on a known course.

    The assessment side is joined to its dimensions first, so the submissions
    meet one lookup instead of three, and one that splits a hot assessment.
    """
    known = (
        assessments.select("id_assessment", *COURSE)
        .join(
            assessment_dim.select(
                F.col("assessment_key").alias("id_assessment"), "assessment_key",
                "assessment_day_offset", "weight",
            ),
            "id_assessment",
        )
        .join(courses.select("course_id", *COURSE), COURSE)
        .drop(*COURSE)
    )
    submitted, due = F.col("date_submitted"), F.col("assessment_day_offset")
    return (
        joins.lookup(submissions, known, ["id_assessment"], how="inner")
        .withColumn("_week", fx.week_of(submitted))
        .join(_week_lookup(weeks), ["course_id", "_week"], "left")
        .withColumn("student_id", F.col("id_student"))
        .join(_enrollment_lookup(enrollment), ["student_id", "course_id"], "left")
        .select(
            fx.surrogate_key(F.col("id_student"), F.col("id_assessment")).alias(
                "student_performance_key"
            ),
            "student_enrollment_id", "assessment_key", "course_id", "week_id",
            due.alias("assessment_date"),
            submitted.alias("submission_day_offset"),
            "is_banked", "score",
            fx.days_late(submitted, due).alias("days_late"),
            fx.is_non_submission(F.col("score")).alias("is_non_submission"),
            fx.weighted_score(F.col("score"), F.col("weight")).alias("weighted_score"),
        )
    )


# Many-to-one relationships of the star: child, parent, join column.
RELATIONSHIPS = [
    ("dim_student_enrollment", "dim_student", "student_id"),
    ("dim_student_enrollment", "dim_course", "course_id"),
    ("fact_student_engagement", "dim_student_enrollment", "student_enrollment_id"),
]


# How each table follows from silver frames (s), other gold frames (g) and the session,
# in an order that meets the dependencies.
BUILDERS: dict[str, Callable[[Frames, Frames, SparkSession], DataFrame]] = {
    "dim_course": lambda s, g, spark: dim_course(s["courses"]),
    "dim_vle": lambda s, g, spark: dim_vle(s["vle"]),
    "dim_assessment": lambda s, g, spark: dim_assessment(s["assessments"]),
    "dim_course_phase": lambda s, g, spark: dim_course_phase(spark),
    "dim_course_week": lambda s, g, spark: dim_course_week(s["courses"]),
    "dim_student": lambda s, g, spark: dim_student(s["student_info"]),
    "dim_student_enrollment": lambda s, g, spark: dim_student_enrollment(
        s["student_info"], s["student_registration"]
    ),
    "dim_student_info": lambda s, g, spark: dim_student_info(
        s["student_info"], s["student_registration"]
    ),
    "fact_student_engagement": lambda s, g, spark: fact_engagement(
        s["student_vle"], g["dim_course"], g["dim_student_enrollment"], g["dim_vle"],
        g["dim_course_week"],
    ),
    "fact_student_performance": lambda s, g, spark: fact_performance(
        s["student_assessment"], s["assessments"], g["dim_assessment"], g["dim_course"],
        g["dim_student_enrollment"], g["dim_course_week"],
    ),
}

PARTITIONED_BY = {"fact_student_engagement": ("course_id",)}
