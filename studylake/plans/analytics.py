"""Business reports on the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studylake.functions import columns as fx
from studylake.operators.ranking import with_ntile_by_selection
from studylake.session import materialize

DEMOGRAPHICS = ("highest_education", "age_band", "imd_band", "disability")
ID = "student_enrollment_id"


# --- engagement and performance ---------------------------------------------

def engagement_per_enrollment(engagement: DataFrame) -> DataFrame:
    return engagement.groupBy(ID).agg(
        F.sum("sum_click").alias("total_clicks"),
        F.countDistinct("interaction_date").alias("active_days"),
    )


def performance_per_enrollment(performance: DataFrame) -> DataFrame:
    return performance.groupBy(ID).agg(
        F.avg("score").alias("avg_score"),
        F.sum("weighted_score").alias("total_weighted_score"),
        F.count("student_performance_key").alias("assessment_count"),
    )


def enrollment_activity(engagement: DataFrame, performance: DataFrame) -> DataFrame:
    """Clicks beside results per enrollment; a NULL enrollment stays unmatched."""
    e = engagement_per_enrollment(engagement).withColumnRenamed(ID, "_e")
    p = performance_per_enrollment(performance).withColumnRenamed(ID, "_p")
    return e.join(p, F.col("_e") == F.col("_p"), "full_outer").select(
        F.coalesce("_e", "_p").alias(ID),
        F.coalesce("total_clicks", F.lit(0)).alias("total_clicks"),
        F.coalesce("active_days", F.lit(0)).alias("active_days"),
        "avg_score", "total_weighted_score", "assessment_count",
    )


def engagement_performance(engagement: DataFrame, performance: DataFrame) -> DataFrame:
    """The activity rows with their engagement quartile, ties broken by enrollment."""
    rows = materialize(enrollment_activity(engagement, performance))
    order = ["total_clicks", ID, "assessment_count"]
    return with_ntile_by_selection(rows, 4, order, "engagement_quartile")


# --- withdrawal --------------------------------------------------------------

def enrollment_demographics(enrollment: DataFrame, student: DataFrame) -> DataFrame:
    people = student.select(
        "student_id", "gender", "region", "highest_education", "imd_band", "age_band",
        "disability",
    )
    return enrollment.select(
        ID, "student_id", "course_id", "num_of_prev_attempts", "studied_credits",
        "final_result", "date_registration", "date_unregistration",
        fx.is_withdrawn(F.col("final_result")).alias("is_withdrawn"),
    ).join(people, "student_id")


def withdrawal_summary(rows: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.count(ID).alias("total_enrollments"),
        F.sum("is_withdrawn").alias("total_withdrawals"),
        fx.pct(F.sum("is_withdrawn"), F.count(ID)).alias("withdrawal_rate_pct"),
    )


def withdrawal_by_demographics(
    enrollment: DataFrame,
    student: DataFrame,
    min_n: int = 50,
    by: Sequence[str] = DEMOGRAPHICS,
) -> DataFrame:
    """Withdrawal rate per group of at least ``min_n`` enrollments, highest first."""
    summary = withdrawal_summary(enrollment_demographics(enrollment, student), by)
    return summary.filter(F.col("total_enrollments") >= min_n).orderBy(
        F.desc("withdrawal_rate_pct"), F.desc("total_enrollments")
    )


def withdrawal_by_history(enrollment: DataFrame, student: DataFrame) -> DataFrame:
    """Withdrawal rate by earlier attempts and credit load."""
    rows = enrollment_demographics(enrollment, student).withColumn(
        "credit_load_band", fx.credit_band(F.col("studied_credits"))
    )
    return withdrawal_summary(rows, ["num_of_prev_attempts", "credit_load_band"])


# --- verification profiles ---------------------------------------------------

def profile_enrollment(enrollment: DataFrame) -> DataFrame:
    return enrollment.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(ID).alias("distinct_keys"),
        F.count("date_unregistration").alias("withdrew"),
        F.min("date_registration").alias("min_reg"),
        F.max("date_registration").alias("max_reg"),
    )


def profile_student_info(student_info: DataFrame) -> DataFrame:
    return student_info.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("id_student").alias("unique_students"),
        F.countDistinct("code_module").alias("unique_courses"),
        F.countDistinct(
            F.concat("code_module", "code_presentation")
        ).alias("unique_presentations"),
        F.count_if(F.col("is_unregistered")).alias("unregistered_count"),
        F.countDistinct("gender").alias("gender_categories"),
        F.countDistinct("region").alias("regions"),
    )


# --- the open questions ------------------------------------------------------

def activity_score_correlation(engagement: DataFrame, performance: DataFrame) -> DataFrame:
    """Correlation of clicks and active days with the average score."""
    rows = enrollment_activity(engagement, performance).filter(
        F.col(ID).isNotNull() & F.col("avg_score").isNotNull() & ~F.isnan("avg_score")
    )
    return rows.agg(
        F.count(F.lit(1)).alias("enrollments"),
        F.corr("total_clicks", "avg_score").alias("clicks_vs_score"),
        F.corr("active_days", "avg_score").alias("days_vs_score"),
    )


def engagement_by_result(engagement: DataFrame, enrollment: DataFrame) -> DataFrame:
    """How much each outcome group clicked; enrollments without a click count as zero."""
    activity = engagement_per_enrollment(engagement)
    rows = enrollment.select(ID, "final_result").join(activity, ID, "left").select(
        "final_result",
        F.coalesce("total_clicks", F.lit(0)).alias("clicks"),
        F.coalesce("active_days", F.lit(0)).alias("days"),
    )
    return rows.groupBy("final_result").agg(
        F.count(F.lit(1)).alias("enrollments"),
        F.sum("clicks").alias("total_clicks"),
        F.round(F.avg("clicks"), 4).alias("avg_clicks"),
        F.round(F.avg("days"), 4).alias("avg_active_days"),
        F.max("clicks").alias("max_clicks"),
    )


def early_engagement_by_result(
    engagement: DataFrame, enrollment: DataFrame, last_week: int = 4
) -> DataFrame:
    """Clicks up to ``last_week`` per outcome: the early signs of a good result."""
    early = engagement.filter(F.col("week_id") <= last_week)
    return engagement_by_result(early, enrollment)


def withdrawal_timing(enrollment: DataFrame, student: DataFrame) -> DataFrame:
    """In which phase of the course the withdrawals fall, per education and age."""
    rows = enrollment_demographics(enrollment, student).filter(
        (F.col("is_withdrawn") == 1) & F.col("date_unregistration").isNotNull()
    )
    week = fx.week_of(F.col("date_unregistration"))
    return (
        rows.withColumn("phase_id", fx.phase_of(week))
        .groupBy("phase_id", "highest_education", "age_band")
        .agg(
            F.count(F.lit(1)).alias("withdrawals"),
            F.round(F.avg("date_unregistration"), 4).alias("avg_day"),
        )
    )


def activity_before_withdrawal(
    engagement: DataFrame, enrollment: DataFrame, weeks: int = 8
) -> DataFrame:
    """Clicks in each of the last ``weeks`` weeks before unregistration."""
    leavers = enrollment.filter(F.col("date_unregistration").isNotNull()).select(
        ID, "date_unregistration"
    )
    offset = fx.week_of(F.col("interaction_date") - F.col("date_unregistration"))
    return (
        engagement.select(ID, "interaction_date", "sum_click")
        .join(leavers, ID)
        .withColumn("weeks_to_exit", offset)
        .filter(F.col("weeks_to_exit").between(-weeks, 0))
        .groupBy("weeks_to_exit")
        .agg(
            F.sum("sum_click").alias("clicks"),
            F.countDistinct(ID).alias("active_enrollments"),
        )
    )


def scores_before_withdrawal(performance: DataFrame, enrollment: DataFrame) -> DataFrame:
    """Average score by the how-manieth submission, for withdrawn enrollments.

    The window holds the submissions of one enrollment, at most one per
    assessment of its course.
    """
    leavers = enrollment.filter(fx.is_withdrawn(F.col("final_result")) == 1).select(ID)
    nth = Window.partitionBy(ID).orderBy("submission_day_offset", "assessment_key")
    return (
        performance.select(ID, "submission_day_offset", "assessment_key", "score")
        .join(leavers, ID, "left_semi")
        .withColumn("nth_submission", F.row_number().over(nth))
        .groupBy("nth_submission")
        .agg(
            F.count(F.lit(1)).alias("submissions"),
            F.count("score").alias("scored"),
            F.round(F.avg("score"), 4).alias("avg_score"),
        )
    )


def clicks_per_week(engagement: DataFrame) -> DataFrame:
    return (
        engagement.filter(F.col("course_id").isNotNull() & F.col("week_id").isNotNull())
        .groupBy("course_id", "week_id")
        .agg(F.sum("sum_click").alias("clicks"))
    )


def peak_weeks(engagement: DataFrame, top: int = 3) -> DataFrame:
    """The busiest weeks of each course; the window holds one course's weekly totals."""
    busiest = Window.partitionBy("course_id").orderBy(F.desc("clicks"), "week_id")
    return (
        clicks_per_week(engagement)
        .withColumn("rank", F.row_number().over(busiest))
        .filter(F.col("rank") <= top)
    )


def drop_off(engagement: DataFrame) -> DataFrame:
    """How many enrollments were last active in each course week."""
    last = (
        engagement.filter(F.col(ID).isNotNull() & F.col("week_id").isNotNull())
        .groupBy("course_id", ID)
        .agg(F.max("week_id").alias("last_week"))
    )
    return last.groupBy("course_id", "last_week").agg(
        F.count(F.lit(1)).alias("enrollments")
    )


def resource_access(engagement: DataFrame, vle: DataFrame) -> DataFrame:
    """Clicks per resource type and week."""
    weekly = engagement.groupBy("vle_id", "week_id").agg(F.sum("sum_click").alias("clicks"))
    return (
        weekly.join(vle.select("vle_id", "activity_type"), "vle_id", "left")
        .groupBy("activity_type", "week_id")
        .agg(F.sum("clicks").alias("clicks"), F.countDistinct("vle_id").alias("resources"))
    )
