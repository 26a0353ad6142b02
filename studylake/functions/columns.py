"""Scalar building blocks: each takes and returns Columns, all JVM-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake import schemas


def norm_code(c: Column) -> Column:
    """Upper-cased code without surrounding spaces."""
    return F.upper(F.trim(c))


def norm_text(c: Column, case: str | None = None) -> Column:
    """Text without surrounding spaces, optionally ``lower`` or ``upper``."""
    text = F.trim(c)
    return {"lower": F.lower, "upper": F.upper}.get(case, lambda x: x)(text)


def clean_text(c: Column) -> Column:
    """Text without surrounding whitespace of any kind; blank becomes NULL."""
    return F.nullif(F.regexp_replace(c.cast("string"), r"^\s+|\s+$", ""), F.lit(""))


def placeholder_int(c: Column, placeholder: str = schemas.PLACEHOLDER) -> Column:
    return F.nullif(c, F.lit(placeholder)).try_cast("int")


def with_source_text(df: DataFrame, column: str, suffix: str = "_source") -> DataFrame:
    """Keep the received text of ``column`` beside its parsed value."""
    return df.withColumn(column + suffix, F.col(column).cast("string"))


def map_domain(c: Column, mapping: Mapping[str, str]) -> Column:
    """Value of ``c`` under ``mapping``; anything else becomes NULL."""
    result = None
    for raw, value in mapping.items():
        branch = (c == raw, F.lit(value))
        result = F.when(*branch) if result is None else result.when(*branch)
    return result


def flag_to_bool(c: Column) -> Column:
    flag = norm_code(c)
    return F.when(flag == "Y", F.lit(True)).when(flag == "N", F.lit(False))


def bool_text(c: Column) -> Column:
    return F.trim(c.cast("string"))


def course_key(module: Column, presentation: Column) -> Column:
    return F.concat(module, F.lit("_"), presentation)


def enrollment_key(student: Column, module: Column, presentation: Column) -> Column:
    return F.concat(student.cast("string"), F.lit("_"), module, F.lit("_"), presentation)


def surrogate_key(*cols: Column) -> Column:
    """64-bit hash of the parts; NULL parts are skipped."""
    return F.xxhash64(*cols)


def fingerprint(cols: Sequence[Column]) -> Column:
    """Text of a row's content with ``~`` for NULL, to compare copies of a key."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in cols])


def week_of(day: Column) -> Column:
    """Course week of a day offset; week 0 is day 0 alone, days 1-7 are week 1."""
    return F.when(day >= 0, F.ceil(day / 7)).otherwise(F.floor(day / 7)).cast("int")


def phase_of(week: Column) -> Column:
    return F.when(week <= 10, 1).when(week <= 20, 2).otherwise(3)


def credit_band(credits: Column) -> Column:
    return (
        F.when(credits < 60, "< 60 Credits")
        .when(credits.between(60, 120), "60-120 Credits")
        .otherwise("> 120 Credits")
    )


def days_late(submitted: Column, due: Column) -> Column:
    return submitted - due


def is_non_submission(score: Column) -> Column:
    return score.isNull()


def weighted_score(score: Column, weight: Column) -> Column:
    return score * weight / F.lit(100.0)


def is_withdrawn(result: Column) -> Column:
    return F.when(norm_code(result) == "WITHDRAWN", 1).otherwise(0)


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage, NULL when ``whole`` is zero."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def rate(part: Column, whole: Column, digits: int = 4) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole), digits)


def offset_date(day: Column) -> Column:
    """Date of a day number counted from 1970-01-01."""
    return F.date_from_unix_date(day)


def age_days(day: Column, as_of: Column) -> Column:
    return F.datediff(as_of, day)


def present(condition: Column) -> Column:
    """``condition`` with NULL read as false, as a WHERE clause reads it."""
    return F.coalesce(condition, F.lit(False))


def reasons(violations: Mapping[str, Column]) -> Column:
    """Names of all violated conditions, in order."""
    named = [F.when(present(cond), F.lit(name)).otherwise("") for name, cond in violations.items()]
    return F.array_remove(F.array(*named), "")


def first_reason(
    violations: Mapping[str, Column], fallback: str = "other_unspecified"
) -> Column:
    """Name of the first violated condition, else ``fallback``."""
    chosen = [F.when(present(cond), F.lit(name)) for name, cond in violations.items()]
    return F.coalesce(*chosen, F.lit(fallback))


def week_spine(first: int = schemas.FIRST_WEEK, last: int = schemas.LAST_WEEK) -> Column:
    """One row per week of the inclusive range, next to each input row."""
    return F.explode(F.sequence(F.lit(first), F.lit(last)))


def phases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(schemas.PHASES, "phase_id int, phase_name string")
