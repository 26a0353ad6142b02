"""Cleaning jobs. One spec per table drives cleaning and refusal reasons alike."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studylake import schemas
from studylake.functions import columns as fx
from studylake.operators import copies


@dataclass(frozen=True)
class Rule:
    """A condition a row must meet. NULL counts as not met.

    ``blame`` widens or narrows what a refused row is reported for, where that
    differs from the negated condition. ``about_key`` rules are reported before
    conflicts and duplicates of the key.
    """

    reason: str
    keep: Callable[[], Column]
    blame: Callable[[], Column] | None = None
    about_key: bool = False

    def violated(self) -> Column:
        if self.blame is not None:
            return fx.present(self.blame())
        return ~fx.present(self.keep())


def accepted(rules: Sequence[Rule]) -> Column:
    """All rules met. A plain AND, so that single conditions can be pushed down."""
    result = rules[0].keep()
    for rule in rules[1:]:
        result = result & rule.keep()
    return result


@dataclass(frozen=True)
class CleanSpec:
    """How a bronze table becomes silver.

    ``parse`` adds or replaces columns with their typed values; ``rules`` are
    conditions on the parsed row. With ``content`` (a text of the row as
    received) the survivor of a key is picked before the rules apply, so a bad
    latest copy refuses the key, and so do copies that disagree. Without it the
    rules come first and the latest good copy survives.
    """

    table: str
    keys: Sequence[str]
    order: Sequence[str]
    parse: Callable[[DataFrame], DataFrame]
    rules: Sequence[Rule]
    content: Callable[[], Column] | None = None

    @property
    def columns(self) -> list[str]:
        return [part.split()[0] for part in schemas.SILVER[self.table].split(", ")]

    def clean(self, bronze: DataFrame) -> DataFrame:
        parsed = self.parse(bronze)
        if self.content is None:
            kept = parsed.filter(accepted(self.rules)).select(*self.columns)
            return copies.latest_per_key(kept, self.keys, self.order)
        survivors = copies.keep_agreeing_latest(
            parsed, self.keys, self.order, self.content(), self.columns
        )
        return survivors.filter(accepted(self.rules))


def _not_null(column: str) -> Callable[[], Column]:
    return lambda: F.col(column).isNotNull()


def _blank(column: str) -> Callable[[], Column]:
    return lambda: F.nullif(F.trim(F.col(column)), F.lit("")).isNull()


def _load_date(df: DataFrame) -> DataFrame:
    return df.withColumn("ingestion_date", F.col("ingestion_timestamp").cast("date"))


def _codes(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "code_module": fx.norm_code(F.col("code_module")),
        "code_presentation": fx.norm_code(F.col("code_presentation")),
    })


def _parse_assessments(bronze: DataFrame) -> DataFrame:
    return _load_date(_codes(bronze)).withColumns({
        "raw_type": fx.norm_code(F.col("assessment_type")),
        "raw_weight": F.col("weight"),
        "id_assessment": F.col("id_assessment").try_cast("bigint"),
        "assessment_type": fx.map_domain(
            fx.norm_code(F.col("assessment_type")), schemas.ASSESSMENT_TYPES
        ),
        "date": F.col("date").try_cast("int"),
        "date_source": F.col("date").cast("string"),
        "weight": F.col("weight").try_cast("double"),
    })


ASSESSMENTS = CleanSpec(
    table="assessments",
    keys=["id_assessment"],
    order=["ingestion_timestamp", "weight", "date"],
    parse=_parse_assessments,
    content=lambda: fx.fingerprint([
        F.col(c)
        for c in ("code_module", "code_presentation", "raw_type", "date_source", "raw_weight")
    ]),
    rules=[
        Rule("id_missing_or_unparseable", _not_null("id_assessment"), about_key=True),
        Rule("id_not_positive", lambda: F.col("id_assessment") > 0, about_key=True),
        Rule("module_missing", _not_null("code_module"), _blank("code_module")),
        Rule("presentation_missing", _not_null("code_presentation"), _blank("code_presentation")),
        Rule("type_missing_or_invalid", _not_null("assessment_type")),
        Rule("weight_missing_or_unparseable", _not_null("weight")),
        Rule("weight_out_of_range", lambda: F.col("weight").between(0, 100)),
        Rule(
            "date_out_of_range",
            lambda: F.col("date").isNull() | F.col("date").between(0, 1000),
        ),
        Rule("ingestion_timestamp_missing", _not_null("ingestion_timestamp")),
    ],
)


def _parse_student_assessment(bronze: DataFrame) -> DataFrame:
    return _load_date(bronze).withColumns({
        "raw_submitted": F.col("date_submitted"),
        "raw_banked": F.col("is_banked"),
        "id_assessment": F.col("id_assessment").try_cast("bigint"),
        "id_student": F.col("id_student").try_cast("bigint"),
        "date_submitted": F.col("date_submitted").try_cast("int"),
        "is_banked": F.col("is_banked").try_cast("int"),
        "score": F.col("score").try_cast("double"),
        "score_source": F.col("score").cast("string"),
    })


STUDENT_ASSESSMENT = CleanSpec(
    table="student_assessment",
    keys=["id_assessment", "id_student"],
    order=["ingestion_timestamp", "date_submitted", "score"],
    parse=_parse_student_assessment,
    content=lambda: fx.fingerprint([
        F.col(c) for c in ("raw_submitted", "raw_banked", "score_source")
    ]),
    rules=[
        Rule("assessment_id_missing_or_unparseable", _not_null("id_assessment"), about_key=True),
        Rule("assessment_id_not_positive", lambda: F.col("id_assessment") > 0, about_key=True),
        Rule("student_id_missing_or_unparseable", _not_null("id_student"), about_key=True),
        Rule("student_id_not_positive", lambda: F.col("id_student") > 0, about_key=True),
        Rule("date_submitted_missing_or_unparseable", _not_null("date_submitted")),
        Rule("date_submitted_out_of_range", lambda: F.col("date_submitted").between(-365, 1825)),
        Rule("is_banked_missing_or_invalid", lambda: F.col("is_banked").isin(0, 1)),
        Rule(
            "score_out_of_range",
            lambda: F.col("score").isNull()
            | (~F.isnan("score") & F.col("score").between(0, 100)),
        ),
        Rule("ingestion_timestamp_missing", _not_null("ingestion_timestamp")),
    ],
)


def _parse_student_info(bronze: DataFrame) -> DataFrame:
    texts = ("region", "highest_education", "imd_band", "age_band", "final_result")
    return _load_date(_codes(bronze)).withColumns({
        "raw_gender": F.col("gender"),
        "raw_disability": F.col("disability"),
        "id_student": F.col("id_student").try_cast("bigint"),
        "gender": fx.norm_code(F.col("gender")),
        "num_of_prev_attempts": F.col("num_of_prev_attempts").try_cast("int"),
        "studied_credits": F.col("studied_credits").try_cast("int"),
        "disability": fx.flag_to_bool(F.col("disability")),
        **{c: F.trim(F.col(c)) for c in texts},
    })


STUDENT_INFO = CleanSpec(
    table="student_info",
    keys=["code_module", "code_presentation", "id_student"],
    order=["ingestion_timestamp"],
    parse=_parse_student_info,
    rules=[
        Rule("module_missing", _not_null("code_module")),
        Rule("presentation_missing", _not_null("code_presentation")),
        Rule("student_id_missing_or_unparseable", _not_null("id_student"), about_key=True),
        Rule("gender_missing_or_invalid", lambda: F.col("raw_gender").isin(schemas.RAW_GENDERS)),
        Rule("region_missing", _not_null("region")),
        Rule("education_missing", _not_null("highest_education")),
        Rule("imd_band_missing", _not_null("imd_band")),
        Rule("age_band_missing", _not_null("age_band")),
        Rule("prev_attempts_missing_or_negative", lambda: F.col("num_of_prev_attempts") >= 0),
        Rule("credits_missing_or_not_positive", lambda: F.col("studied_credits") > 0),
        Rule("disability_missing", _not_null("raw_disability")),
        Rule("final_result_missing", _not_null("final_result")),
        Rule("ingestion_timestamp_missing", _not_null("ingestion_timestamp")),
    ],
)


def _parse_student_registration(bronze: DataFrame) -> DataFrame:
    return _load_date(_codes(bronze)).withColumns({
        "raw_registration": F.col("date_registration"),
        "id_student": F.col("id_student").try_cast("bigint"),
        "date_registration": F.col("date_registration").try_cast("int"),
        "date_unregistration": F.col("date_unregistration").try_cast("int"),
    })


STUDENT_REGISTRATION = CleanSpec(
    table="student_registration",
    keys=["code_module", "code_presentation", "id_student"],
    order=["ingestion_timestamp"],
    parse=_parse_student_registration,
    rules=[
        Rule("module_missing", _not_null("code_module")),
        Rule("presentation_missing", _not_null("code_presentation")),
        Rule("student_id_missing_or_unparseable", _not_null("id_student"), about_key=True),
        Rule("registration_missing", _not_null("raw_registration")),
        Rule("ingestion_timestamp_missing", _not_null("ingestion_timestamp")),
    ],
)


def _parse_courses(bronze: DataFrame) -> DataFrame:
    return _codes(bronze).withColumn(
        "module_presentation_length", F.col("module_presentation_length").try_cast("int")
    )


def _parse_vle(bronze: DataFrame) -> DataFrame:
    return _codes(bronze).withColumns({
        "id_site": F.col("id_site").try_cast("bigint"),
        "activity_type": fx.norm_text(F.col("activity_type"), "lower"),
        "week_from": fx.placeholder_int(F.col("week_from")),
        "week_to": fx.placeholder_int(F.col("week_to")),
    })


def _parse_student_vle(bronze: DataFrame) -> DataFrame:
    return _codes(bronze).withColumns({
        "id_student": F.col("id_student").try_cast("bigint"),
        "id_site": F.col("id_site").try_cast("bigint"),
        "date": F.col("date").try_cast("int"),
        "sum_click": F.col("sum_click").try_cast("bigint"),
    })


COURSE_RULES = [
    Rule("module_missing", _not_null("code_module")),
    Rule("presentation_missing", _not_null("code_presentation")),
    Rule("length_missing_or_not_positive", lambda: F.col("module_presentation_length") > 0),
]

VLE_RULES = [
    Rule("site_id_missing_or_unparseable", _not_null("id_site")),
    Rule("module_missing", _not_null("code_module")),
    Rule("presentation_missing", _not_null("code_presentation")),
    Rule("activity_type_missing", _not_null("activity_type")),
]

STUDENT_VLE_RULES = [
    Rule("module_missing", _not_null("code_module")),
    Rule("presentation_missing", _not_null("code_presentation")),
    Rule("student_id_missing_or_unparseable", _not_null("id_student"), about_key=True),
    Rule("site_id_missing_or_unparseable", _not_null("id_site")),
    Rule("date_missing_or_unparseable", _not_null("date")),
    Rule("clicks_missing_or_not_positive", lambda: F.col("sum_click") > 0),
    Rule("ingestion_timestamp_missing", _not_null("ingestion_timestamp")),
]


def _distinct_content(parsed: DataFrame) -> DataFrame:
    """Identical rows once, with the newest load; differing rows of a key all stay."""
    content = [c for c in parsed.columns if not c.startswith("ingestion_")]
    return parsed.groupBy(*content).agg(
        F.max("ingestion_timestamp").alias("ingestion_timestamp"),
        F.max("ingestion_date").alias("ingestion_date"),
    )


def clean_courses(bronze: DataFrame) -> DataFrame:
    return _distinct_content(_parse_courses(bronze).filter(accepted(COURSE_RULES)))


def clean_vle(bronze: DataFrame) -> DataFrame:
    return _distinct_content(_parse_vle(bronze).filter(accepted(VLE_RULES)))


def clean_assessments(bronze: DataFrame) -> DataFrame:
    return ASSESSMENTS.clean(bronze)


def clean_student_assessment(bronze: DataFrame) -> DataFrame:
    return STUDENT_ASSESSMENT.clean(bronze)


def clean_student_info(bronze: DataFrame) -> DataFrame:
    return STUDENT_INFO.clean(bronze)


def clean_student_registration(bronze: DataFrame) -> DataFrame:
    return STUDENT_REGISTRATION.clean(bronze)


def clean_student_vle(bronze: DataFrame) -> DataFrame:
    """Visits of one student to one resource on one day become one daily total."""
    visits = _parse_student_vle(bronze).filter(accepted(STUDENT_VLE_RULES))
    return daily_totals(visits, schemas.SILVER_KEYS["student_vle"], "sum_click")


def daily_totals(visits: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    newest = F.max("ingestion_timestamp")
    return visits.groupBy(*keys).agg(
        F.sum(amount).alias(amount),
        newest.alias("ingestion_timestamp"),
        newest.cast("date").alias("ingestion_date"),
    )


CLEANERS = {
    "courses": clean_courses,
    "assessments": clean_assessments,
    "vle": clean_vle,
    "student_info": clean_student_info,
    "student_registration": clean_student_registration,
    "student_assessment": clean_student_assessment,
    "student_vle": clean_student_vle,
}
