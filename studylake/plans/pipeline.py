"""The run order: raw files, bronze, checks, silver, checks, gold, checks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake import schemas
from studylake.operators.upsert import merge_upsert
from studylake.plans import analytics, gold, silver
from studylake.quality import audit, catalog, structured
from studylake.session import materialize, scratch_run
from studylake.sources import raw, tables
from studylake.sources.tables import Lake


def _moment(as_of: datetime) -> Column:
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def inspect_sources(lake: Lake, folder: str, as_of: datetime) -> DataFrame:
    """Count the rows of every source file and record them in the audit trail."""
    moment = _moment(as_of)
    counts = raw.source_row_counts(
        lake.spark, folder, raw.load_date(moment.cast("date")), moment
    )
    trail = audit.record_audit(lake.read("quality", "source_row_count_audit"), counts)
    return audit.audit_report(lake.write("quality", "source_row_count_audit", trail))


def load_bronze(lake: Lake, folder: str, as_of: datetime) -> dict[str, DataFrame]:
    """Each raw file once; a table that exists is not reloaded."""
    return {
        table: lake.create("bronze", table, tables.ingest_bronze(
            raw.read_raw(lake.spark, f"{folder}/{file}", schemas.raw_schema(table)),
            _moment(as_of),
        ))
        for table, file in schemas.RAW_FILES.items()
    }


# Tables whose rows are one per key by the way they are made; the others are checked.
ONE_ROW_PER_KEY = {
    "assessments", "student_info", "student_registration", "student_assessment", "student_vle",
    "dim_student",
}


def _merge(
    lake: Lake, layer: str, table: str, batch: DataFrame, keys: list[str]
) -> DataFrame:
    """The current version with ``batch`` merged in; a batch read twice is stored first."""
    target, check = lake.read(layer, table), table not in ONE_ROW_PER_KEY
    if check or target is not None:
        batch = materialize(batch)
    return merge_upsert(target, batch, keys, check=check)


def load_silver(lake: Lake, bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Clean every table and merge it into the current silver version."""
    result = {}
    for table, clean in silver.CLEANERS.items():
        batch = tables.to_schema(clean(bronze[table]), schemas.SILVER[table])
        merged = _merge(lake, "silver", table, batch, schemas.SILVER_KEYS[table])
        result[table] = lake.write("silver", table, merged)
    return result


def load_gold(lake: Lake, clean: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Dimensions first, facts from the written dimensions.

    Keyed dimensions are merged; the others are rebuilt. The engagement fact is
    partitioned by course, rebalanced so that a large course fills several files.
    """
    spark, result = lake.spark, {}

    def store(name: str, df: DataFrame) -> None:
        if name in schemas.GOLD:
            df = tables.to_schema(df, schemas.GOLD[name])
        if name in schemas.GOLD_KEYS:
            df = _merge(lake, "gold", name, df, schemas.GOLD_KEYS[name])
        partitions = gold.PARTITIONED_BY.get(name, ())
        if partitions:
            df = df.hint("rebalance", *partitions)
        result[name] = lake.write("gold", name, df, *partitions)

    for name, build in gold.BUILDERS.items():
        store(name, build(clean, result, spark))
    return result


def structured_reports(
    bronze: dict[str, DataFrame], clean: dict[str, DataFrame], as_of: datetime
) -> list[DataFrame]:
    at = _moment(as_of)
    return [
        structured.bronze_assessment_report(bronze["assessments"], bronze["courses"], at),
        structured.bronze_submission_report(
            bronze["student_assessment"], bronze["assessments"], bronze["student_info"], at),
        structured.silver_assessment_report(
            clean["assessments"], clean["courses"], bronze["assessments"], at),
        structured.silver_submission_report(
            clean["student_assessment"], clean["assessments"], clean["student_info"],
            clean["student_registration"], bronze["student_assessment"], at),
    ]


def run(spark: SparkSession, source: str, root: str, as_of: datetime) -> dict[str, DataFrame]:
    """The whole pipeline; returns the gold tables, the reports and the two analyses.

    Everything returned reads the lake; intermediate tables are gone by then.
    """
    lake = Lake(spark, root)
    log, today = f"{lake.root}/quality/dq_check_results", _moment(as_of).cast("date")
    with scratch_run(spark):
        inspect_sources(lake, source, as_of)
        bronze = load_bronze(lake, source, as_of)
        clean = load_silver(lake, bronze)
        star = load_gold(lake, clean)
        for report in structured_reports(bronze, clean, as_of):
            tables.append_results(report, log)
        values = lake.write(
            "quality", "dq_listed_values", catalog.listed_values(bronze, clean, star, today))
    checks = catalog.reports(bronze, clean, star, today)
    return {
        **star,
        "dq_check_results": tables.read_results(spark, log),
        "dq_listed_values": values,
        **{f"checks_{name}": report for name, report in checks.items()},
        "engagement_performance": analytics.engagement_performance(
            star["fact_student_engagement"], star["fact_student_performance"]),
        "withdrawal_by_demographics": analytics.withdrawal_by_demographics(
            star["dim_student_enrollment"], star["dim_student"]),
    }


