"""Source audit, drop-rate gate, health, and relationship checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studylake.operators.upsert import merge_upsert
from studylake.quality.report import one_row
from studylake.session import materialize

ACCEPTABLE_BELOW, WARNING_UP_TO = 5, 10  # percent of rows dropped


def record_audit(audit: DataFrame | None, counts: DataFrame) -> DataFrame:
    """The audit trail with the counts of one inspection; repeating it changes nothing else.

    Counting reads every source, so the few counts are written before the merge uses them.
    """
    return merge_upsert(audit, materialize(counts), ["LoadDate", "source_file"])


def audit_report(audit: DataFrame) -> DataFrame:
    return audit.orderBy(F.desc("LoadDate"), "source_file")


def drop_severity(percent: Column) -> Column:
    return (
        F.when(percent < ACCEPTABLE_BELOW, "Acceptable")
        .when(percent <= WARNING_UP_TO, "Warning")
        .otherwise("Unusable")
    )


def drop_rate_gate(before: DataFrame, after: DataFrame, dataset: str) -> DataFrame:
    """Rows lost between two stages and what the audit rules say to that; one row."""
    counts = one_row(
        before.agg(F.count(F.lit(1)).alias("pre_check")),
        after.agg(F.count(F.lit(1)).alias("post_check")),
    )
    dropped = F.col("pre_check") - F.col("post_check")
    percent = F.coalesce(F.try_divide(dropped * F.lit(100.0), F.col("pre_check")), F.lit(0.0))
    return counts.select(
        F.lit(dataset).alias("dataset"), "pre_check", "post_check",
        dropped.alias("rows_dropped"),
        F.round(percent, 2).alias("percent_dropped"),
        drop_severity(percent).alias("severity"),
        (percent > WARNING_UP_TO).alias("halt"),
    )


def audit_log(gate: DataFrame, flags: DataFrame) -> DataFrame:
    """The gate with the number of flagged values (one row) and the overall health.

    FAIL when the gate says halt, WARN when it warns or values were flagged.
    """
    flagged = flags.toDF("flags_triggered")
    health = (
        F.when(F.col("halt"), "FAIL")
        .when((F.col("severity") == "Warning") | (F.col("flags_triggered") > 0), "WARN")
        .otherwise("PASS")
    )
    return one_row(gate, flagged).withColumn("health", health)


def overall_health(logs: DataFrame) -> DataFrame:
    """The worst health of all datasets."""
    worst = (
        F.when(F.max(F.col("health") == "FAIL"), "FAIL")
        .when(F.max(F.col("health") == "WARN"), "WARN")
        .otherwise("PASS")
    )
    return logs.agg(
        F.count(F.lit(1)).alias("datasets"),
        F.sum("rows_dropped").alias("rows_dropped"),
        F.sum("flags_triggered").alias("flags_triggered"),
        worst.alias("health"),
    )


def relationship_check(
    child: DataFrame, parent: DataFrame, on: Sequence[str], name: str
) -> DataFrame:
    """A many-to-one relationship: the parent key is unique and no child is orphaned.

    A NULL child key refers to nothing and is counted apart from orphans. Both sides
    meet as counts per key in one aggregate, so each is read once and a hot key is one row.
    """
    complete = F.lit(True)
    for column in on:
        complete = complete & F.col(column).isNotNull()
    children, parents = F.col("_children"), F.col("_parents")
    sides = child.select(*on, F.lit(1).alias("_children"), F.lit(0).alias("_parents")).union(
        parent.select(*on, F.lit(0), F.lit(1)))
    per_key = sides.groupBy(*on).agg(
        F.sum(children).alias("_children"), F.sum(parents).alias("_parents"))
    return per_key.agg(
        F.coalesce(F.sum(children), F.lit(0)).alias("child_rows"),
        F.coalesce(F.sum(F.when(~complete, children)), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.when(complete & (parents == 0), children)), F.lit(0)).alias("orphans"),
        F.count_if(parents > 1).alias("repeated_parents"),
    ).select(
        F.lit(name).alias("relationship"), "child_rows", "null_keys", "orphans",
        "repeated_parents",
        F.when((F.col("orphans") == 0) & (F.col("repeated_parents") == 0), "PASS")
        .otherwise("FAIL").alias("status"),
    )
