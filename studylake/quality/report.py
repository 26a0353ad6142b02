"""From a one-row vector of counts to one row per check."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studylake.functions import columns as fx


def one_row(*frames: DataFrame) -> DataFrame:
    """One-row frames side by side: stacked, then the only value of each column kept."""
    if len(frames) == 1:
        return frames[0]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def dq_stats(
    df: DataFrame, rules: Mapping[str, Column], total: str = "total_records"
) -> DataFrame:
    """Row count and violations of every rule in a single pass; one row."""
    return df.agg(
        F.count(F.lit(1)).alias(total),
        *[F.count_if(fx.present(rule)).alias(name) for name, rule in rules.items()],
    )


@dataclass(frozen=True)
class Spec:
    """One line of a structured report.

    ``count`` names the metric that counts violations; on TABLE level it names
    a metric that must not be zero instead, unless ``broken`` gives the condition.
    Judged by ``warn``/``fail`` rates or by ``severity``, whichever the report uses.
    """

    category: str
    name: str
    count: str
    description: str
    level: str = "ROW"
    total: str = "total_records"
    warn: float | None = None
    fail: float | None = None
    severity: str | None = None
    ready: Callable[[], Column] | None = None
    broken: Callable[[], Column] | None = None

    def violations(self) -> Column:
        if self.level == "ROW":
            return F.col(self.count)
        broken = F.col(self.count) == 0 if self.broken is None else self.broken()
        return F.when(broken, 1).otherwise(0)

    def row(self) -> Column:
        return F.struct(
            F.lit(self.category).alias("check_category"),
            F.lit(self.name).alias("check_name"),
            F.lit(self.level).alias("check_level"),
            F.col(self.total).cast("bigint").alias("total_records"),
            self.violations().cast("bigint").alias("violations"),
            F.lit(self.warn).cast("double").alias("warn"),
            F.lit(self.fail).cast("double").alias("fail"),
            F.lit(self.severity).cast("string").alias("severity"),
            (F.lit(True) if self.ready is None else fx.present(self.ready())).alias("ready"),
            F.lit(self.description).alias("description"),
        )


def dq_rows(stats: DataFrame, specs: Sequence[Spec]) -> DataFrame:
    """One row per check from the one-row ``stats``, which is computed once."""
    return stats.select(F.inline(F.array(*[s.row() for s in specs])))


def violation_rate(evaluated: Column) -> Column:
    """Violations per row, on ROW level, where the check could be evaluated."""
    applies = (F.col("check_level") == "ROW") & (F.col("total_records") > 0) & evaluated
    return F.when(applies, fx.rate(F.col("violations"), F.col("total_records")))


def status_by_threshold() -> Column:
    rate = F.col("violation_rate")
    return (
        F.when(
            F.col("check_level") == "TABLE",
            F.when(F.col("violations") > 0, "FAIL").otherwise("PASS"),
        )
        .when((F.col("total_records") == 0) | ~F.col("ready"), "NOT_EVALUATED")
        .when(rate > F.col("fail"), "FAIL")
        .when(rate > F.col("warn"), "WARNING")
        .otherwise("PASS")
    )


def status_by_severity() -> Column:
    empty = (F.col("check_level") == "ROW") & (F.col("total_records") == 0)
    return (
        F.when(empty | ~F.col("ready"), "NOT_EVALUATED")
        .when(F.col("violations") == 0, "PASS")
        .otherwise(F.col("severity"))
    )


def _result(rows: DataFrame, layer: str, table: str, checked_at: Column | None) -> DataFrame:
    return rows.select(
        F.lit(layer).alias("layer_name"),
        F.lit(table).alias("table_name"),
        "check_category", "check_name", "check_level", "status", "total_records",
        "violation_count", "violation_rate",
        F.col("warn").alias("warning_threshold"),
        F.col("fail").alias("fail_threshold"),
        "description",
        (F.current_timestamp() if checked_at is None else checked_at).alias("checked_at"),
    )


def threshold_report(
    stats: DataFrame,
    specs: Sequence[Spec],
    layer: str,
    table: str,
    checked_at: Column | None = None,
) -> DataFrame:
    """Checks judged by how large a share of the rows violates them."""
    rows = (
        dq_rows(stats, specs)
        .withColumn("violation_rate", violation_rate(F.col("ready")))
        .withColumn("status", status_by_threshold())
        .withColumn("violation_count", F.when(F.col("ready"), F.col("violations")))
    )
    return _result(rows, layer, table, checked_at)


def severity_report(
    stats: DataFrame,
    specs: Sequence[Spec],
    layer: str,
    table: str,
    checked_at: Column | None = None,
) -> DataFrame:
    """Checks where one violation is enough for the check's own severity."""
    by_row = F.col("check_level") == "ROW"
    evaluated = F.col("status") != "NOT_EVALUATED"
    rows = (
        dq_rows(stats, specs)
        .withColumn("status", status_by_severity())
        .withColumn("violation_rate", violation_rate(evaluated))
        .withColumn("violation_count", F.when(evaluated, F.col("violations")))
        .withColumn("warn", F.when(by_row & (F.col("severity") == "WARNING"), F.lit(0.0)))
        .withColumn("fail", F.when(by_row & (F.col("severity") == "FAIL"), F.lit(0.0)))
    )
    return _result(rows, layer, table, checked_at)
