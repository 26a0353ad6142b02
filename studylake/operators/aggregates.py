"""Aggregate shapes the layers share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def measure_count(df: DataFrame, *dims: str) -> DataFrame:
    """The COUNT(*) measure over any dimension columns."""
    return df.groupBy(*dims).agg(F.count(F.lit(1)).alias("count"))


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by several rows, with their row count."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
        .filter(F.col("duplicate_count") > 1)
    )


def duplicate_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: duplicated keys, rows on them, rows beyond the first of each."""
    groups = duplicate_groups(df, keys)
    n = F.col("duplicate_count")
    return groups.agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum(n), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(n - 1), F.lit(0)).alias("excess_rows"),
    )


def parent_mapping(df: DataFrame, child: str, parents: Sequence[str]) -> DataFrame:
    """How many distinct parent tuples each child value has, and the smallest of them."""
    pairs = df.select(child, *parents).distinct().filter(F.col(child).isNotNull())
    return pairs.groupBy(child).agg(
        F.count(F.lit(1)).alias("mapping_count"), *[F.min(p).alias(p) for p in parents]
    )

