"""The queries of this subpackage and the SQL that some are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function of (spark, folder) under ``name``."""

    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql.strip()
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
