"""The registered queries and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from studylake.bindings.learning import Learning

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Learning`` under ``name``."""

    def register(build: Callable[[Learning], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Learning(spark, folder))
        if sql is not None:
            SQL[name] = sql.strip()
        return build

    return register
