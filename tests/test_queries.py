"""Every registered query against its SQL, on the smallest driver tables."""

import datetime
import math
import os
from collections import Counter

import pytest

import __spark_entry__ as entry
from studylake.bindings.registry import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# No query pairs rows without a key, gathers a whole table to rank it, or leaves the JVM.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "ntile(", "EvalPython", "InPandas")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables absent")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def bag(rows, columns, order):
    places = [columns.index(c) for c in order]
    return Counter(tuple(plain(r[i]) for i in places) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in UNWANTED if word in plan]
    assert bag(df.collect(), df.columns, order) == bag(result.fetchall(), columns, order)


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_a_changed_threshold_is_noticed(spark, duck, monkeypatch):
    """The SQL of the structured reports does not read the lines under test."""
    import dataclasses

    from studylake.quality import structured

    first, *rest = [s for s in structured.BRONZE_ASSESSMENTS if s.warn is not None]
    others = [s for s in structured.BRONZE_ASSESSMENTS if s is not first]
    monkeypatch.setattr(structured, "BRONZE_ASSESSMENTS",
                        [dataclasses.replace(first, warn=0.77), *others])
    df = QUERIES["dq_threshold_report"](spark, FOLDER)
    result = duck.execute(SQL["dq_threshold_report"])
    columns = [c[0] for c in result.description]
    order = sorted(columns)
    assert bag(df.collect(), df.columns, order) != bag(result.fetchall(), columns, order)
