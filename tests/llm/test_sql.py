"""The queries that SQL can express, against DuckDB."""

from collections import Counter

import duckdb
import pytest

from studylake.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    result = connection.execute(SQL[name])
    columns = [c[0] for c in result.description]
    df = QUERIES[name](spark, small)
    assert sorted(columns) == sorted(df.columns)
    assert Counter(map(tuple, df.select(columns).collect())) == Counter(result.fetchall())
