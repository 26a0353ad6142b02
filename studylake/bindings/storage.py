"""Sources and sinks over whole driver tables, written to the scratch folder and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studylake.bindings import quality  # noqa: F401  (registers the report that is stored here)
from studylake.bindings.learning import AS_OF, Learning
from studylake.bindings.registry import SQL, query
from studylake.quality import structured
from studylake.session import scratch_folder
from studylake.sources import raw, tables


def _place(t: Learning, name: str = "table") -> str:
    return f"{scratch_folder(t.spark)}/{uuid.uuid4().hex}/{name}"


def _moment(day: str = AS_OF):
    return F.lit(day).cast("timestamp")


def _write_csv(df: DataFrame, path: str, most: int = 0) -> None:
    """``df`` as CSV files, each of ``most`` rows at most (0: no limit)."""
    df.write.option("header", True).option("escape", '"').option("maxRecordsPerFile", most).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


@query("csv_roundtrip", """
SELECT doc_id, md5(text) AS digest, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents""")
def csv_roundtrip(t: Learning) -> DataFrame:
    """Texts with quotes, commas and line breaks, through a raw file with declared columns."""
    path = _place(t, "raw files")
    _write_csv(t.table("documents"), path)
    schema = "doc_id bigint, text string, lang string, source string, n_chars string"
    read = raw.read_raw(t.spark, path, schema, multiline=True)
    return read.select("doc_id", F.md5("text").alias("digest"), "lang", "source", "n_chars")


@query("csv_inferred", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders""")
def csv_inferred(t: Learning) -> DataFrame:
    path = _place(t)
    _write_csv(t.table("orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), path)
    read = raw.read_raw(t.spark, path, infer=True)
    kinds = dict(read.dtypes)
    whole = [c for c in ("o_orderkey", "o_custkey") if kinds[c] in ("int", "bigint")]
    return read.select(*[F.col(c).cast("bigint") for c in whole], "o_orderstatus", "o_orderpriority")


_COUNTED = ("region", "nation", "customer", "orders", "lineitem", "events")

#: Rows of a file at most; smaller tables become about three files.
_FILE_ROWS = 1_000_000


def _file_rows(df: DataFrame) -> int:
    return min(df.count() // 3 + 1, _FILE_ROWS)


@query("csv_source_counts", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, DATE '2024-01-09' AS LoadDate, count(*) AS row_count FROM {name}"
    for name in _COUNTED))
def csv_source_counts(t: Learning) -> DataFrame:
    """Rows per file, in folders whose names need encoding, summed by table."""
    found = None
    for name in _COUNTED:
        path = _place(t, f"{name} 100%20 \u00e9t\u00e9")
        _write_csv(t.table(name), path, _file_rows(t.table(name)))
        counts = raw.source_row_counts(
            t.spark, path, raw.load_date(_moment().cast("date")), _moment())
        counts = counts.groupBy(F.lit(name).alias("table_name"), "LoadDate").agg(
            F.sum("row_count").alias("row_count"))
        found = counts if found is None else found.unionByName(counts)
    return found


@query("bronze_create_once", """
SELECT c_custkey, c_name, c_nationkey, TIMESTAMP '2024-01-10 00:00:00' AS ingestion_timestamp,
       DATE '2024-01-10' AS ingestion_date FROM customer""")
def bronze_create_once(t: Learning) -> DataFrame:
    """The second load of a table that exists changes nothing."""
    lake = tables.Lake(t.spark, _place(t, "lake"))
    source = t.table("customer").select("c_custkey", "c_name", "c_nationkey")
    lake.create("bronze", "customer", tables.ingest_bronze(source, _moment()))
    return lake.create("bronze", "customer", tables.ingest_bronze(
        source.filter("c_custkey % 2 = 0"), _moment("2024-01-11")))


@query("overwrite_table", """
SELECT CAST(o_orderkey AS INT) AS o_orderkey, o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice
FROM orders""")
def overwrite_table(t: Learning) -> DataFrame:
    """A table with declared types, filled and then replaced as a whole."""
    path, orders = _place(t), t.table("orders")
    schema = "o_orderkey int, o_orderpriority varchar(20), o_totalprice decimal(18,2)"
    tables.overwrite_table(orders.filter("o_orderkey % 2 = 0"), schema, path)
    tables.overwrite_table(orders, schema, path)
    return t.spark.read.parquet(path)


@query("append_results", f"""
WITH once AS ({SQL['dq_threshold_report']})
SELECT * FROM once UNION ALL SELECT * REPLACE (TIMESTAMP '2024-01-11 00:00:00' AS checked_at) FROM once""")
def append_results(t: Learning) -> DataFrame:
    """The log of two runs, the first of which was repeated."""
    path = _place(t)
    for day in (AS_OF, AS_OF, "2024-01-11"):
        tables.append_results(structured.bronze_assessment_report(
            t.bronze["assessments"], t.bronze["courses"], _moment(day)), path)
    return tables.read_results(t.spark, path)
