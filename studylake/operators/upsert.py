"""MERGE semantics over plain DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studylake.session import materialize


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` unchanged, failing at run time if a key occurs twice.

    The check reads the key columns alone and travels as a one-row subquery.
    """
    worst = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n"))
    message = F.lit(f"several source rows for one key ({', '.join(keys)})")
    return df.filter(
        F.when(worst.scalar() > 1, F.raise_error(message).cast("boolean")).otherwise(True)
    )


def merge_upsert(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    check: bool = True,
) -> DataFrame:
    """Target rows updated by matching source rows, plus the unmatched source rows.

    Nothing is deleted. NULL keys never match. ``update_cols`` limits what a match
    replaces (default: every non-key column). A small ``source`` leaves the target
    unshuffled, since the adaptive planner broadcasts it by its measured size.
    """
    if check:
        source = require_unique(source, keys)
    if target is None:
        return source
    columns = target.columns
    incoming = source.select(*columns)
    kept = target.join(incoming.select(*keys), list(keys), "left_anti").select(*columns)
    payload = [c for c in columns if c not in keys]
    if update_cols is None or set(update_cols) >= set(payload):
        return kept.unionByName(incoming)
    old = target.select(*keys, F.struct(*payload).alias("_old"))
    merged = incoming.join(old, list(keys), "left").select(*[
        F.col(c)
        if c in keys or c in update_cols
        else F.when(F.col("_old").isNull(), F.col(c)).otherwise(F.col(f"_old.{c}")).alias(c)
        for c in columns
    ])
    return kept.unionByName(merged)


#: The column by which a partitioned table's folders are named.
PART = "_part"


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """A part for keys without an order: a hash of them, NULL included."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def key_range(key: Column, width: int) -> Column:
    """A part for a key that grows with time, so that a batch touches few: runs of ``width`` numbers or days."""
    return F.floor(key / width)


def read_partitions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a table that ``upsert_partitions`` keeps, without its part column."""
    return _stored(spark, path, schema).drop(PART)


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(PART, T.StringType())])).parquet(path)


def _is_there(path: str) -> bool:
    files, folder = fs.FileSystem.from_uri(path)
    return files.get_file_info(folder).type == fs.FileType.Directory


def upsert_partitions(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    by: Column,
    update_cols: Sequence[str] | None = None,
    check: bool = True,
) -> list[str]:
    """Merge ``batch`` into the table at ``path``, rewriting only the parts that hold its keys.

    Semantics are those of ``merge_upsert``. ``by`` names a row's part and may use key columns only, so that a
    key's old and new row are in one part; it has to stay the same for the table's life. The parts of the
    batch are listed (no more than the table has), their files alone are read and merged, and a dynamic
    partition overwrite puts the new files in place of the old ones when all are written; other parts keep
    their files. A part is rebalanced into several files where it is large. A run that was lost while files were
    being moved can be repeated with the same batch, but for its rows with NULL keys, which never match and
    are inserted each time. Returns the rewritten parts.
    """
    spark, columns = batch.sparkSession, batch.columns
    placed = by.cast("string").alias(PART)
    batch = materialize((require_unique(batch, keys) if check else batch).select(*columns, placed))
    touched = [r[0] for r in batch.select(PART).distinct().collect()]
    if not touched and _is_there(path):
        return []
    merged = batch
    if _is_there(path):
        names = [t for t in touched if t is not None]
        hit = F.col(PART).isin(names) if names else F.lit(False)
        if None in touched:
            hit = hit | F.col(PART).isNull()
        old = _stored(spark, path, T.StructType(batch.schema.fields[:-1])).filter(hit)
        merged = merge_upsert(
            old.select(*columns), batch.select(*columns), keys, update_cols, check=False).select(*columns, placed)
    merged.hint("rebalance", PART).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
    return sorted(touched, key=lambda t: (t is not None, t or ""))
