"""Documents in random order over shards, by a two-pass external shuffle.

The shard of a row depends on its key and the number of shards alone: shard s
takes a row when a hash of (key, s) divides by s + 1, and the last such s below
the number of shards holds. One more shard therefore takes rows into itself only.

First pass: rows are scattered by a seeded hash of their key and text into
buckets of about ``BUCKET_BYTES`` within their shard, as many as the shard's
bytes need, so a key with many different rows still fills many buckets. Second
pass: each bucket is put in order, shuffled in memory (Spark's ``shuffle`` is
Fisher-Yates) and written. A row's slot is its place in the bucket after the
rows of the shard's earlier buckets. Only built-in functions are used.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studylake.session import materialize, scratch_folder

BUCKET_BYTES = 8 << 20
SEED = 20240229
#: Bytes that a row counts besides its text.
ROW_BYTES = 16

ADDED = ("size", "text_crc32", "shard", "slot", "grown_shard")


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a key among ``shards``; NULL keys share one."""
    return F.array_max(F.filter(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.pmod(F.xxhash64(key, s), s + 1) == 0)).cast("int")


def shuffle_into_shards(
    docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text",
    seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, path: str | None = None,
) -> DataFrame:
    """Writes every row of ``docs`` to its shard and returns the table.

    All columns stay; added are ``size`` (UTF-8 bytes of the text plus 16),
    ``text_crc32``, ``shard``, ``slot`` (without gaps from 0 in each shard) and
    ``grown_shard`` (the shard if there were one more); they replace columns of
    those names. A NULL text has no bytes and the checksum 0. Repeated rows are
    all kept, and such as agree in key and text share a bucket. The files lie
    under ``path``, or in the shared scratch folder, in one folder per shard.
    The order is the same for the same rows, seed and number of buckets.
    """
    carried = [c for c in docs.columns if c not in ADDED]
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        *carried,
        (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        shard_of(F.col(key), shards).alias("shard"),
        shard_of(F.col(key), shards + 1).alias("grown_shard"))

    # at most one row per shard
    weights = rows.groupBy("shard").agg(
        F.greatest(F.ceil(F.sum("size") / bucket_bytes), F.lit(1)).cast("int").alias("_llm_buckets"))
    weights = materialize(weights)
    total = weights.agg(F.sum("_llm_buckets")).first()[0] or 1

    scattered = rows.join(F.broadcast(weights), "shard").withColumn(
        "_llm_bucket", F.pmod(F.xxhash64(F.lit(seed), key, "text_crc32", "size"), F.col("_llm_buckets")))
    fields = [*carried, "size", "text_crc32", "grown_shard"]
    mixed = (
        scattered.repartition(int(total), "shard", "_llm_bucket")
        .sortWithinPartitions("shard", "_llm_bucket", key, "text_crc32", "size")
        .groupBy("shard", "_llm_bucket").agg(F.collect_list(F.struct(*fields)).alias("_llm_rows"))
        .select("shard", "_llm_bucket", F.posexplode(F.shuffle("_llm_rows", F.lit(seed))).alias("_llm_place", "_llm_row"))
        .select(*[F.col("_llm_row")[c].alias(c) for c in fields], "_llm_bucket", "_llm_place", "shard"))
    path = path or f"{scratch_folder(docs.sparkSession)}/{uuid.uuid4().hex}"
    mixed.write.partitionBy("shard").parquet(path)
    schema = T.StructType([f for f in mixed.schema.fields if f.name != "shard"]).add(
        "shard", T.IntegerType())
    written = docs.sparkSession.read.schema(schema).parquet(path)

    before = Window.partitionBy("shard").orderBy("_llm_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = written.groupBy("shard", "_llm_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        "shard", "_llm_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_llm_start"))
    return written.join(materialize(starts), ["shard", "_llm_bucket"]).select(
        *carried, "size", "text_crc32", "shard",
        (F.col("_llm_start") + F.col("_llm_place")).cast("long").alias("slot"), "grown_shard")
