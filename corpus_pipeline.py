"""A corpus from raw documents to token ids, in stages that each write a table.

Every stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet to the shared folder and
reads again as the docs of the next stage. All but the last return the columns
of ``documents``. ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake.llm import bpe, decontamination, line_dedup, near_dedup, quality_rules
from studylake.session import materialize

#: The vocabulary file of the last stage.
VOCABULARY = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that a quality rule rejects."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated passages out; a document of which nothing is left goes too."""
    cleaned = line_dedup.remove_repeated_passages(docs)
    left = (F.col("n_removed") == 0) | (F.size(quality_rules.words(F.col("text"))) > 0)
    text = F.col("text")
    return cleaned.filter(left).select(
        "doc_id", "text", "lang", "source",
        F.when(F.col("n_removed") > 0, F.length(text).cast("long"))
        .otherwise(F.col("n_chars")).alias("n_chars"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share 80 % of their five-word shingles, the first stays."""
    return near_dedup.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents with ten words in a row of a benchmark item, or a shorter item."""
    return decontamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, packed, with their number and the text they decode to."""
    path = public_tokenizers.path(VOCABULARY)
    return bpe.round_trip(docs, path).withColumn("n_tokens", F.floor(F.octet_length("ids") / 4)).select(
        "doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "decoded")


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near dedup", near_copies),
    ("decontamination", benchmark),
    ("bpe", tokens),
]

#: No SQL expresses the chunk boundaries, the sketches or the token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
