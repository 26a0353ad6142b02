"""One registered query per operator, over the whole of its table."""

from __future__ import annotations

import string
import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake.llm import (
    bpe,
    conversations,
    decontamination,
    html_extraction,
    language_id,
    line_dedup,
    merkle,
    near_dedup,
    oracle,
    quality_rules,
    sharding,
    token_counts,
    url_filters,
    warc,
)
from studylake.llm.registry import QUERIES, SQL, query, table  # noqa: F401
from studylake.session import scratch_folder


@query("op5_quality_rules", oracle.OP5)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = quality_rules.with_verdict(
        quality_rules.with_statistics(docs), known=quality_rules.STATISTICS)
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.col("rejected_by").isNull()).alias("kept"),
    )


@query("op9_line_dedup")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cleaned = line_dedup.remove_repeated_passages(docs)
    return cleaned.select(
        "doc_id", "n_chunks", "n_removed",
        F.length("text").cast("long").alias("n_chars_kept"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


@query("op6_decontamination", oracle.OP6)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.find_contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@query("op3_near_dedup")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), shingle=2, percent=80)


@query("op2_bpe")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, path).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op1_token_counts")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    pieces = token_counts.byte_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, pieces).drop("text")


@query("op10_sharding")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shuffle_into_shards(table(spark, folder, "documents"), shards=40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query("op7_url_filters")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    rules = url_filters.rule_table(spark, {
        "net/": "block", "example.net/en/": "allow", "example.com/de/": "block",
        "org/fr/": "allow"})
    judged = url_filters.judge_urls(table(spark, folder, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "template_share")


@query("op4_warc", oracle.OP4)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    warc.write_warc(warc.plan_records(table(spark, folder, "pages")), path)
    read = warc.read_warc(spark, path, payload="response")

    def page(name: str) -> Column:
        return F.regexp_extract(name, r"^urn:page:(-?\d+)$", 1).try_cast("long")

    return read.select(
        page("record_id").alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("long"), "payload_bytes").alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), "payload_digest").alias("payload_digest"),
        "record_type", page("refers_to").alias("refers_to"))


@query("op8_language_id")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    train = docs.filter(~F.coalesce(held_out, F.lit(False))).select("doc_id", "text", "lang")
    model = language_id.fit(train)
    asked = docs.select("doc_id", held_out.alias("held_out"), "text")
    return language_id.predict(asked, model).select(
        "doc_id", "held_out", "lang_pred", "score", "entropy", "rejected")


@query("op13_merkle_manifest", oracle.OP13)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    fields = {f: F.col(f) for f in merkle.FIELDS} | {
        "text": F.when(tampered, lowered).otherwise(F.col("text"))}
    found = merkle.manifest(docs, carry={
        "doc_id": F.col("doc_id"), "found_leaf": merkle.leaf_hash(*fields.values())})
    folded = merkle.fold(F.col("found_leaf"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_hash(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


@query("op12_conversation_repair")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    damaged, left = conversations.damage(table(spark, folder, "conversations"))
    return conversations.repair_conversations(damaged, present=left).conversations


@query("op11_html_extraction")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return html_extraction.extract_main_text(pages)
