"""Registered queries of the training-data operators.

Each applies its operator with production parameters to the whole table and
derives the contract's digest columns.  Only operators that SQL can express
have an ORACLE entry; the others are held against brute force in tests/llm.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens.llm import (
    collocations, conversation_repair, decontamination, embedding_dedup, language, packing, pii, quality, sentencepiece_bpe,
    sharding, simhash, url_filter, warc)
from streamlens.llm.common import table

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"
PII_KEY = "registered-query"  # callers of the operator pass their own secret
QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(TOKENIZER)).withColumn(
        "ids_crc32", F.crc32("token_ids"))


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"), quality.rating())
    return quality.score(docs, model, keep_text=False)


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "fingerprint", "component_id")


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = warc.write_packages(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    found = warc.read_packages(spark, packages)
    # a response is measured on the payload read back, a revisit has its headers only
    return found.select(
        F.col("page_id").cast("long"),
        F.coalesce(F.octet_length("payload").cast("long"), "payload_bytes").alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), "payload_digest").alias("payload_digest"),
        "record_type", F.col("refers_to").cast("long"))


@query
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pii.replace_entities(docs, PII_KEY, count_col="n_entities")


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = language.predict(docs, language.train(docs))
    return found.select("doc_id", language.is_held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))
    return sharding.feistel_shards(rows, 8, seed=42, order_by=["doc_id", "text_hash"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return url_filter.judge(url_filter.page_captures(pages), url_filter.page_entries(pages))


@query
def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = sentencepiece_bpe.encode(docs, public_tokenizers.path(PIECES), decoded_col="decoded")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, dropped = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    found = conversation_repair.report(conversation_repair.repair(rows, absent=dropped))
    return found.withColumnRenamed("conv", "conv_id")


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents", "text", "lang"))


ORACLE["op9_url_filter"] = url_filter.ORACLE
ORACLE["op13_collocations"] = collocations.ORACLE
ORACLE["op12_conversations"] = conversation_repair.ORACLE
