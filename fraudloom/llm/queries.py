"""Registered queries: each operator over its whole table, with digests of its outputs."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudloom.llm import (
    bpe, covertree, hnsw, licenses, linededup, mixing, quality_model, quality_rules, simhash, speculative, tokencount,
    tokenfile, vectorcode,
)
from fraudloom.session import prepare

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
TOKEN_LIMIT = 1024


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def encoded_digests(docs: DataFrame) -> DataFrame:
    """Digests of the ids of every text and of the bytes they decode to."""
    return bpe.round_trip(docs.select("doc_id", "text"), RANKS, public_tokenizers.PATTERN).select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(_table(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_vectors(_table(spark, sf_dir, "embeddings"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokenfile.write_token_files(_table(spark, sf_dir, "documents"), WORD_BPE, END_ID)
    return tokenfile.read_token_files(manifest)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokencount.count_tokens(_table(spark, sf_dir, "documents"), BYTE_BPE)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return covertree.hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op12_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = speculative.encode(docs, BYTE_BPE).select("doc_id", "ids")
    return speculative.decode(ids, BYTE_BPE).select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, _ = vectorcode.compress(_table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", "codebooks_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_byte_bpe, op2_embedding_near_dedup, op3_license_scan, op4_line_dedup, op5_token_files, op6_mix_sources,
        op7_token_counts, op8_quality_classifier, op9_quality_rules, op10_simhash_near_dedup,
        op11_hard_negatives, op12_speculative_bpe, op13_vector_codes)
}
