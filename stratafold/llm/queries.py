"""The operators applied to the whole of their tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratafold.llm import chat_format, exact_topk, merkle_manifest
from stratafold.llm.decontamination import leaks
from stratafold.llm.license_scan import documents_as_files, scan_licenses
from stratafold.llm.packing import pack
from stratafold.llm.quality_classifier import classify
from stratafold.llm.secret_scan import scan_secrets
from stratafold.llm.shared import table
from stratafold.llm.simhash_dedup import near_duplicates
from stratafold.llm.source_mixing import mixed_sizes
from stratafold.llm.suffix_dedup import repeated_strings
from stratafold.llm.tokens import token_counts
from stratafold.llm.whitening import whiten


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(table(spark, sf_dir, "conversations"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_strings(table(spark, sf_dir, "documents")).drop("spans")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents_as_files(table(spark, sf_dir, "documents"))).withColumnRenamed("file_id", "doc_id")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest(table(spark, sf_dir, "documents")).drop("proof")


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_sizes(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_simhash_dedup,
        op3_token_counts,
        op4_packing,
        op5_exact_topk,
        op6_chat_format,
        op7_suffix_dedup,
        op8_quality_classifier,
        op9_license_scan,
        op10_decontamination,
        op11_merkle_manifest,
        op12_source_mixing,
        op13_whitening,
    )
}
SQL = {
    "op5_exact_topk": exact_topk.SQL,
    "op6_chat_format": chat_format.SQL,
    "op11_merkle_manifest": merkle_manifest.sql(),
}
