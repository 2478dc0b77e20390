"""The registered queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    chat, decontaminate, filter_audit, katz, mixing, near_dedup, orchard, packing, quality, suffix_dedup, suffix_trees, token_counts,
    token_files,
)
from .common import documents, table

TOKENIZER = "byte_bpe_50k.json"


def op1_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair_conversations(table(spark, sf_dir, "conversations"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    read_back = token_files.token_output(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))
    return read_back.select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(documents(spark, sf_dir))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir), texts=False)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op9_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(documents(spark, sf_dir))


def op10_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_trees.remove_repeats(documents(spark, sf_dir), texts=False)


def op11_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_report(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op12_orchard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.cluster_report(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_chat_repair": op1_chat_repair,
    "op2_token_files": op2_token_files,
    "op3_katz_scores": op3_katz_scores,
    "op4_quality_rules": op4_quality_rules,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op7_near_dedup": op7_near_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_weighted_mix": op9_weighted_mix,
    "op10_suffix_trees": op10_suffix_trees,
    "op11_nnls_packing": op11_nnls_packing,
    "op12_orchard_clusters": op12_orchard_clusters,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE = {
    "op4_quality_rules": quality.ORACLE,
    "op12_orchard_clusters": orchard.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
