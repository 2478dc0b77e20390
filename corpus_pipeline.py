"""The corpus pipeline: a fixed chain of the training-data operators over ``documents``.

Every stage works on all that the stage before kept; its rows are written as
Parquet to the shared folder and read again as the next one's documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelcast.llm import decontaminate, mixing, near_dedup, quality, token_files
from panelcast.llm.common import documents, table
from panelcast.llm.queries import TOKENIZER
from panelcast.session import ensure_checkpoint_dir, ship_package

#: Near copies share this percentage of their five-word shingles at least; 85 is op7's alone.
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lose most of their words with frequent lines go."""
    ship_package(spark)
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    ship_package(spark)
    return near_dedup.drop_near_duplicates(docs, NEAR_PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    ship_package(spark)
    return mixing.mix_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files, and where in them each document lies."""
    ship_package(spark)
    return token_files.token_output(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mix),
    ("token-ID / binary output", token_output),
]

#: SQL can express neither the hashed mix nor the tokenizer; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/stage-{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
