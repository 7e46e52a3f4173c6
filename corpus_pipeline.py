"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns
the documents it keeps, columns unchanged; the last returns the packed pieces. ``run``
writes every stage as Parquet to the shared folder and rereads it, so a lost executor
costs at most one stage.

Defined results: an empty table gives no pieces; null texts fail the quality rules;
extra columns pass through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from donorlens.llm import decontaminate, line_dedup, packing, quality_rules, simhash
from donorlens.llm.common import read_table, stage
from donorlens.llm.queries import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy of the quality rules."""
    return quality_rules.filter_documents(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; lines that an earlier line repeats are cut from their texts."""
    return line_dedup.deduplicate(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item leaked."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the training sequences."""
    return packing.query(docs, vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

# Fingerprint components, BM25 retrieval and tokenisation are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
