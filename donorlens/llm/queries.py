"""The registered queries of the text operators: ``(spark, sf_dir) -> DataFrame``.

Each applies its operator with production parameters to the whole table it is meant for.
"""

from __future__ import annotations

import os

from donorlens.llm import (
    collocations, cover_tree, decontaminate, langid, line_dedup, merkle_manifest, packing, quality_model, quality_rules, simhash, suffix_dedup,
    token_files, toxicity,
)
from donorlens.llm.common import read_table
from donorlens.llm.oracle_sql import ORACLE_SQL  # noqa: F401  (re-exported for the entry point)


def vocabulary(name: str) -> str:
    """A public vocabulary file; ``TOKENIZER_DIR`` names another folder that holds it."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark, sf_dir):
    return simhash.query(read_table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark, sf_dir):
    return suffix_dedup.query(read_table(spark, sf_dir, "documents"))


def op3_decontamination(spark, sf_dir):
    return decontaminate.query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_best_fit_packing(spark, sf_dir):
    return packing.query(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op5_line_dedup(spark, sf_dir):
    return line_dedup.query(read_table(spark, sf_dir, "documents"))


def op6_token_files(spark, sf_dir):
    return token_files.query(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op7_language_id(spark, sf_dir):
    return langid.query(read_table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark, sf_dir):
    return quality_model.query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_toxicity(spark, sf_dir):
    return toxicity.query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_quality_rules(spark, sf_dir):
    return quality_rules.query(read_table(spark, sf_dir, "documents"))


def quality_ablations(spark, sf_dir):
    """Per policy and rule: documents that fail it, that the policy rejects, and that it alone rejects."""
    return quality_rules.ablations(quality_rules.ledger(read_table(spark, sf_dir, "documents"), "doc_id"))


def op11_embedding_near_dedup(spark, sf_dir):
    return cover_tree.query(read_table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark, sf_dir):
    return merkle_manifest.query(read_table(spark, sf_dir, "documents"))


def op13_collocations(spark, sf_dir):
    return collocations.query(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_line_dedup": op5_line_dedup,
    "op6_token_files": op6_token_files,
    "op7_language_id": op7_language_id,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_toxicity": op9_toxicity,
    "op10_quality_rules": op10_quality_rules,
    "quality_ablations": quality_ablations,
    "op11_embedding_near_dedup": op11_embedding_near_dedup,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_collocations": op13_collocations,
}
