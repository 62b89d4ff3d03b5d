"""The corpus pipeline: quality rules, near-dedup, substring dedup, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept.  All stages but the
last return the columns of documents; the last returns one row for each piece of a packed sequence.
Nulls, empty texts, repeated rows, ties and further columns are handled as the operators' modules say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from annolith.llm import packing, pii, quality, simhash, substring_dedup
from annolith.llm.common import stored, table
from annolith.llm.queries import WORD_BPE


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the policy go."""
    return quality.keep(docs, "corpus-1")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays."""
    return simhash.keep_one(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has go; the documents stay."""
    return substring_dedup.remove(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their place in sequences of 2048 tokens."""
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path(WORD_BPE)))[0]


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup_stage),
    ("PII", personal_data),
    ("best-fit packing", best_fit_packing),
]

#: Tokens and fingerprints are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
