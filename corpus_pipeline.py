"""Training sequences from raw documents: the stages of the pipeline, in order.

Each stage takes the documents that the stage before has kept and written, and calls one operator.
All stages but the last return the columns of the documents table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from voxtable.llm import exact_dedup, packing, quality_rules, secret_scan, simhash
from voxtable.sources.tables import materialize, work_tables

VOCABULARY = "word_bpe_49k.json"


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a quality rule go."""
    return quality_rules.filter_documents(docs)


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_duplicates(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints stays, the one with the smallest id."""
    return simhash.drop_near_duplicates(docs, shingle=4, within=4)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; all documents stay."""
    return secret_scan.redact_secrets(docs, chars_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of the documents in sequences, with their ids."""
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY), with_ids=True)


STAGES = [
    ("quality rules", reject_low_quality),
    ("exact dedup", remove_copies),
    ("SimHash near-dedup", remove_near_copies),
    ("secret scans", redact_secrets),
    ("packing", pack),
]

# Fingerprints, components and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table; each reads what the one before has written.

    Tables that a stage writes on its way are removed once its documents are written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        with work_tables(spark):
            docs = materialize(stage(spark, docs, sf_dir), keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
