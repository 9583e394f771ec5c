"""Corpus pipeline: from raw documents to packed training sequences.

Stages, in order: quality classifier (rejected documents go), SimHash near-dedup (one
document of each group stays), personal data (spans are replaced), mixing sources to target
weights (documents repeat or go as the mix says), packing.

A stage is (spark, docs, sf_dir) -> DataFrame and works on all that its predecessor kept;
all but the last return the columns of ``documents``.  ``run`` writes every stage as Parquet to
the shared scratch folder and reads it back as the next one's input, so a lost executor
costs no more than the stage it hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import mixing, packing, pii, quality, simhash
from tessera.llm.common import drop_scratch, scratch_mark, table, written
from tessera.llm.queries import word_tokenizer


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at or above the threshold; learns from the labels outside the held-out fold."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of every group of linked fingerprints."""
    return simhash.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in angle brackets."""
    return pii.redact_documents(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids, in sequences of at most 2048 tokens."""
    return packing.pack(docs, word_tokenizer(), keep_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: A trained classifier, fingerprints and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        mark = scratch_mark()
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}", "zstd")
        drop_scratch(spark, mark, keep=1)  # what the stage wrote on its way
    return docs
