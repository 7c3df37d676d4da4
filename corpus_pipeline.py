"""Corpus pipeline: documents to packed sequences, in five stages.

Every stage takes ``(spark, docs, sf_dir)``, applies one operator to all rows
of ``docs`` and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``.  The first four return rows of ``docs``
with all their columns; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from runledger.llm import (
    block_naming, bm25_packing, count_tree, spaced_seeds, weak_quality)
from runledger.llm.common import documents, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str
                       ) -> DataFrame:
    """Documents that the weak-label classifier rejects go."""
    return weak_quality.reject_junk(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str
                ) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return block_naming.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str
               ) -> DataFrame:
    """Of each group of near duplicates (word 5-grams, Jaccard similarity of
    0.8 or more, linked transitively), the smallest doc_id stays."""
    return count_tree.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str
                    ) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return spaced_seeds.decontaminate(docs, table(spark, sf_dir, "benchmark"),
                                      by_row=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All ids of what is left, in sequences of 1024."""
    return bm25_packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# EM, gradient descent, a byte-pair tokenizer and greedy packing have no
# equivalent in SQL; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, on the documents table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
