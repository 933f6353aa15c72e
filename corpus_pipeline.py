"""Corpus pipeline: quality, language, near duplicates, benchmark leaks, packing.

Each stage is one of the corpus operators on all rows that the stage before it
kept. Its result is written as Parquet to the shared scratch folder and read
again, so a stage never recomputes its predecessors and a lost executor costs
one stage's tasks. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skewkit.llm import decontaminate, jaccard_join, langid, packing, quality
from skewkit.llm.common import read_table, staged
from skewkit.llm.queries import BYTE_BPE_END


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality classifier accepts."""
    return quality.accepted_documents(docs, read_table(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents written in one of the learned languages."""
    return langid.accepted_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return jaccard_join.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents without a passage of the benchmark."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut what is left into sequences of power-of-two lengths."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), BYTE_BPE_END, special_tokens=True)


STAGES = [
    ("quality classifier", quality_stage),
    ("language id", language_stage),
    ("n-gram jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Trained models, a tokenizer and a signature join: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, on ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
