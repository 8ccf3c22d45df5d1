"""Corpus pipeline: quality rules, near-duplicate join, benchmark
decontamination, PII surrogates, sequence packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All stages
but the last return the columns of ``documents``; the last returns the packed
pieces of the documents that are left.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lading.llm import decontaminate, ngram_join, packing, pii, quality_rules
from lading.session import scratch_path
from lading.sources.tables import read_table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that pass the default policy (operator 9)."""
    return quality_rules.filter_documents(docs, quality_rules.POLICIES["default"])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of the n-gram join (operator 2), over
    runs of five words that agree in 80 % (the op2 query has bounds of its own)."""
    return ngram_join.one_per_group(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark passage (operator 1)."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts (operator 8)."""
    return pii.replace_documents(docs, pii.key_of(spark))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into training sequences (operator 3)."""
    return packing.packed_sequences(docs)


STAGES = [("quality_rules", rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("pii", surrogates), ("packing", sequences)]

#: edit search, keyed surrogates and packing have no SQL form; tests/llm holds
#: the pipeline against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    root = scratch_path(spark, f"pipeline-{uuid.uuid4().hex[:12]}")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
