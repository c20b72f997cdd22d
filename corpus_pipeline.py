"""Corpus pipeline: raw documents to packed training sequences.

Each stage reads what its predecessor kept, from a Parquet table in the
shared folder that ``spark.checkpoint.dir`` names.  All but the last return
the columns of ``documents``.

Null and empty texts fail the quality rules.  Null ids and sources, repeated
rows, ties and columns of other names are treated as the operators' docstrings
say (a null id is a document of its own; repeated rows are copies, of which one
stays).  An empty table, or one of which nothing is kept, gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import language, near_dedup, packing, quality, substring_dedup
from ledgerline.llm.shared import prepare, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; boilerplate lines go from the rest."""
    prepare(spark)
    return quality.clean(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no known language go."""
    return language.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return near_dedup.representatives(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds go from the texts."""
    return substring_dedup.without_repeated_words(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences, one row per piece of a document, with its ids."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("packing", packed),
]

#: Language identification fits a model and packing reads a vocabulary: SQL
#: expresses neither.  ``tests/llm/test_pipeline_stages.py`` holds each stage
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, "stage-" + name.replace(" ", "-"))
    return docs
