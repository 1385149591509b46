"""Corpus pipeline over ``documents``: each stage works on all that the one before it kept.

A document that a stage rejects is gone for the next; all stages but the last return the columns of
``documents``, the last one the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revlens.llm.common import prepare, scratch, table
from revlens.llm.decontam import drop_contaminated
from revlens.llm.exact_dedup import drop_copies
from revlens.llm.ngram_join import drop_near_copies
from revlens.llm.packing import pack
from revlens.llm.quality_crf import drop_bad

#: SQL can't express the classifier and the tokenizer.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier, trained on the labels of the table, rejects go."""
    prepare(spark)
    return drop_bad(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest id stays."""
    prepare(spark)
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word shingles connect at a similarity of 0.8 or more, the smallest id stays."""
    prepare(spark)
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepare(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, tokenised and packed into windows of 2048 tokens."""
    prepare(spark)
    return pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
