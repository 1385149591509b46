"""The registered queries of the training-data operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import prepare, table
from revlens.llm.decontam import contaminated
from revlens.llm.exact_dedup import exact_groups
from revlens.llm.hard_negatives import hard_negatives
from revlens.llm.hmm_lm import hmm_scores
from revlens.llm.lexical_search import search
from revlens.llm.license_scan import license_scan
from revlens.llm.line_dedup import PASSAGE, line_dedup
from revlens.llm.ngram_join import near_duplicates
from revlens.llm.packing import pack
from revlens.llm.quality_crf import quality
from revlens.llm.quality_rules import quality_rules
from revlens.llm.secret_scan import secret_scan
from revlens.llm.suffix_dedup import suffix_dedup


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def op3_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op6_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return hmm_scores(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"), words=PASSAGE).select(
        "doc_id", "n_lines", "n_removed", "n_runs", F.sha2("text", 256).alias("kept_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pack(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}


def all_oracles() -> dict[str, str]:
    from revlens.llm import oracles

    return {name.lower(): sql for name, sql in vars(oracles).items() if name.startswith("OP")}
