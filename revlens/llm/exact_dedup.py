"""Exact deduplication: 128-bit content hash groups, smallest or largest stable id kept, bytes compared.

Texts are equal when their UTF-8 bytes are.  A null text counts as empty; empty texts are equal to each
other.  A null id never stays when the group has another id; ties (repeated ids) are one id.  An empty
table gives an empty result.  Only the id and text columns are read, so others can't clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import broadcast_if_small, id_text, scratch, without


def content_hash(text: Column) -> Column:
    """128-bit content hash."""
    return F.md5(text)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                 hash_fn: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    1. Grouping by (hash, length) moves narrow rows only and folds a hot group to one row per map task.
    2. Texts whose (hash, length) occurs again, and no others, are grouped with the text itself, which compares the
       bytes; partial aggregation folds their copies too.  They are found by a join with those (hash, length)s, which
       are broadcast when counting finds them few.
    3. A join of narrow rows gives every document its group.  The join key holds the length too, so both sides are
       exchanged for it and adaptive execution can split a hot group.
    4. A hash that covers different texts (a collision) is resolved by a join on the text, for those
       hashes only.
    """
    pick = {"largest": F.max, "smallest": F.min}[keep]
    base = id_text(docs, id_col, text_col)
    rows = base.select("doc_id", "text", hash_fn(F.col("text")).alias("h"), F.octet_length("text").alias("n"))
    by_hash = scratch(rows.groupBy("h", "n").agg(pick("doc_id").alias("keep_id"), F.count("*").alias("group_size")),
                      "exact-groups")
    again = scratch(by_hash.where("group_size > 1").select("h", "n"), "exact-again")
    compared = rows.join(broadcast_if_small(again), ["h", "n"], "left_semi").groupBy("h", "n", "text").agg(F.lit(1).alias("one"))
    clash = scratch(compared.groupBy("h", "n").agg(F.count("*").alias("texts")).where("texts > 1").select("h", "n"), "exact-clash")
    narrow = rows.select("doc_id", "h", "n", F.sha2("text", 256).alias("text_sha256"))
    out = ["doc_id", "keep_id", "group_size", "text_sha256"]
    if not clash.limit(1).count():
        found = narrow.join(by_hash, ["h", "n"]).select(out)
    else:
        clash = broadcast_if_small(clash)
        clashing = rows.join(clash, ["h", "n"], "left_semi")
        texts = clashing.groupBy("h", "n", "text").agg(pick("doc_id").alias("keep_id"),
                                                       F.count("*").alias("group_size"))
        found = narrow.join(by_hash.join(clash, ["h", "n"], "left_anti"), ["h", "n"]).select(out).union(
            clashing.join(texts, ["h", "n", "text"]).withColumn("text_sha256", F.sha2("text", 256)).select(out))
    return found.select("doc_id", "keep_id", "group_size",
                        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
                        "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` whose id stays, all columns.  Ids are taken to be unique; rows that repeat as a whole are
    one."""
    groups = exact_groups(docs, id_col, text_col, keep)
    kept = without(docs, groups.where(~F.col("kept")), id_col)
    twice = scratch(docs.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias("times")).where("times > 1")
                    .select(id_col), "exact-twice")
    if not twice.limit(1).count():
        return kept
    twice = broadcast_if_small(twice)
    return kept.join(twice, id_col, "left_anti").select(docs.columns).union(
        kept.join(twice, id_col, "left_semi").select(docs.columns).dropDuplicates())
