"""Landed page files (S1-S6): one file a page, read whole, with the target and the page number taken from its path.

A crawler leaves many small files.  The text source packs them into scan tasks by size; no listing or content passes
through the driver but the file index that every file source keeps.  Texts are read as they are: one row a file.
Folders are listed by a few tasks a core, many folders each, and files are written as evenly: both cost by the file,
not by the byte.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.session import spread, tasks

#: Path of a page written by ``land_pages``: group 1 the target, group 2 the page number.
PAGE_PATH = r"target=([^/]*)/page_no=(\d+)/[^/]*$"


def _decoded(part: Column) -> Column:
    """A percent-encoded part of a path (a plus is a plus)."""
    return F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))


LISTING_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _texts(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """The files below ``path``, listed here and now.  Spark would start one task a folder, up to 10,000 at a time."""
    before = spark.conf.get(LISTING_CONF, "10000")
    spark.conf.set(LISTING_CONF, str(min(int(before), tasks(spark))))
    try:
        return (spark.read.schema("value string").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
                .text(path, wholetext=True))
    finally:
        spark.conf.set(LISTING_CONF, before)


def read_pages(spark: SparkSession, path: str, source: str, content: str = "html", pattern: str = PAGE_PATH,
               key: str = "target", glob: str = "*", escaped: bool = True) -> DataFrame:
    """Files below ``path`` as landed rows ``(source, <key>, page_no, <content>)``.

    ``pattern`` finds the key and the page number in a file's path; a file whose path it does not fit is an error,
    not a lost page.  ``escaped``: the key's folder name is percent-encoded itself, as partitioned writers do.
    """
    text = _texts(spark, path, glob).select("value", F.col("_metadata.file_path").alias("file"))
    name = _decoded(F.regexp_extract("file", pattern, 1))
    page = F.regexp_extract("file", pattern, 2)
    no_page = F.raise_error(F.concat(F.lit("not the path of a landed page: "), F.col("file"))).cast("int")
    return text.select(F.lit(source).alias("source"), (_decoded(name) if escaped else name).alias(key),
                       F.when(F.col("file").rlike(pattern), page.cast("int")).otherwise(no_page).alias("page_no"),
                       F.col("value").alias(content))


def land_pages(pages: DataFrame, path: str, content: str = "html", key: str = "target") -> str:
    """One file a page ``(<key>, page_no, <content>)``, in the folders that ``read_pages`` expects."""
    pages = pages.select(F.col(key).alias("target"), "page_no", F.col(content).alias("value"))
    spread(pages, "target", "page_no").write.partitionBy("target", "page_no").text(path)
    return path
