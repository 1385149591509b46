"""Helpers shared by the training-data operators: input columns, scratch tables, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.session import ship_package, written

#: Rows per Arrow batch handed to Python tasks; texts can be long, so batches stay small.
BATCH_ROWS = 2000
#: Ids (8 bytes each, 4 MB) that a join may broadcast.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table, as the scan splits it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Make tasks able to import this package and keep their Arrow batches small."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > BATCH_ROWS or int(spark.conf.get(key, "10000")) <= 0:
        spark.conf.set(key, str(BATCH_ROWS))


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty), under fixed names: other columns can't clash."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back: cuts the lineage,
    computes it once, and survives the loss of any executor."""
    return written(df, name)


def broadcast_if_small(ids: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Narrow rows, marked for broadcast when counting finds no more than ``rows`` of them; beyond that
    the planner's shuffle join is used."""
    return F.broadcast(ids) if ids.count() <= rows else ids


def most_frequent(counts: DataFrame, column: str, most: int) -> DataFrame:
    """The rows with the largest counts, at most ``most`` of them, as a plain filter.

    Counts fall into classes of a sixteenth of a doubling; their sizes (some hundred rows) tell down to which
    class the rows fit.  Nothing is sorted, and what a task sends to the driver later has the bound ``most``.
    """
    level = F.floor(F.log2(F.col(column)) * 16)
    sizes = sorted(((r.level, r.n) for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()),
                   reverse=True)
    least = None
    for at, n in sizes:
        most -= n
        if most < 0:
            break
        least = at
    return counts.where(F.lit(False) if least is None else level >= least)


def without(docs: DataFrame, gone: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs``, all columns, whose id is not the first column of ``gone`` (rows without an id stay)."""
    ids = scratch(gone.select(gone[gone.columns[0]].alias(id_col)).distinct(), "gone")
    return docs.join(broadcast_if_small(ids), id_col, "left_anti").select(docs.columns)


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    ``edges`` has long columns ``a`` and ``b``; returns ``node``, ``component``.  Each round gives a
    node the smallest label among its own and its neighbours' and then follows that label's own label
    (pointer jumping), so a chain of n nodes needs about log n rounds; it ends when nothing changes.  All work is joins and
    ``min`` aggregates with map-side combine; only the number of changed labels reaches the driver.
    Empty edges give an empty result; self loops and repeated edges are harmless.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = scratch(both.where("a IS NOT NULL AND b IS NOT NULL").distinct(), "cc-edges")
    labels = scratch(both.groupBy(F.col("a").alias("node"))
                     .agg(F.least(F.col("a"), F.min("b")).alias("component")), "cc-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "component"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        hooked = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        far = labels.select(F.col("node").alias("component"), F.col("component").alias("far"))
        new = scratch(hooked.join(far, "component", "left").select(
            "node", "old", F.least("component", F.coalesce("far", "component")).alias("component")), "cc-labels")
        labels = new.select("node", "component")
        if not new.where("component <> old").limit(1).count():
            return labels
