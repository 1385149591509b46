"""Spark session defaults and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale.  AQE re-plans joins at runtime: a shuffle
# join whose measured side is small becomes a broadcast join, skewed
# partitions are split, and small shuffle partitions are coalesced.  That is
# the size check behind every join whose small side is data dependent.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HTML pages can be large: keep Arrow batches small for the parser job.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "revlens",
              shuffle_partitions: int | None = None, local_memory: str = "4g") -> SparkSession:
    """Return the active session, creating one if none exists.

    For a ``local`` master the single JVM is both driver and executor, so its
    heap is set to ``local_memory``; on a cluster the submit settings decide.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", local_memory)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names shared storage and is used as given; a
    cluster without it is an error, since a machine-local folder would not be
    seen by the other executors.  Only a local master gets a scratch folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="revlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back: it is computed once, the
    lineage is cut, and the rows survive the loss of any executor."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table of ``written`` once all that reads it has been written itself."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    path = jvm.org.apache.hadoop.fs.Path(df._written_at)
    path.getFileSystem(conf).delete(path, True)


BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 256


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows, for Python work on whole texts or pages: what a worker holds is
    bounded by a batch, and rows can be large."""
    if not 0 < int(spark.conf.get(BATCH_CONF, "10000")) <= BATCH_ROWS:
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))


def tasks(spark: SparkSession) -> int:
    """Four tasks a core."""
    return 4 * spark.sparkContext.defaultParallelism


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Deal rows whose further work is heavy for their size (a page to parse, a file to write) evenly over four tasks a
    core, by the columns ``by`` if any.  A scan splits by bytes, and AQE joins partitions by bytes, so a small table
    of such rows would be the work of one task."""
    return df.repartition(tasks(df.sparkSession), *by)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, whatever folder they start in."""
    sc = spark.sparkContext
    if getattr(sc, "_revlens_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="revlens-pkg-"), "revlens.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.join("revlens", os.path.relpath(path, root)))
    sc.addPyFile(archive)
    sc._revlens_shipped = True
