"""Streaming rule labels over landed payload pages (extension)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from revlens.operators import extract, rules
from revlens.sources import testbed
from revlens.sources.tables import table
from revlens.streaming import read_stream, rule_stream
from conftest import SF001


def test_stream_matches_batch(spark, tmp_out):
    r = testbed.reviews(table(spark, SF001, "documents"))
    landed = testbed.landed_lowes(r).withColumn("landed_at", F.lit(dt.datetime(2024, 1, 30, 12)))
    src = os.path.join(tmp_out, "landed")
    landed.unionByName(landed).write.parquet(src)          # every page lands twice
    stream = spark.readStream.schema(rule_stream.LANDED_STREAM).parquet(src)
    out = rule_stream.labelled_review_stream(stream, "lowes", testbed.TEST_RULES)
    q = (out.writeStream.format("memory").queryName("stream_rules").outputMode("append")
         .option("checkpointLocation", os.path.join(tmp_out, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = spark.table("stream_rules").drop("landed_at")
    typed = extract.page_reviews(testbed.landed_lowes(r), "lowes")
    batch = typed.filter(~F.col("empty_page") & ~F.col("bad")).select("target", *extract.REVIEW_COLUMNS).distinct()
    tags = [t for t, _ in testbed.TEST_RULES]
    batch = rules.rule_labels(batch, testbed.TEST_RULES).withColumn("category", rules.category_string(tags))
    assert got.count() == batch.count() > 0
    assert got.exceptAll(batch.select(*got.columns)).count() == 0


def streamed(spark, batches, folder, layout, earliest=None):
    """What the stream gives for pages that land in these batches, one file each."""
    src = os.path.join(folder, "pages")
    for k, batch in enumerate(batches):
        batch.coalesce(1).write.mode("append").parquet(os.path.join(src, f"b{k}"))
    stream = spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(src)
    q = (read_stream.reviews_as_they_land(stream, layout, earliest).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", os.path.join(folder, "ckpt")).option("path", os.path.join(folder, "out"))
         .trigger(availableNow=True).start())
    q.awaitTermination(180)
    assert len(q.recentProgress) >= len(batches) or q.lastProgress["batchId"] + 1 >= len(batches)
    return spark.read.schema(read_stream.OUT).parquet(os.path.join(folder, "out"))


def test_pages_landing_in_batches_give_the_batch_rows(spark, tmp_out):
    r = testbed.reviews(table(spark, SF001, "documents"))
    for m, k in testbed.LOWES_FAIL:
        r = r.where(F.col("doc_id") % m != k)
    r = r.withColumn("page_no", (F.col("doc_id") / 40).cast("int") + 1)             # five pages a target
    r = r.withColumn("target", F.concat(F.lit("t"), (F.col("doc_id") % 3).cast("string")))
    landed = testbed.landed_lowes(r)
    earliest = F.lit(dt.date(2024, 1, 25))
    want = extract.extract_reviews(landed, "lowes", earliest).select("target", "page_no", "pos", *extract.REVIEW_COLUMNS)
    # later pages first: they wait; some pages land twice
    first, last = landed.where("page_no > 1"), landed.where("page_no <= 2")
    got = streamed(spark, [first, last], tmp_out, "lowes", earliest)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_state_of_a_target():
    page = lambda label, *rows: [label, [[stop, bad, i, "2024-01-20", 5.0, None, "b", ""] for i, (stop, bad) in enumerate(rows)]]
    ok, stop, bad = (False, False), (True, False), (False, True)
    places = lambda result: [(r[0], r[1]) for r in result[3]]
    assert places(read_stream._advance(1, None, {1: page(None, ok, ok), 3: page(None, ok)})) == [(1, 0), (1, 1)]
    assert places(read_stream._advance(1, None, {1: page(None, ok, stop, ok), 2: page(None, ok)})) == [(1, 0)]
    assert places(read_stream._advance(1, None, {1: page(None, ok, bad), 2: page(None, ok)})) == [(1, 0)]
    # labels: page 2 shows page 1 again, page 4 is back at page 1
    pages = {1: page("x", ok), 2: page("1", ok), 3: page("2", ok), 4: page("1", ok), 5: page("2", ok)}
    result = read_stream._advance(1, None, pages)
    assert places(result) == [(1, 0), (3, 0)] and result[2]
    assert read_stream._advance(2, "1", {2: page("2", ok)})[:3] == (3, "2", False)
