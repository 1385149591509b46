"""JSON layouts: round trip from the review test bed and the atomic-target rule."""

import json

from pyspark.sql import functions as F

from revlens.operators import extract
from revlens.sources import testbed
from revlens.sources.tables import table
from conftest import SF001


def _expected(reviews, fail):
    bad = F.lit(False)
    for m, k in fail:
        bad = bad | (F.col("doc_id") % m == k)
    reviews = reviews.withColumn("rating", testbed.payload_rating(F.col("rating"), F.col("doc_id")))
    cut = testbed.cut_page(F.col("target"))
    kept = reviews.filter(F.col("page_no") < cut)
    failed = kept.filter(bad).select("target").distinct()
    return kept.join(failed, "target", "left_anti").select("target", "page_no", *extract.REVIEW_COLUMNS)


def test_walmart_round_trip(spark):
    r = testbed.reviews(table(spark, SF001, "documents"))
    got = extract.extract_reviews(testbed.landed_walmart(r), "walmart").select(
        "target", "page_no", *extract.REVIEW_COLUMNS)
    exp = _expected(r, testbed.WALMART_FAIL)
    assert got.count() > 0
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_lowes_round_trip_no_limit(spark):
    r = testbed.reviews(table(spark, SF001, "documents"))
    got = extract.extract_reviews(testbed.landed_lowes(r), "lowes").select(
        "target", "page_no", *extract.REVIEW_COLUMNS)
    exp = _expected(r, testbed.LOWES_FAIL)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_missing_key_fails_exactly_one_target(spark):
    ok = {"SubmissionTime": "2021-01-05T00:00:00.000+00:00", "Rating": 5, "Title": None, "ReviewText": "x",
          "Photos": []}
    bad = {k: v for k, v in ok.items() if k != "Photos"}
    rows = [("lowes", "a", 1, json.dumps({"Results": [ok, ok]})),
            ("lowes", "b", 1, json.dumps({"Results": [ok, bad]})),
            ("lowes", "c", 1, json.dumps({"Results": []}))]
    landed = spark.createDataFrame(rows, "source string, target string, page_no int, payload string")
    rows = extract.typed_reviews(landed, "lowes")
    read, report = extract.read_targets(rows, extract.target_cuts(extract.read_events(rows, None), landed))
    got = {r["target"]: (r["status"], r["n_reviews"]) for r in report.collect()}
    assert got == {"a": ("success", 2), "b": ("failed", 0), "c": ("no new reviews", 0)}
    # a JSON null is a NULL value, not a failure
    assert read.filter(F.col("target") == "a").filter(F.col("title").isNull()).count() == 2


def test_missing_product_entry_fails_target(spark):
    rows = [("walmart", "p1", 1, json.dumps({"payload": {"reviews": {"other": {"customerReviews": [{}]}}}}))]
    landed = spark.createDataFrame(rows, "source string, target string, page_no int, payload string")
    typed = extract.page_reviews(landed, "walmart")
    assert typed.filter("bad").count() == 1
