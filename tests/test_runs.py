"""Runs and their inputs: page files, configs, runs under several models, totals of the write, ordered output."""

import json
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from revlens import sinks
from revlens.operators import extract
from revlens.plans import reviews as flows
from revlens.sources import config, landed, testbed
from revlens.sources.tables import table
from conftest import SF001

ONE = {"reviewSubmissionTime": "1/20/2024", "rating": 5, "photos": []}


def walmart_pages(spark, pages):
    rows = [("walmart", t, n, json.dumps({"payload": {"reviews": {t: {"customerReviews": c} if c != "missing" else {}}}}))
            for t, n, c in pages]
    return spark.createDataFrame(rows, "source string, target string, page_no int, payload string")


def test_false_review_lists_end_a_target_and_others_fail_it(spark):
    lists = {"null": None, "empty": [], "object": {}, "text": "", "zero": 0, "no": False,
             "missing": "missing", "word": "reviews", "digit": "0", "filled": {"a": 1}, "one": 1, "yes": True, "nulls": [None], "numbers": [7]}
    pages = [(t, 1, [ONE]) for t in lists] + [(t, 2, c) for t, c in lists.items()] + [(t, 3, [ONE]) for t in lists]
    rows = extract.typed_reviews(walmart_pages(spark, pages), "walmart")
    _, report = extract.read_targets(rows, extract.target_cuts(extract.read_events(rows, None), rows))
    got = {r.target: (r.status, r.n_reviews) for r in report.collect()}
    ends = {"null", "empty", "object", "text", "zero", "no"}
    assert got == {t: ("success", 1) if t in ends else ("failed", 0) for t in lists}


def test_payloads_that_are_no_payloads_fail(spark):
    rows = [("lowes", f"t{i}", 1, p) for i, p in enumerate([None, "", "not json", "[]", "{}", '{"Results":', '{"results":[]}'])]
    pages = spark.createDataFrame(rows, "source string, target string, page_no int, payload string")
    typed = extract.page_reviews(pages, "lowes")
    assert typed.count() == len(rows) and typed.where("bad").count() == len(rows)


def test_rows_behind_a_pages_stop_are_not_made(spark):
    old = ONE | {"reviewSubmissionTime": "1/2/2024"}
    pages = walmart_pages(spark, [("a", 1, [ONE, old, ONE, {}]), ("a", 2, [old] * 50), ("a", 3, [ONE])])
    typed = extract.page_reviews(pages, "walmart", F.lit("2024-01-10").cast("date"))
    assert sorted((r.page_no, r.pos, r.bad) for r in typed.collect()) == [(1, 0, False), (1, 1, False), (2, 0, False), (3, 0, False)]
    out = extract.extract_reviews(pages, "walmart", F.lit("2024-01-10").cast("date"))
    assert [(r.page_no, r.pos) for r in out.collect()] == [(1, 0)]
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("parse_?json", plan, re.IGNORECASE)) == 1


def test_a_product_under_two_models(spark):
    review = '{"Results":[{"SubmissionTime":"2024-01-20","Rating":4,"Title":"t","ReviewText":"b","Photos":[]}]}'
    rows = [("lowes", "1001", 1, review), ("lowes", "1002", 1, review)]
    pages = spark.createDataFrame(rows, "source string, target string, page_no int, payload string")
    meta = spark.createDataFrame([("1001", "A", "a thing"), ("1001", "B", None), ("1001", "C", "c thing"), ("1002", "B", None)],
                                 "target string, model_no string, model_description string")
    out, report = flows.json_flow(pages, "lowes", meta, days=None)
    assert sorted((r.model_no, r.model_description) for r in out.collect()) == [("A", "a thing"), ("C", "c thing")]
    assert sorted((r.target, r.model_no, r.status, r.n_reviews) for r in report.collect()) == [
        ("1001", "A", "success", 1), ("1001", "B", "failed", 0), ("1001", "C", "success", 1), ("1002", "B", "failed", 0)]


def test_every_configured_amazon_run_is_reported(spark):
    html = '<div data-hook="review"><span data-hook="review-date">on January 20, 2024</span></div>'
    pages = spark.createDataFrame([("amazon", "u", 1, html)], "source string, target string, page_no int, html string")
    targets = spark.createDataFrame([("u", "A"), ("u", "B"), ("u", None), ("gone", "A"), ("gone2", None)], "target string, model_no string")
    names = spark.createDataFrame([("A", "a thing")], "model_no string, model_description string")
    sizes = spark.createDataFrame([], "size string, model_no string, model_description string")
    out, report = flows.amazon_flow(pages, sizes, targets, None, None, names)
    got = {(r.target, r.model_no): (r.status, r.n_reviews) for r in report.collect()}
    assert got == {("u", "A"): ("success", 1), ("u", "B"): ("failed", 0), ("u", None): ("success", 1),
                   ("gone", "A"): ("no new reviews", 0), ("gone2", None): ("no new reviews", 0)}
    assert sorted(str(r.model_no) for r in out.collect()) == ["A", "None"]


def test_page_files_round_trip(spark, tmp_out):
    targets = ["plain", "https://x.example/dp/a b?c=1&d=%20+e", "ünï", "a=b/c:d", "100%"]
    html = "<p>line one\r\nline two</p>\n\n<p>é😀</p>"
    rows = [("s", t, n, f"{html}{n}") for t in targets for n in (1, 2, 10)]
    pages = spark.createDataFrame(rows, "source string, target string, page_no int, html string")
    read = landed.read_pages(spark, landed.land_pages(pages, tmp_out + "/landed"), "s")
    got = sorted((r.source, r.target, r.page_no, r.html.removesuffix("\n")) for r in read.collect())
    assert got == sorted(rows)
    assert read.rdd.getNumPartitions() < len(rows)              # many small files a task


def test_other_paths_of_page_files(spark, tmp_out):
    import os

    os.makedirs(tmp_out + "/crawl/p 1+2")
    for n in (1, 2):
        with open(f"{tmp_out}/crawl/p 1+2/page{n}.json", "w") as f:
            f.write(json.dumps({"Results": [{"a": n}]}, indent=1))
    with open(tmp_out + "/crawl/notes.txt", "w") as f:
        f.write("x")
    read = landed.read_pages(spark, tmp_out + "/crawl", "lowes", "payload", r"([^/]+)/page(\d+)\.json$", glob="*.json", escaped=False)
    assert sorted((r.target, r.page_no, json.loads(r.payload)["Results"][0]["a"]) for r in read.collect()) == [("p 1+2", 1, 1), ("p 1+2", 2, 2)]
    with pytest.raises(PySparkException, match="landed page"):
        landed.read_pages(spark, tmp_out + "/crawl", "lowes", "payload", r"([^/]+)/page(\d+)\.json$").collect()


def test_config_files_of_several_lines(spark, tmp_out):
    with open(tmp_out + "/c.json", "w") as f:
        json.dump({"urls": {"Window": {"M1": "https://a/1"}, "Portable": "https://a/{2}"}, "size2model": {"5 BTU": ["M5", "five"]},
                   "model2desc": {"M1": "d"}}, f, indent=2)
    cfg = config.amazon_config(spark, tmp_out + "/c.json")
    assert sorted(map(tuple, cfg["targets"].collect()), key=str) == [("Portable", None, "https://a/{2}"), ("Window", "M1", "https://a/1")]
    assert [tuple(r) for r in cfg["size2model"].collect()] == [("5 BTU", "M5", "five")]
    assert [tuple(r) for r in config.check_config_category(cfg["targets"], "Portable").collect()] == [("Portable", None, "https://a/{2}")]
    wrong = config.check_config_category(cfg["targets"], "Fridge")          # no job yet
    with pytest.raises(PySparkException, match="invalid category: Fridge"):
        wrong.select("url").collect()
    with pytest.raises(PySparkException, match="invalid category"):
        config.check_config_category(cfg["targets"], None).count()


def test_totals_come_from_the_write(spark, tmp_out):
    r = testbed.reviews(table(spark, SF001, "documents"))
    meta = testbed.target_runs(r).withColumn("model_description", F.when(F.length("target") == 4, F.lit("ACME x")))
    for newest_first in (False, True):
        run = flows.collect_reviews("lowes", testbed.landed_lowes(r), meta=meta, days=None, predict=False,
                                    output=tmp_out + "/Lowes", newest_first=newest_first)
        want = sinks.totals(run.report).collect()[0].asDict() | {"rows_written": run.reviews.count()}
        assert run.totals == want and want["reviews"] > 0
        assert spark.read.parquet(run.path).count() == want["rows_written"]
        assert spark.read.parquet(run.path + "_report").exceptAll(run.report).count() == 0
    assert run.path == tmp_out + "/Lowes1"
    nothing = flows.collect_reviews("lowes", testbed.landed_lowes(r.limit(0)), meta=meta, days=None, predict=False, output=tmp_out + "/None")
    assert nothing.totals == {"targets": 0, "succeeded": 0, "no_new_reviews": 0, "failed": 0, "reviews": 0, "rows_written": 0}


def test_files_in_name_order_are_newest_first(spark, tmp_out, monkeypatch):
    monkeypatch.setattr(sinks, "FILE_ROWS", 40)
    days = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 30).cast("int")               # a third of all rows on one day
    df = spark.range(1000).select("id", F.when(F.col("id") % 97 != 0, F.date_sub(F.lit(testbed.AS_OF), days)).alias("date"), F.lit("x").alias("title"))
    for fmt in ("parquet", "csv"):
        path = sinks.write_reviews(df, f"{tmp_out}/{fmt}", fmt, newest_first=True, files=6)
        read = spark.read.parquet(path) if fmt == "parquet" else spark.read.option("header", True).schema("id long, date date, title string").csv(path)
        rows = read.select("date", F.col("_metadata.file_name").alias("f")).collect()
        by = {}
        for row in rows:
            by.setdefault(row.f, []).append(row.date)
        dates = [sorted(by[f], key=lambda d: (d is None, -(d.toordinal() if d else 0))) for f in sorted(by)]
        flat = [d for part in dates for d in part]
        assert len(flat) == 1000 and flat == sorted(flat, key=lambda d: (d is None, -(d.toordinal() if d else 0)))
        assert max(map(len, dates)) <= 40 and len(dates) >= 25


def test_page_files_are_written_and_listed_by_many_tasks(spark, tmp_out):
    pages = spark.range(120).select(F.concat(F.lit("t"), F.col("id") % 3).alias("target"), F.col("id").cast("int").alias("page_no"),
                                    F.concat(F.lit("<p>"), "id").alias("html")).coalesce(1)
    path = landed.land_pages(pages, tmp_out + "/landed")
    before = spark.conf.get(landed.LISTING_CONF)
    read = landed.read_pages(spark, path, "s")
    assert spark.conf.get(landed.LISTING_CONF) == before                       # the caller's setting stays
    got = read.select("target", "page_no", F.regexp_replace("html", "\n$", "").alias("html"))    # a text file ends its line
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, pages.collect()))
    writers = {re.search(r"/part-(\d+)", f).group(1) for f in read.inputFiles()}
    assert len(writers) > spark.sparkContext.defaultParallelism                # one task would have written all files


def test_page_files_are_opened_once(spark, tmp_out, monkeypatch):
    html = '<div data-hook="review"><span data-hook="review-date">on January 20, 2024</span></div>'
    pages = spark.createDataFrame([("u", 1, html), ("u", 2, html)], "target string, page_no int, html string")
    read = landed.read_pages(spark, landed.land_pages(pages, tmp_out + "/landed"), "amazon")
    seen, real = [], flows.amazon_flow
    monkeypatch.setattr(flows, "amazon_flow", lambda pages, *a: seen.append(pages) or real(pages, *a))
    sizes = spark.createDataFrame([], "size string, model_no string, model_description string")
    targets = spark.createDataFrame([("u", None)], "target string, model_no string")
    run = flows.collect_reviews("amazon", read, size2model=sizes, targets=targets, days=None, predict=False)
    assert run.reviews.count() == 2 and run.report.collect()[0].n_reviews == 2
    assert all("landed-pages" in f for f in seen[0].inputFiles())              # not the page files, which every step would open
