"""End-to-end flows per source layout (plans/reviews.py)."""

import datetime as dt

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from revlens import params
from revlens.plans import reviews as flows
from revlens.sources import testbed
from revlens.sources.tables import table
from conftest import SF001

AS_OF = dt.date(2024, 1, 30)


def test_lowes_config_flow_labels(spark):
    r = testbed.reviews(table(spark, SF001, "documents"))
    landed = testbed.landed_lowes(r)
    meta = r.select("target").distinct().select(
        "target", F.concat(F.lit("M-"), F.col("target")).alias("model_no"),
        F.concat(F.lit("ACME "), F.col("target")).alias("model_description"))
    out, report = flows.json_flow(landed, "lowes", meta, days=6, as_of=AS_OF)
    assert set(out.columns) >= set(flows.REVIEW_COLUMNS)
    n = out.count()
    assert n == report.agg(F.sum("n_reviews")).collect()[0][0]
    deduped = flows.dedupe_reviews(out)
    training = testbed.training_set(table(spark, SF001, "documents"), table(spark, SF001, "labels"))
    tags = ["sound", "low quality", "wifi"]
    labelled = flows.label_reviews(deduped, tags, training=training, stem=True)
    assert labelled.columns[-4:] == tags + ["category"]
    assert labelled.count() == deduped.count()


def test_amazon_and_homedepot_flows(spark):
    r = testbed.reviews(table(spark, SF001, "documents"))
    s2m = spark.createDataFrame([("5 BTU", "M5", "five")], "size string, model_no string, model_description string")
    targets = r.select("target").distinct().withColumn("model_no", F.lit(None).cast("string"))
    out, report = flows.amazon_flow(testbed.landed_amazon(r), s2m, targets, days=None)
    m, k = testbed.AMAZON_FAIL                     # a rating that is no number fails its target
    bad = [x.target for x in r.filter((F.col("doc_id") % m == k) & F.col("rating").isNotNull()).collect()]
    ok = r.filter(~F.col("target").isin(bad))
    assert bad and out.count() == ok.count()
    assert {x.target for x in report.filter("status = 'failed'").collect()} == set(bad)
    assert out.filter(F.col("model_no") == "M5").count() == ok.filter(F.col("size") == "5 BTU").count()
    hd_landed = testbed.landed_homedepot(r)
    bar = '<h2 class="product-info-bar__detail--24WIp">'
    pages = r.select("target").distinct().select("target", F.concat(
        F.lit('<h1 class="page-title">Customer Reviews for\nACME '), F.col("target"), F.lit("</h1>"),
        F.lit(bar + "Internet #1</h2>" + bar + "Model #<!-- -->M-"), F.col("target"), F.lit("</h2>")).alias("html"))
    out2, report2 = flows.homedepot_flow(hd_landed, pages, days=None)
    ok = report2.filter(F.col("status") == "success").count()
    assert ok > 0 and out2.filter(F.col("manufacturer").isNull()).count() == 0


def test_collect_reviews_product_mode_and_output(spark, tmp_out):
    import pytest

    r = testbed.reviews(table(spark, SF001, "documents"))
    landed = testbed.landed_walmart(r)
    one = r.select("target").limit(1).collect()[0]["target"]
    meta = r.select("target").distinct().select(
        "target", F.lit("M").alias("model_no"), F.lit("ACME unit").alias("model_description"))
    assert flows.json_flow(landed, "walmart", meta, days=None)[0].filter("manufacturer <> 'ACME'").count() == 0
    out, report, path, totals = flows.collect_reviews("walmart", landed, meta=meta, mode="product", target=one,
                                              days=None, output=tmp_out + "/Walmart_Reviews")
    assert path == tmp_out + "/Walmart_Reviews" and totals["targets"] == 1
    assert report.count() == 1
    assert spark.read.parquet(path).count() == out.count()
    with pytest.raises(ValueError):
        flows.collect_reviews("walmart", landed, meta=meta, mode="product")


def test_walmart_meta_from_product_pages(spark):
    part = table(spark, SF001, "part")
    meta = {r["target"]: r for r in flows.walmart_meta(testbed.spec_pages(part)).collect()}
    for p in part.collect():
        m = meta[str(p["p_partkey"])]
        assert m["model_description"] == p["p_name"]
        key = str(p["p_partkey"])
        want = {1: "mpn-" + p["p_type"], 3: testbed.WALMART_PAGE_URL + key, 4: "B-" + key}.get(p["p_partkey"] % 7, p["p_name"])
        assert m["model_no"] == want


PAGE = '<div data-hook="review"><span data-hook="review-date">on January {d}, 2024</span>{stars}</div>'


def amazon_pages(spark, pages):
    """(target, page_no, url, day, stars text or None) -> landed pages."""
    rows = []
    for target, page_no, url, day, stars in pages:
        i = f'<i data-hook="review-star-rating">{stars}</i>' if stars else ""
        rows.append(("amazon", target, page_no, url, "<html>" + PAGE.format(d=day, stars=i) + "</html>"))
    return spark.createDataFrame(rows, "source string, target string, page_no int, url string, html string")


def no_sizes(spark):
    return spark.createDataFrame([], "size string, model_no string, model_description string")


def test_amazon_pager_failures_and_equal_rows(spark):
    landed = amazon_pages(spark, [
        ("a", 1, "u1", 20, "5.0 out"), ("a", 2, "u2", 20, "5.0 out"), ("a", 3, "u2", 19, "1.0 out"), ("a", 4, "u4", 19, "1.0 out"),
        ("b", 1, "v1", 20, "N/A"), ("c", 1, "w1", 20, "4.0 out"), ("d", 1, "x1", 20, None)])
    targets = spark.createDataFrame([("a", "M"), ("b", None), ("c", "unknown"), ("d", None)], "target string, model_no string")
    m2d = spark.createDataFrame([("M", "thing")], "model_no string, model_description string")
    out, report = flows.amazon_flow(landed, no_sizes(spark), targets, None, None, m2d)
    assert {r.target: (r.status, r.n_reviews) for r in report.collect()} == {
        "a": ("success", 2), "b": ("failed", 0), "c": ("failed", 0), "d": ("success", 1)}
    rows = out.collect()
    assert sorted((r.target, r.model_no, r.rating) for r in rows if r.target == "a") == [("a", "M", 5)] * 2
    assert {r.status for r in flows.amazon_flow(landed, no_sizes(spark), targets, None)[1].collect() if r.target == "a"} == {"failed"}


def test_homedepot_pager_and_on_error(spark):
    review = ('<div class="review_item"><span class="review-content__date">Jan {d}, 2024</span>'
              '<span class="stars" style="width: 80%"></span></div>')
    pages = [(1, "1", 20), (2, "1", 20), (3, "2", 19), (4, "1", 18), (5, "3", 17)]
    rows = [("homedepot", "t", n, label, review.format(d=day)) for n, label, day in pages]
    rows += [("homedepot", "u", 1, "1", review.format(d=20)), ("homedepot", "u", 2, None, review.format(d=19)),
             ("homedepot", "w", 1, "1", review.format(d=20))]
    landed = spark.createDataFrame(rows, "source string, target string, page_no int, page_label string, html string")
    bar = '<h2 class="product-info-bar__detail--24WIp">'
    page = f'<h1 class="page-title">Customer Reviews for X 1</h1>{bar}a</h2>{bar}Model #M</h2>'
    product = spark.createDataFrame([("t", page), ("u", page)], "target string, html string")

    def report(on_error):
        return {r.target: (r.status, r.n_reviews) for r in
                flows.homedepot_flow(landed, product, None, on_error=on_error)[1].collect()}

    assert report("drop_target") == {"t": ("success", 2), "u": ("failed", 0), "w": ("failed", 0)}
    assert report("keep_prefix") == {"t": ("success", 2), "u": ("success", 1), "w": ("failed", 0)}


def test_collect_reviews_with_config_files(spark, tmp_out):
    import json

    import pytest

    with open(tmp_out + "/amazon.json", "w") as f:
        json.dump({"urls": {"Window": {"M1": "https://a/1"}, "Portable": "https://a/2"}, "size2model": {}, "model2desc": {"M1": "d 1"}}, f)
    landed = amazon_pages(spark, [("https://a/1", 1, "p1", 20, "2.0 out"), ("https://a/2", 1, "p2", 20, "2.0 out")])
    out, report, *_ = flows.collect_reviews("amazon", landed, category="Window", config_path=tmp_out + "/amazon.json",
                                           days=None, tags=["sound", "wifi"])
    assert [(r.model_no, r.model_description, r.sound, r.category) for r in out.collect()] == [("M1", "d 1", 0, "")]
    assert report.count() == 1
    with pytest.raises(PySparkException, match="invalid category: Nope"):
        flows.collect_reviews("amazon", landed, category="Nope", config_path=tmp_out + "/amazon.json")
    with open(tmp_out + "/lowes.json", "w") as f:
        json.dump({"urls": {"m1": ["https://x/pd/1001", "https://x/pd/1002"], "m2": ["https://x/pd/1003"]}, "model2desc": {"m1": "d"}}, f)
    payload = ('{"Results":[{"SubmissionTime":"2024-01-20T00","Rating":4.5,"Title":"t","ReviewText":"b","Photos":[]}]}')
    rows = [("lowes", t, 1, payload) for t in ("1001", "1002", "1003")]
    landed = spark.createDataFrame(rows, "source string, target string, page_no int, payload string")
    out, report, *_ = flows.collect_reviews("lowes", landed, config_path=tmp_out + "/lowes.json", days=None, predict=False)
    assert [(r.manufacturer, r.model_no, r.rating) for r in out.collect()] == [(None, "m1", 4.5)]
    assert {r.target: r.status for r in report.collect()} == {"1001": "success", "1002": "success", "1003": "failed"}


def test_collect_reviews_by_category_listing(spark):
    import pytest

    from revlens.sources.tables import table as read

    part = read(spark, SF001, "part")
    listing = testbed.homedepot_listing(part).withColumn("category", F.lit("Window"))
    hrefs = [r.target for r in flows.discovered_targets("homedepot", listing, "Window").collect()]
    r = testbed.reviews(read(spark, SF001, "documents"))
    mapped = testbed.landed_homedepot(r).withColumn("target", F.when(F.col("target") == "src2", F.lit(hrefs[0])).otherwise(F.col("target")))
    page = ('<h1 class="page-title">Customer Reviews for X 1</h1><h2 class="product-info-bar__detail--24WIp">a</h2>'
            '<h2 class="product-info-bar__detail--24WIp">Model #M</h2>')
    product = spark.createDataFrame([(hrefs[0], page)], "target string, html string")
    out, report, *_ = flows.collect_reviews("homedepot", mapped, listing=listing, category="Window", product_pages=product, days=None)
    assert report.count() == len(hrefs) and out.count() == r.filter("target = 'src2'").count()
    with pytest.raises(ValueError):
        flows.collect_reviews("homedepot", mapped, listing=listing, category="Fridge", product_pages=product)


def test_payload_photos_ratings_and_missing_metadata(spark):
    one = '{{"SubmissionTime":"2024-01-20","Rating":{r},"Title":null,"ReviewText":"b","Photos":{p}}}'
    url = '[{"Sizes":{"normal":{"Url":"u"}}}]'
    cases = {"ok": ("5.0", url), "int": ("4", "[]"), "null rating": ("null", "[]"), "null photos": ("5", "null"),
             "no url": ("5", '[{"Sizes":{"normal":{}}}]'), "no meta": ("5", "[]")}
    rows = [("lowes", t, 1, '{"Results":[' + one.format(r=r, p=p) + "]}") for t, (r, p) in cases.items()]
    landed = spark.createDataFrame(rows, "source string, target string, page_no int, payload string")
    meta = spark.createDataFrame([(t, "m", "d") for t in cases if t != "no meta"], "target string, model_no string, model_description string")
    out, report = flows.json_flow(landed, "lowes", meta, days=None)
    assert {r.target: r.status for r in report.collect()} == {
        "ok": "success", "int": "success", "null rating": "success", "null photos": "failed", "no url": "failed", "no meta": "failed"}
    assert {r.target: (r.rating, r.image) for r in out.collect()} == {"ok": (5.0, "u"), "int": (4.0, ""), "null rating": (None, "")}
