"""Pages that are left out before parsing: never one that is read."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from revlens.functions.html import parse
from revlens.operators import html_extract, pages
from revlens.plans import reviews as flows
from revlens.sources import testbed
from revlens.sources.tables import table
from conftest import SF001

LIMIT = dt.date(2024, 1, 15)
PIECES = {
    "amazon": ['<div data-hook="review">', '<div class="x" data-hook="review" id=\'r\'>', "</div>", '<span data-hook="review-date">',
               "on January 3, 2024", "on January 20, 2024", "</span>", "<!-- ", " -->", "<script>", "</script>", '<b title="a>b">',
               '<img alt=\'<div data-hook="review">\'>', "<br/>", "text & more", "<p>", "<table><tr><td>", "</td>", '<i data-hook="review-date">',
               '<span data-hook="review-date">on January 3, 2024</span>', '<div data-hook="review"/>', "<div title='data-hook=\"review\"'>",
               '<div data-hook="review" data-hook="other">', '<style>.a{}</style>', "< 3", "<td>"],
    "homedepot": ['<div class="review_item">', '<div class="big review_item x">', "</div>", '<span class="review-content__date">', "Jan 3, 2024",
                  " Jan 3, 2024\n", "Jan 20, 2024", "</span>", "<!--", "-->", '<script>"', "</script>", '<div class="review_items">', "<br>",
                  '<span class="review-content__date">Jan 3, 2024</span>', "&#74;an 3, 2024", '<em class="review_item">', "<hr/>", "</p>"],
}


def really_old(html, layout):
    """Whether the parser finds a review older than the limit."""
    if layout == "amazon":
        found = [re.findall(r"\S+\s+\d+,\s+\d+$", r["date_text"] or "") for r in html_extract.amazon_reviews(parse(html))]
        texts, form = [f[0] for f in found if f], "%B %d, %Y"
    else:
        texts, form = [r["date_text"] for r in html_extract.homedepot_reviews(parse(html)) if r["date_text"]], "%b %d, %Y"
    for t in texts:
        try:
            if dt.datetime.strptime(t, form).date() < LIMIT:
                return True
        except ValueError:
            pass
    return False


@pytest.mark.parametrize("layout", ["amazon", "homedepot"])
def test_certainly_old_pages_are_old(spark, layout):
    rnd = random.Random(7)
    rows = [(i, "".join(rnd.choices(PIECES[layout], k=rnd.randint(2, 9)))) for i in range(6000)]
    df = spark.createDataFrame(rows, "i int, html string")
    sure = {r.i for r in df.where(pages.certainly_old(F.col("html"), layout, F.lit(LIMIT))).select("i").collect()}
    wrong = [h for i, h in rows if i in sure and not really_old(h, layout)]
    assert not wrong, wrong[:3]
    assert len(sure) > 20


def test_rendered_pages_are_recognised_and_long_ones_do_no_harm(spark):
    r, limit = testbed.reviews(table(spark, SF001, "documents")), F.lit(dt.date(2024, 1, 25))
    for layout, landed in (("amazon", testbed.landed_amazon(r)), ("homedepot", testbed.landed_homedepot(r))):
        got = {(x.target, x.page_no): x.sure for x in landed.select(
            "target", "page_no", pages.certainly_old(F.col("html"), layout, limit).alias("sure")).collect()}
        want = {(x.target, x.page_no): x.old for x in r.groupBy("target", "page_no").agg(F.min("date").alias("d")).select(
            "target", "page_no", (F.col("d") < limit).alias("old")).collect()}
        assert got == want and any(got.values())
    long = "<p>" + "<b a='1'>x</b> " * 200_000 + '<div data-hook="review"><span data-hook="review-date">on January 3, 2024</span></div>'
    df = spark.createDataFrame([(long,), (long + "<",)], "html string")
    assert [x[0] for x in df.select(pages.certainly_old(F.col("html"), "amazon", F.lit(LIMIT))).collect()] == [True, False]


def counted(monkeypatch):
    """Rows that enter the parser, by call."""
    seen, real = [], html_extract.parse_pages

    def parse_pages(df, *args, **kwargs):
        seen.append(df.count())
        return real(df, *args, **kwargs)

    monkeypatch.setattr(html_extract, "parse_pages", parse_pages)
    return seen


def test_fewer_pages_are_parsed_and_the_results_are_the_same(spark, monkeypatch):
    r = testbed.reviews(table(spark, SF001, "documents"))
    for m, k in (testbed.AMAZON_FAIL, testbed.HOMEDEPOT_FAIL):
        r = r.where(F.col("doc_id") % m != k)
    r = r.withColumns({"target": F.lit("t"), "page_no": (F.col("doc_id") / 10).cast("int") + 1})   # many pages of one target
    r = r.withColumns({"date": F.date_sub(F.lit(testbed.AS_OF), F.col("page_no")), "rating": F.lit(5)})
    targets = spark.createDataFrame([("t", None)], "target string, model_no string")
    sizes = spark.createDataFrame([], "size string, model_no string, model_description string")
    bar = '<h2 class="product-info-bar__detail--24WIp">'
    product = spark.createDataFrame([("t", f'<h1 class="page-title">Customer Reviews for X 1</h1>{bar}a</h2>{bar}Model #M</h2>')],
                                    "target string, html string")
    for landed, flow in ((testbed.landed_amazon(r), lambda x: flows.amazon_flow(x, sizes, targets, 5, testbed.AS_OF)),
                         (testbed.landed_homedepot(r), lambda x: flows.homedepot_flow(x, product, 5, testbed.AS_OF))):
        with monkeypatch.context() as patch:
            seen = counted(patch)
            out, report = flow(landed)
            rows, lines = sorted(map(str, out.collect())), report.collect()
        assert landed.count() >= 15 and seen[-1] == 6          # five pages within the limit, one that stops
        with monkeypatch.context() as patch:
            patch.setattr(pages, "pages_to_parse", lambda landed, *a, **k: landed)
            out, report = flow(landed)
            assert sorted(map(str, out.collect())) == rows and report.collect() == lines
        assert rows and lines[0].n_reviews == len(rows)


def test_pager_pages_are_not_parsed(spark, monkeypatch):
    seen = counted(monkeypatch)
    block = '<div data-hook="review"><span data-hook="review-date">on January {d}, 2024</span></div>'
    rows = [("t", n, url, block.format(d=d)) for n, url, d in ((1, "u1", 20), (2, "u2", 20), (3, "u2", 20), (4, "u4", 20))]
    landed = spark.createDataFrame(rows, "target string, page_no int, url string, html string")
    targets = spark.createDataFrame([("t", None)], "target string, model_no string")
    sizes = spark.createDataFrame([], "size string, model_no string, model_description string")
    out, _ = flows.amazon_flow(landed, sizes, targets, None)
    assert out.count() == 2 and seen == [2]
    item = '<div class="review_item"><span class="review-content__date">Jan 20, 2024</span><span class="stars" style="width: 80%"></span></div>'
    rows = [("t", n, label, item) for n, label in ((1, None), (2, "1"), (3, "2"), (4, "2"), (5, "1"), (6, "2"))]
    landed = spark.createDataFrame(rows, "target string, page_no int, page_label string, html string")
    bar = '<h2 class="product-info-bar__detail--24WIp">'
    product = spark.createDataFrame([("t", f'<h1 class="page-title">Customer Reviews for X 1</h1>{bar}a</h2>{bar}Model #M</h2>')],
                                    "target string, html string")
    out, report = flows.homedepot_flow(landed, product, None)
    assert out.count() == 2 and report.collect()[0].status == "success"
    assert seen[-1] == 2                                        # pages 1 and 3; the others were seen before or lie behind


def test_pager_labels(spark):
    cases = ['<span class="pager-summary__bold">3</span>', '<p>x</p><SPAN>1</SPAN><span id=a class="a pager-summary__bold b" >12</span>', "",
             '<!-- <span class="pager-summary__bold">3</span> --><p>', '<script><span class="pager-summary__bold">3</span></script>',
             '<span class="pager-summary__bolder">3</span><span class="pager-summary__bold">4</span><span class="pager-summary__bold">5</span>', None]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, html string")
    got = [r[0] for r in df.orderBy("i").select(pages.pager_label(F.col("html"))).collect()]
    assert got == ["3", "12", None, None, None, "4", None]
