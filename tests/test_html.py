"""HTML parser job: tree semantics and the layout round trips."""

from pyspark.sql import functions as F

from revlens.functions import html
from revlens.operators import html_extract
from revlens.sources import testbed


def test_tree_semantics():
    root = html.parse('<div class="a b"><p>x<b>y</p>z</div><div class="b">&amp;&lt;q&gt;<!-- c --></div><img src="s">')
    assert [d.text for d in root.find_all("div", "class", "b")] == ["xyz", "&<q>"]
    assert root.find("div", "class", "a b").text == "xyz"
    assert root.find("div", "class", "c") is None
    assert root.find("img").attrs["src"] == "s"
    nested = html.parse("<div class='r'><div class='r'>in</div>out</div>")
    assert [n.text for n in nested.find_all("div", "class", "r")] == ["inout", "in"]


def test_compound_class_selector():
    root = html.parse('<div class="Grid-col u-size-6-12 u-size-1-4-m u-size-1-5-xl extra">x</div>')
    assert root.find("div", "class", "Grid-col u-size-6-12 u-size-1-4-m u-size-1-5-xl").text == "x"


AMAZON_PAGE = """<html><body>
<div data-hook="review"><span data-hook="review-date">Reviewed in the United States on January 5, 2021</span>
<a data-hook="format-strip">Size: 8,000 BTU</a><i data-hook="review-star-rating"><span>4.0 out of 5 stars</span></i>
<a data-hook="review-title"><span> Too loud </span></a><span data-hook="review-body"><span>It rattles &amp; buzzes</span></span>
<img data-hook="review-image-tile" src="https://i/1.jpg"><img data-hook="review-image-tile" src="https://i/2.jpg">
<span data-hook="avp-badge">Verified Purchase</span></div>
<div data-hook="review"><span data-hook="review-date">Reviewed in Canada on Feb 30, 2021</span></div>
</body></html>"""


def test_amazon_page(spark):
    landed = spark.createDataFrame([("amazon", "t1", 1, "u", AMAZON_PAGE)],
                                   "source string, target string, page_no int, url string, html string")
    rows = sorted(html_extract.amazon_page_reviews(landed).collect(), key=lambda r: r["pos"])
    a, b = rows
    assert str(a["date"]) == "2021-01-05" and a["size"] == "8,000 BTU" and a["rating"] == 4
    assert a["title"] == "Too loud" and a["body"] == "It rattles & buzzes"
    assert a["image"] == "https://i/1.jpg\nhttps://i/2.jpg" and a["badge"] == "Verified Purchase"
    assert not a["bad"]
    assert b["bad"] and b["rating"] is None and b["image"] == ""


HD_PAGE = """<div class="review_item"><span class="review-content__date">Jan 5, 2021</span>
<span class="stars" style="width: 92.5%"></span><span class="review-content__title">Leaks</span>
<div class="review-content-body">Water on the floor</div>
<div class="media-carousel__media"><button style='background-image: url("https://i/a.jpg")'></button></div></div>
<div class="review_item"><span class="review-content__date">Jan 6, 2021</span><span class="stars"></span></div>"""


def test_homedepot_page(spark):
    landed = spark.createDataFrame([("hd", "t1", 1, "u", HD_PAGE)],
                                   "source string, target string, page_no int, url string, html string")
    a, b = sorted(html_extract.homedepot_page_reviews(landed).collect(), key=lambda r: r["pos"])
    assert a["rating"] == 4 and a["image"] == "https://i/a.jpg" and a["title"] == "Leaks" and not a["bad"]
    assert b["bad"]        # the stars style is required


def test_meta_and_listing(spark):
    page = ('<h1 class="page-title">Customer Reviews for\n<!-- -->ACME 8,000 BTU</h1>'
            '<h2 class="product-info-bar__detail--24WIp">Internet #1</h2>'
            '<h2 class="product-info-bar__detail--24WIp">Model #<!-- -->X1</h2>')
    df = spark.createDataFrame([("t", page)], "target string, html string")
    m = html_extract.homedepot_product_meta(df).collect()[0]
    assert (m["model_description"], m["model_no"], m["manufacturer"]) == ("ACME 8,000 BTU", "X1", "ACME")
    listing = ('<div class="browse-search__pod"><span class="product-pod__ratings-count">(3)</span>'
               '<a href="/p/a/1" class="header x">A</a></div>'
               '<div class="browse-search__pod"><a href="/p/b/2" class="header x">B</a></div>')
    ldf = spark.createDataFrame([("hd", "Window", 1, listing), ("hd", "Window", 2, listing)],
                                "source string, category string, page_no int, html string")
    got = [r["review_url"] for r in html_extract.homedepot_listing_targets(ldf).collect()]
    assert got == ["https://www.homedepot.com/p/reviews/a/1"]


def grid(html):
    from revlens.functions.html import parse

    return html_extract.spec_tables(parse(html))


def test_cells_fill_what_they_span():
    assert grid("<table><tr><td rowspan=2>a<td colspan='2'>b</td></tr><tr><td>c</td><td>d</td></tr></table>") == [
        [["a", "b", "b"], ["a", "c", "d"]]]
    assert grid("<table><tr><td>a</td><td rowspan=3>b</td><td>c</td></tr><tr><td>d</td></tr><tr></tr><tr><td>e</td></tr></table>") == [
        [["a", "b", "c"], ["d", "b"], ["b"], ["e"]]]
    assert grid("<table><tr><td rowspan='99' colspan=x>a</td><td rowspan=0>b</td></tr></table>") == [[["a", "b"]]]
    assert grid("<table><tr><td rowspan=2 colspan=2>a</td><td>b</td></tr><tr><td>c</td></tr></table>") == [[["a", "a", "b"], ["a", "a", "c"]]]


def test_nested_tables_keep_their_rows():
    html = ("<table><tr><td>a</td><td><table><tbody><tr><td>x</td></tr><tr><td>y</td></tr></tbody></table></td></tr>"
            "<tr><td>b</td></tr></table>")
    assert grid(html) == [[["a", "xy"], ["b"]], [["x"], ["y"]]]
    # end tags that are missing inside do not reach out of the inner table
    html = "<table><tr><td>a<td><table><tr><td>x<tr><td>y</table><td>c<tr><td>b</table>"
    assert grid(html) == [[["a", "xy", "c"], ["b"]], [["x"], ["y"]]]
    assert grid("<table><tr><td><table><tr><td>x</td></tr></td></tr></table><td>z</table>")[0][0][0] == "x"


def test_implied_ends_and_headings():
    assert grid("<table><thead><tr><th>h<tbody><tr><td>a<td>b<tr><td>c<tfoot><tr><td>d</table>") == [[["a", "b"], ["c"], ["d"]]]
    assert grid("<table><tr><th>h<th>i<tr><th>j<tr><td>a<th>b</table>") == [[["a", "b"]]]
    # with a thead, later rows of headings are data
    assert grid("<table><thead><tr><th>h</thead><tr><th>a<tr><td>b</table>") == [[["a"], ["b"]]]


def test_product_pages_of_a_small_table_are_parsed_by_many_tasks(spark):
    rows = [(i, f"name {i}", "Brand#1", "LARGE", i, 1.0) for i in [*range(400), None, None, 7, 7]]
    part = spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").coalesce(1)
    for pages in (testbed.product_pages(part), testbed.spec_pages(part)):
        sizes = pages.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) >= 4 * spark.sparkContext.defaultParallelism and sum(r["count"] for r in sizes) == len(rows)
        assert max(r["count"] for r in sizes) <= 2 * len(rows) / len(sizes) + 1          # whatever the keys
