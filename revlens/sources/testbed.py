"""Review test bed derived deterministically from the supplied tables.

No supplied table is a review table, so one is derived from ``documents``.
The same derivation is written independently in SQL for the DuckDB oracles
(``revlens.plans.oracle``); neither side reads the other's output.

Per document (``t0`` = text before the first newline, ``b0`` = the rest):

* title: NULL if ``doc_id % 25 = 14``; ``left(b0, 20) || '...'`` if
  ``doc_id % 10 = 3`` and ``length(b0) > 20``; ``t0 || '...'`` if
  ``doc_id % 10 = 7``; else ``t0``.
* body: NULL if ``doc_id % 25 = 9``; the placeholder if ``doc_id % 25 = 4``;
  else ``b0``.
* rating: ``nullif((doc_id div 7) % 6, 0)``.
* date: 2024-01-30 minus ``(doc_id div 20) % 30`` days.
* target: ``source``; pos: ``doc_id``; page_no: ``doc_id div 400 + 1``.
* photos: ``doc_id % 3`` image URLs; badge on every fourth review; a size
  label unless ``doc_id % 11 = 5``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens import params
from revlens.session import spread

AS_OF = _dt.date(2024, 1, 30)
PAGE_SPAN = 400          # ids per landed page; a page holds at most this many reviews


def _split_first_line(text: Column) -> tuple[Column, Column]:
    nl = F.instr(text, "\n")
    t0 = F.when(nl > 0, F.expr("substring(text, 1, instr(text, '\n') - 1)")).otherwise(text)
    b0 = F.when(nl > 0, F.expr("substring(text, instr(text, '\n') + 1)")).otherwise(F.lit(""))
    return t0, b0


def reviews(documents: DataFrame) -> DataFrame:
    """One review per document, with every nullable branch exercised."""
    d = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "source")
    t0, b0 = _split_first_line(F.col("text"))
    d = d.select("doc_id", "source", t0.alias("t0"), b0.alias("b0"))
    m25 = F.col("doc_id") % 25
    m10 = F.col("doc_id") % 10
    title = (F.when(m25 == 14, F.lit(None).cast("string"))
             .when((m10 == 3) & (F.length("b0") > 20), F.concat(F.expr("left(b0, 20)"), F.lit("...")))
             .when(m10 == 7, F.concat("t0", F.lit("...")))
             .otherwise(F.col("t0")))
    body = (F.when(m25 == 9, F.lit(None).cast("string"))
            .when(m25 == 4, F.lit(params.PLACEHOLDER_BODY))
            .otherwise(F.col("b0")))
    rating = F.expr("nullif(cast((doc_id div 7) % 6 as int), 0)")
    date = F.date_sub(F.lit(AS_OF), (F.expr("(doc_id div 20) % 30")).cast("int"))
    photos = F.expr(
        "transform(sequence(0, cast(doc_id % 3 as int) - 1, 1), "
        "k -> concat('https://img.example.com/r/', cast(doc_id as string), '/', cast(k as string), '.jpg'))")
    photos = F.when(F.col("doc_id") % 3 == 0, F.array().cast("array<string>")).otherwise(photos)
    badge = F.when(F.col("doc_id") % 4 == 0, F.lit("Verified Purchase"))
    size = F.when(F.col("doc_id") % 11 != 5,
                  F.concat((F.col("doc_id") % 60).cast("string"), F.lit(" BTU")))
    return d.select(
        "doc_id",
        F.col("source").alias("target"),
        F.col("doc_id").alias("pos"),
        (F.expr(f"doc_id div {PAGE_SPAN}") + 1).cast("int").alias("page_no"),
        date.alias("date"),
        rating.alias("rating"),
        title.alias("title"),
        body.alias("body"),
        photos.alias("photos"),
        F.array_join(photos, "\n").alias("image"),
        badge.alias("badge"),
        size.alias("size"),
    )


def training_set(documents: DataFrame, labels: DataFrame, low: str = "low quality", toxic: str = "toxic",
                 of=None) -> DataFrame:
    """Training rows ``(doc_id, title, body, category)`` from ``labels``.

    quality 0 -> ``low``, toxic 1 -> ``toxic``, both -> the two joined by
    `` / ``; any other labelled row has a blank category.  ``of`` derives the
    reviews from the documents (default: ``reviews``).
    """
    cat = (F.when((F.col("quality") == 0) & (F.col("toxic") == 1), F.lit(f"{low} / {toxic}"))
           .when(F.col("quality") == 0, F.lit(low))
           .when(F.col("toxic") == 1, F.lit(toxic))
           .otherwise(F.lit("")))
    r = (of or reviews)(documents).select("doc_id", "title", "body")
    return labels.select("doc_id", cat.alias("category")).join(r, "doc_id", "inner")




# Rule dictionary for the test bed.  The issue patterns almost never match
# the invented prose, so this dictionary uses the same pattern shapes
# (alternation, character classes, lazy dots, non-capturing groups, runs,
# quantifiers) on words that do occur.
TEST_RULES = [
    ("license", "licen[sc]e|copyright"),
    ("contact", "[a-z0-9._]+@[a-z0-9.]+"),
    ("decimal", "the.+?tion.+?and|\\d\\.\\d"),
    ("gap", "(?:not|was|were|are)[a-z\\s]+(?:than|from|other)"),
    ("number", "\\d{3}"),
]
TEST_ML_TAGS = ["low quality", "toxic"]


# ---------------------------------------------------------------------------
# Landed layouts rendered from the review test bed.
#
# Pages hold the reviews of one target whose ids fall in one block of
# PAGE_SPAN ids (so a page is bounded whatever the skew).  Each target gets an
# empty page at page ``cut = 2 + ascii(last char of target) % 3``; data pages
# from ``cut`` on move up by one, so reading must stop before them.  A few
# reviews lack a required key, which fails their target if it is read.
# ---------------------------------------------------------------------------
WALMART_FAIL = ((97, 13), (101, 17), (211, 19))   # doc_id % m = r: no "photos" key; null; a photo without URL
LOWES_FAIL = ((89, 7), (101, 17), (211, 19))      # the same for "Photos"
EMPTY_LISTS = ["[]", "null", "{}", '""', "0", "false"]   # what ends a target instead of a list of reviews
HALF_RATING = (7, 1)         # doc_id % 7 = 1: the rating is half a point higher


def cut_page(target: Column) -> Column:
    return (F.lit(2) + F.ascii(F.substring(target, -1, 1)) % 3).cast("int")


def _photo_structs(photos: Column) -> Column:
    return F.transform(photos, lambda u: F.struct(F.struct(F.struct(u.alias("Url")).alias("normal")).alias("Sizes")))


def _json(*cols: Column) -> Column:
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def _with_photos(base: list[Column], name: str, fail: tuple) -> Column:
    """A review object whose photo list is missing, null or holds a photo without URL on some ids."""
    missing, null, no_url = (F.col("doc_id") % m == r for m, r in fail)
    photos = _photo_structs(F.col("photos"))
    hole = F.transform(F.array(F.lit(None).cast("string")), lambda u: F.struct(F.struct(F.struct(u.alias("Url"))
                                                                               .alias("normal")).alias("Sizes")))
    value = F.when(~null, F.when(no_url, hole).otherwise(photos))
    return F.when(missing, _json(*base)).otherwise(_json(*base, value.alias(name)))


def payload_rating(rating: Column, doc_id: Column) -> Column:
    """Ratings as numbers with a fraction (4.0, 4.5)."""
    return rating.cast("double") + F.when(doc_id % HALF_RATING[0] == HALF_RATING[1], 0.5).otherwise(0.0)


def _render_pages(reviews_df: DataFrame, review_json: Column, wrap, source: str) -> DataFrame:
    r = reviews_df.select("target", "page_no", "pos", review_json.alias("j"))
    cut = cut_page(F.col("target"))
    r = r.withColumn("page_no", F.when(F.col("page_no") >= cut, F.col("page_no") + 1).otherwise(F.col("page_no")))
    pages = r.groupBy("target", "page_no").agg(F.sort_array(F.collect_list(F.struct("pos", "j"))).alias("items"))
    arr = F.concat(F.lit("["), F.array_join(F.transform("items", lambda x: x["j"]), ","), F.lit("]"))
    data = pages.select(F.lit(source).alias("source"), "target", "page_no", wrap(F.col("target"), arr).alias("payload"))
    lists = F.array(*[F.lit(e) for e in EMPTY_LISTS])
    nothing = F.element_at(lists, (last_code(F.col("target")) % len(EMPTY_LISTS) + 1).cast("int"))
    empty = (reviews_df.select("target").distinct()
             .select(F.lit(source).alias("source"), "target", cut.alias("page_no"),
                     wrap(F.col("target"), nothing).alias("payload")))
    return data.unionByName(empty)


def landed_walmart(reviews_df: DataFrame) -> DataFrame:
    """Walmart-layout payload pages: ``payload.reviews[target].customerReviews``."""
    d = F.col("date")
    date_text = F.when(F.col("doc_id") % 2 == 0, F.date_format(d, "MM/dd/yyyy")).otherwise(F.date_format(d, "M/d/yyyy"))
    base = [date_text.alias("reviewSubmissionTime"), payload_rating(F.col("rating"), F.col("doc_id")).alias("rating"),
            F.col("title").alias("reviewTitle"), F.col("body").alias("reviewText")]
    j = _with_photos(base, "photos", WALMART_FAIL)

    def wrap(target, arr):
        return F.concat(F.lit('{"payload":{"reviews":{"'), target, F.lit('":{"customerReviews":'), arr, F.lit("}}}}"))

    return _render_pages(reviews_df, j, wrap, "walmart")


def landed_lowes(reviews_df: DataFrame) -> DataFrame:
    """Lowes-layout payload pages: ``Results`` array."""
    ts = F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T10:00:00.000+00:00"))
    base = [ts.alias("SubmissionTime"), payload_rating(F.col("rating"), F.col("doc_id")).alias("Rating"), F.col("title").alias("Title"),
            F.col("body").alias("ReviewText")]
    j = _with_photos(base, "Photos", LOWES_FAIL)

    def wrap(target, arr):
        return F.concat(F.lit('{"Results":'), arr, F.lit("}"))

    return _render_pages(reviews_df, j, wrap, "lowes")


def _dups_before(page: Column, a: Column) -> Column:
    """Re-observed pages before ``page``: page q is observed twice when
    q and the target's last character code have the same parity."""
    return F.when(a % 2 == 0, F.floor((page - 1) / 2)).otherwise(F.floor(page / 2)).cast("int")


def pager_sequence(reviews_df: DataFrame) -> DataFrame:
    """Pager observations ``(target, seq, page_label)`` with a dense fetch
    counter: each page once, some observed twice in a row, then a wrap back
    to page 1 and one more page after it."""
    p = reviews_df.select("target", "page_no").distinct()
    a = F.ascii(F.substring("target", -1, 1))
    lbl = F.col("page_no").cast("string")
    first = F.col("page_no") + _dups_before(F.col("page_no"), a)
    obs = p.select("target", first.alias("seq"), lbl.alias("page_label"))
    dup = p.filter(F.col("page_no") % 2 == a % 2).select("target", (first + 1).alias("seq"), lbl.alias("page_label"))
    last = p.groupBy("target").agg(F.max("page_no").alias("P"))
    total = F.col("P") + _dups_before(F.col("P") + 1, F.ascii(F.substring("target", -1, 1)))
    wrap1 = last.select("target", (total + 1).alias("seq"), F.lit("1").alias("page_label"))
    wrap2 = last.select("target", (total + 2).alias("seq"), F.lit("2").alias("page_label"))
    return obs.unionByName(dup).unionByName(wrap1).unionByName(wrap2)


# ---------------------------------------------------------------------------
# HTML layouts.  Text is escaped (& < >); the parser must unescape it.
# ---------------------------------------------------------------------------
AMAZON_FAIL = (193, 13)      # doc_id % 193 = 13: a rating text that starts with no digit
HOMEDEPOT_FAIL = (83, 21)    # doc_id % 83 = 21: stars element without style
META_SHORT = (9, 4)          # p_partkey % 9 = 4: only one detail bar (no model number)
WALMART_PAGE_URL = "https://www.walmart.com/ip/"


def esc(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def _opt(cond: Column, piece: Column) -> Column:
    return F.when(cond, piece).otherwise(F.lit(""))


def _html_pages(blocks: DataFrame, source: str, head: str, tail: str) -> DataFrame:
    pages = blocks.groupBy("target", "page_no").agg(F.sort_array(F.collect_list(F.struct("pos", "b"))).alias("items"))
    html = F.concat(F.lit(head), F.array_join(F.transform("items", lambda x: x["b"]), ""), F.lit(tail))
    url = F.concat(F.lit(f"https://{source}.example.com/reviews/"), F.col("target"), F.lit("?page="),
                   F.col("page_no").cast("string"))
    return pages.select(F.lit(source).alias("source"), "target", "page_no", url.alias("url"), html.alias("html"))


def landed_amazon(reviews_df: DataFrame) -> DataFrame:
    """Amazon-layout review pages: ``div[data-hook=review]`` blocks."""
    c = F.col
    date_text = F.concat(F.lit("Reviewed in the United States on "), F.date_format("date", "MMMM d, yyyy"))
    imgs = F.array_join(F.transform("photos", lambda u: F.concat(
        F.lit('<img data-hook="review-image-tile" alt="" src="'), u, F.lit('">'))), "")
    block = F.concat(
        F.lit('<div data-hook="review" class="a-section review"><div class="a-row">'),
        F.lit('<span data-hook="review-date" class="a-size-base">'), date_text, F.lit("</span></div>"),
        _opt(c("size").isNotNull(), F.concat(F.lit('<a data-hook="format-strip" class="a-link">Size: '),
                                             esc(c("size")), F.lit("</a>"))),
        _opt(c("rating").isNotNull(), F.concat(
            F.lit('<i data-hook="review-star-rating" class="a-icon"><span class="a-icon-alt">'),
            F.when(c("doc_id") % AMAZON_FAIL[0] == AMAZON_FAIL[1], F.lit("N/A")).otherwise(
                F.concat(c("rating").cast("string"), F.lit(".0 out of 5 stars"))), F.lit("</span></i>"))),
        _opt(c("title").isNotNull(), F.concat(F.lit('<a data-hook="review-title" href="#"><span>'),
                                              esc(c("title")), F.lit("</span></a>"))),
        _opt(c("body").isNotNull(), F.concat(F.lit('<span data-hook="review-body" class="a-size-base"><span>'),
                                             esc(c("body")), F.lit("</span></span>"))),
        imgs,
        _opt(c("badge").isNotNull(), F.concat(F.lit('<span data-hook="avp-badge">'), c("badge"), F.lit("</span>"))),
        F.lit("</div>"))
    blocks = reviews_df.select("target", "page_no", "pos", block.alias("b"))
    return _html_pages(blocks, "amazon", '<html><head><title>Reviews</title></head><body><div id="cm_cr-review_list">',
                       "</div></body></html>")


def homedepot_width(rating: Column, doc_id: Column) -> Column:
    """Stars width: rating * 20 %, with a fractional width one step lower on
    odd ids (e.g. 70.5% for a 4) to exercise the floor division."""
    return F.when((doc_id % 2 == 1) & (rating >= 1),
                  F.concat((rating * 20 - 10).cast("string"), F.lit(".5%"))).otherwise(
        F.concat((F.coalesce(rating, F.lit(0)) * 20).cast("string"), F.lit("%")))


def landed_homedepot(reviews_df: DataFrame) -> DataFrame:
    """Home Depot-layout review pages: ``div.review_item`` blocks."""
    c = F.col
    m, k = HOMEDEPOT_FAIL
    stars = F.when(c("doc_id") % m == k, F.lit('<span class="stars"></span>')).otherwise(
        F.concat(F.lit('<span class="stars" style="width: '), homedepot_width(c("rating"), c("doc_id")),
                 F.lit('"></span>')))
    media = F.array_join(F.transform("photos", lambda u: F.concat(
        F.lit('<div class="media-carousel__media"><button style=\'background-image: url("'), u,
        F.lit('")\'></button></div>'))), "")
    block = F.concat(
        F.lit('<div class="review_item">'),
        F.lit('<span class="review-content__date">'), F.date_format("date", "MMM d, yyyy"), F.lit("</span>"),
        stars,
        _opt(c("title").isNotNull(), F.concat(F.lit('<span class="review-content__title">'), esc(c("title")),
                                              F.lit("</span>"))),
        _opt(c("body").isNotNull(), F.concat(F.lit('<div class="review-content-body">'), esc(c("body")),
                                             F.lit("</div>"))),
        media, F.lit("</div>"))
    blocks = reviews_df.select("target", "page_no", "pos", block.alias("b"))
    return _html_pages(blocks, "homedepot", "<html><body><section class='reviews'>", "</section></body></html>")


def product_pages(part: DataFrame) -> DataFrame:
    """Home Depot-layout product pages, one per part: heading and detail bars."""
    c = F.col
    key = c("p_partkey").cast("string")
    m, k = META_SHORT
    h1 = F.concat(F.lit('<h1 class="page-title">Customer Reviews for\n<!-- -->'), esc(c("p_brand")), F.lit(" "),
                  esc(c("p_name")), F.lit("</h1>"))
    bar = F.lit('<h2 class="product-info-bar__detail--24WIp">')
    details = F.concat(bar, F.lit("Internet #"), key, F.lit("</h2>"),
                       _opt(c("p_partkey") % m != k, F.concat(bar, F.lit("Model #<!-- -->"), c("p_type"),
                                                              F.lit("-"), key, F.lit("</h2>"))))
    html = F.concat(F.lit("<html><body><div class='product'>"), h1, details, F.lit("</div></body></html>"))
    return spread(part).select(key.alias("target"), html.alias("html"))


def _td_row(a: Column, b: Column | None = None) -> Column:
    if b is None:
        return F.concat(F.lit("<tr><td>"), a, F.lit("</td></tr>"))
    return F.concat(F.lit("<tr><td>"), a, F.lit("</td><td>"), b, F.lit("</td></tr>"))


SPEC_SHAPES = 7


def spec_pages(part: DataFrame) -> DataFrame:
    """Walmart-layout product pages with spec tables, one per part; the table
    shape cycles with ``p_partkey % SPEC_SHAPES`` (see the model-number oracle)."""
    c = F.col
    key = c("p_partkey").cast("string")
    L = F.lit
    heading, one_heading = L("<tr><th>Feature</th><th>Value</th></tr><tr></tr>"), L("<tr><th>Feature</th></tr>")
    ragged = L('<tr><td colspan="2">General</td></tr>')
    t0 = F.concat(L("<table>"), heading, _td_row(L("Brand"), c("p_brand")),
                  _td_row(L("Manufacturer Part Number"), F.concat(L("MPN-"), key)),
                  _td_row(L("Model"), esc(c("p_name"))), _td_row(L("Model"), F.concat(L("X"), key)), L("</table>"))
    t1 = F.concat(L("<table><thead>"), heading, L("</thead>"), ragged, _td_row(L("Manufacturer Part Number"), F.concat(L("MPN-"), key)),
                  _td_row(L("manufacturer_part_number"), F.concat(L("mpn-"), c("p_type"))),
                  _td_row(L("Color"), L("White")), L("</table>"))
    t2 = F.concat(L("<table>"), one_heading, _td_row(L("Color")), _td_row(L("Model")), _td_row(L("Brand")), L("</table>"),
                  L("<table>"), _td_row(L("Value")), _td_row(L("White")), _td_row(esc(c("p_name"))),
                  _td_row(c("p_brand")), L("</table>"))
    t3 = F.concat(L("<table>"), ragged, L("<tr></tr>"), _td_row(L("Color"), L("White")),
                  _td_row(L("Size"), c("p_size").cast("string")), L("</table>"))
    # the feature spans two rows, so the second value is its too
    t4 = F.concat(L('<table><tr><td rowspan="2">Manufacturer Part Number</td><td>A-'), key, L("</td></tr><tr><td>B-"), key,
                  L("</td></tr>"), ragged, L("</table>"))
    # the second table lies in a cell of the first; its rows are not rows of the first
    values = F.concat(L("<table>"), _td_row(L("Value")), _td_row(L("White")), _td_row(esc(c("p_name"))), _td_row(L("z")), L("</table>"))
    t5 = F.concat(L("<table>"), _td_row(L("Color"), values), _td_row(L("Model")), _td_row(L("Brand")), L("</table>"))
    # no end tags
    t6 = F.concat(L("<table><tbody><tr><td>Manufacturer Part Number<td>MPN-"), key, L("<tr><td>Model<td>"), esc(c("p_name")),
                  L("<tr><td>Color<td>White</table>"))
    shapes = [t0, t1, t2, t3, t4, t5, t6]
    m = c("p_partkey") % SPEC_SHAPES
    tables = shapes[-1]
    for k, shape in enumerate(shapes[:-1]):
        tables = F.when(m == k, shape).otherwise(tables)
    html = F.concat(L("<html><body><h1>"), esc(c("p_name")), L("</h1>"), tables, L("</body></html>"))
    return spread(part).select(key.alias("target"), F.concat(L(WALMART_PAGE_URL), key).alias("url"), html.alias("html"))


LISTING_PODS = 24            # products per listing page


def homedepot_listing(part: DataFrame) -> DataFrame:
    """Home Depot-layout listing pages per ``p_type`` category; a product
    shows a ratings count unless ``p_size % 3 = 0``; every product whose key
    is a multiple of 5 is listed again on the next page."""
    c = F.col
    key = c("p_partkey").cast("string")
    pod = F.concat(
        F.lit('<div class="browse-search__pod"><div class="product-pod">'),
        _opt(c("p_size") % 3 != 0, F.concat(F.lit('<span class="product-pod__ratings-count">('),
                                            c("p_size").cast("string"), F.lit(")</span>"))),
        F.lit('<a href="/p/'), F.regexp_replace(c("p_name"), " ", "-"), F.lit("/"), key,
        F.lit('" class="header product-pod--ie-fix"><span>'), esc(c("p_name")), F.lit("</span></a></div></div>"))
    base = part.select(c("p_type").alias("category"), (c("p_partkey") / LISTING_PODS).cast("int").alias("page_no"),
                       c("p_partkey").alias("pos"), pod.alias("b"))
    again = part.filter(c("p_partkey") % 5 == 0).select(
        c("p_type").alias("category"), ((c("p_partkey") / LISTING_PODS).cast("int") + 1).alias("page_no"),
        c("p_partkey").alias("pos"), pod.alias("b"))
    b = base.unionByName(again)
    pages = b.groupBy("category", "page_no").agg(F.sort_array(F.collect_list(F.struct("pos", "b"))).alias("items"))
    html = F.concat(F.lit("<html><body><div class='results'>"),
                    F.array_join(F.transform("items", lambda x: x["b"]), ""), F.lit("</div></body></html>"))
    return pages.select(F.lit("homedepot").alias("source"), "category", "page_no", html.alias("html"))


def walmart_listing(part: DataFrame) -> DataFrame:
    """Walmart-layout listing pages per ``p_type``: grid items with the
    product link as the second anchor; a review count unless ``p_size % 4 = 0``."""
    c = F.col
    key = c("p_partkey").cast("string")
    item = F.concat(
        F.lit('<div class="Grid-col u-size-6-12 u-size-1-4-m u-size-1-5-xl">'),
        F.lit('<div class="search-result-gridview-item-wrapper" data-id="'), key, F.lit('">'),
        F.lit('<a class="img-link" href="'), F.lit(WALMART_PAGE_URL), key, F.lit('"><img src="x.jpg"></a>'),
        F.lit('<a class="product-title-link" href="'), F.lit(WALMART_PAGE_URL), key, F.lit('"><span>'),
        esc(c("p_name")), F.lit("</span></a>"),
        _opt(c("p_size") % 4 != 0, F.concat(F.lit('<span class="stars-reviews-count">'),
                                            c("p_size").cast("string"), F.lit(" reviews</span>"))),
        F.lit("</div></div>"))
    b = part.select(c("p_type").alias("category"), (c("p_partkey") / LISTING_PODS).cast("int").alias("page_no"),
                    c("p_partkey").alias("pos"), item.alias("b"))
    # every seventh product is listed again under a longer description
    again = part.filter(c("p_partkey") % 7 == 0).select(
        c("p_type").alias("category"), (c("p_partkey") / LISTING_PODS + 1).cast("int").alias("page_no"),
        c("p_partkey").alias("pos"), F.replace(item, F.lit("</span></a>"), F.lit(" new</span></a>")).alias("b"))
    b = b.unionByName(again)
    pages = b.groupBy("category", "page_no").agg(F.sort_array(F.collect_list(F.struct("pos", "b"))).alias("items"))
    html = F.concat(F.lit("<html><body><div class='search-grid'>"),
                    F.array_join(F.transform("items", lambda x: x["b"]), ""), F.lit("</div></body></html>"))
    return pages.select(F.lit("walmart").alias("source"), "category", "page_no", html.alias("html"))


# ---------------------------------------------------------------------------
# Inputs of the end-to-end flows: metadata for half of the targets only,
# models without a description, repeated and wrapped pages, equal reviews.
# ---------------------------------------------------------------------------
TWICE = (10, 3)              # doc_id % 10 = 3: the review stands on its page twice
MODELS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "XL"]   # the last ones have no description


def last_code(target: Column) -> Column:
    return F.ascii(F.substring(target, -1, 1))


def target_models(reviews_df: DataFrame) -> DataFrame:
    """(target, model_no) of every target."""
    models = F.array(*[F.lit(m) for m in MODELS])
    return reviews_df.select("target").distinct().select(
        "target", F.element_at(models, (last_code(F.col("target")) % len(MODELS) + 1).cast("int")).alias("model_no"))


SECOND_MODEL = 3             # last code % 3 = 0: the target is also listed under the next model


def target_runs(reviews_df: DataFrame) -> DataFrame:
    """(target, model_no) of every target, some of them under a second model."""
    first = target_models(reviews_df)
    models = F.array(*[F.lit(m) for m in MODELS])
    second = first.where(last_code(F.col("target")) % SECOND_MODEL == 0).select(
        "target", F.element_at(models, ((last_code(F.col("target")) + 1) % len(MODELS) + 1).cast("int")).alias("model_no"))
    return first.unionByName(second)


def model_descriptions(part: DataFrame) -> DataFrame:
    """(model_no, model_description) for the part types."""
    return part.groupBy(F.col("p_type").alias("model_no")).agg(F.min_by("p_name", "p_partkey").alias("model_description"))


def listed_twice(landed: DataFrame) -> DataFrame:
    """Every product under a second target with the same reviews."""
    return landed.unionByName(landed.withColumn("target", F.concat("target", F.lit("-b"))))


def target_of_part() -> Column:
    """Product pages belong to the targets with even numbers."""
    return F.concat(F.lit("src"), (F.col("target").cast("long") * 2).cast("string"))


def amazon_walk(reviews_df: DataFrame) -> DataFrame:
    """Amazon pages with equal reviews; for targets with an even last code the third page has the second's address."""
    m, k = TWICE
    landed = landed_amazon(reviews_df.unionByName(reviews_df.filter(F.col("doc_id") % m == k)))
    stuck = (last_code(F.col("target")) % 2 == 0) & (F.col("page_no") == 3)
    return landed.withColumn("url", F.when(stuck, F.regexp_replace("url", "page=3$", "page=2")).otherwise(F.col("url")))


def homedepot_walk(reviews_df: DataFrame) -> DataFrame:
    """Home Depot pages as the pager showed them: some twice, then page 1 again and one more.  Targets with an odd last
    code show no label on their first page."""
    seen = pager_sequence(reviews_df).withColumn("shown", F.col("page_label").cast("int"))
    landed = landed_homedepot(reviews_df).withColumnRenamed("page_no", "shown")
    unlabelled = (F.col("seq") == 1) & (last_code(F.col("target")) % 2 == 1)
    return seen.join(landed, ["target", "shown"]).select(
        "source", "target", F.col("seq").alias("page_no"), F.when(~unlabelled, F.col("page_label")).alias("page_label"),
        "url", "html")


def with_shown_pager(walk: DataFrame) -> DataFrame:
    """Home Depot pages that show their label themselves, beside one in a comment and one of another class."""
    pager = F.concat(F.lit('<!--<span class="pager-summary__bold">0</span>--><span class="pager-summary">9</span>'
                           '<span id="p" class="u pager-summary__bold">'), F.col("page_label"), F.lit("</span>of many"))
    shown = F.concat(F.coalesce(pager, F.lit("")), F.lit("<section"))
    return walk.withColumn("html", F.replace(F.col("html"), F.lit("<section"), shown)).drop("page_label")


# ---------------------------------------------------------------------------
# Reviews that hit and narrowly miss the issue rules.
# ---------------------------------------------------------------------------
PHRASES = [
    "too loud", "nice sound", "it makes a weird sound", "it blinks then 88", "shows 8x8", "error 8.8 again",
    "did not receive it", "notreceive", "parts missing", "i used it because", "previous  return", "i was confused",
    "wi-fi dropped", "wi fi dropped", "88 then an error", "sounds nothing like that", "be careful not to include", "rattling",
]


def issue_reviews(documents: DataFrame) -> DataFrame:
    """The review test bed with a phrase in front of every title (even ids) or body (odd ids)."""
    phrases = F.array(*[F.lit(p) for p in PHRASES])
    phrase = F.element_at(phrases, (F.floor(F.col("doc_id") / 2) % len(PHRASES) + 1).cast("int"))
    even = F.col("doc_id") % 2 == 0
    return reviews(documents).withColumns({
        "title": F.when(even, F.concat(phrase, F.lit(" "), F.coalesce("title", F.lit("")))).otherwise(F.col("title")),
        "body": F.when(~even, F.concat(phrase, F.lit(" "), F.coalesce("body", F.lit("")))).otherwise(F.col("body"))})


# ---------------------------------------------------------------------------
# Inputs of whole runs: config files and listings made from ``part``, targets named as a source names them.
# ---------------------------------------------------------------------------
AMAZON_URL = "https://www.amazon.com/dp/"
LOWES_URL = "https://www.lowes.com/pd/x/"
NOT_LANDED = ("src-none", "PROMO")       # a configured run whose target has no landed page
NO_LABEL = 6                             # the fetch that shows no pager label, for targets with last code % 3 = 1


def source_number(target: Column) -> Column:
    """``src12`` -> 12: the part that stands for a target."""
    return F.substring(target, 4, 20).cast("long")


def _as_map(rows: DataFrame, key: str, value: str) -> DataFrame:
    return rows.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, value))))).alias("json"))


def lowes_config(reviews_df: DataFrame, part: DataFrame) -> DataFrame:
    """One row with the text of a Lowes config file (as long as the list of models and targets)."""
    runs = target_runs(reviews_df).unionByName(reviews_df.sparkSession.range(1).select(
        F.lit(NOT_LANDED[0]).alias("target"), F.lit(NOT_LANDED[1]).alias("model_no")))
    urls = runs.groupBy("model_no").agg(F.sort_array(F.collect_list(F.concat(F.lit(LOWES_URL), "target"))).alias("urls"))
    urls, names = _as_map(urls, "model_no", "urls"), _as_map(model_descriptions(part), "model_no", "model_description")
    return urls.select(F.col("json").alias("u"), F.lit(1).alias("one")).join(names.select("json", F.lit(1).alias("one")), "one").select(
        F.concat(F.lit('{"urls":'), "u", F.lit(',"model2desc":'), "json", F.lit("}")).alias("value"))


def amazon_models(reviews_df: DataFrame, part: DataFrame) -> DataFrame:
    """(target, url, model_no, model_description) of the targets with an even last code; every fifth has no description."""
    t = reviews_df.select("target").distinct().where(last_code(F.col("target")) % 2 == 0)
    names = part.select(F.col("p_partkey").alias("key"), "p_name")
    t = t.withColumn("key", source_number(F.col("target")) + 1).join(names, "key", "left")
    return t.select("target", F.concat(F.lit(AMAZON_URL), "target").alias("url"), F.concat(F.lit("AM-"), "target").alias("model_no"),
                    F.when(F.col("key") % 5 != 0, F.col("p_name")).alias("model_description"))


def amazon_config(reviews_df: DataFrame, part: DataFrame, size2model: DataFrame) -> DataFrame:
    """One row with the text of an Amazon config file: a category with models, one with a single address."""
    models = amazon_models(reviews_df, part)
    sizes = size2model.select("size", F.array("model_no", "model_description").alias("of"))
    parts = {"u": _as_map(models, "model_no", "url"), "s": _as_map(sizes, "size", "of"),
             "d": _as_map(models.where("model_description IS NOT NULL"), "model_no", "model_description"),
             "one": reviews_df.agg(F.min("target").alias("json"))}
    row = reviews_df.sparkSession.range(1).select(F.lit(1).alias("k"))
    for name, of in parts.items():
        row = row.join(of.select(F.lit(1).alias("k"), F.col("json").alias(name)), "k")
    return row.select(F.concat(F.lit('{"urls":{"Window":'), "u", F.lit(f',"Portable":"{AMAZON_URL}'), "one", F.lit('"},"size2model":'), "s",
                               F.lit(',"model2desc":'), "d", F.lit("}")).alias("value"))


def window_parts(part: DataFrame) -> DataFrame:
    """Parts of one category, ``Window``, which two thirds of their names say."""
    said = F.when(F.col("p_partkey") % 3 != 0, F.concat("p_name", F.lit(" window unit"))).otherwise(F.col("p_name"))
    return part.withColumns({"p_type": F.lit("Window"), "p_name": said})


def homedepot_targets(part: DataFrame) -> DataFrame:
    """(target, review_url): the review page that the listing of a target's part leads to."""
    href = F.concat(F.lit(params.HOMEDEPOT_REVIEW_PREFIX), F.lit("/"), F.replace(F.col("p_name"), F.lit(" "), F.lit("-")), F.lit("/"),
                    F.col("p_partkey").cast("string"))
    return part.select(F.concat(F.lit("src"), F.col("p_partkey").cast("string")).alias("target"), href.alias("review_url"))
