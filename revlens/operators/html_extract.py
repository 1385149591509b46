"""Reviews and metadata out of landed HTML pages.

The parser job (``revlens.functions.html.parse_pages``) returns raw texts,
attributes and presence flags per page; this module holds the selector
logic of each layout and the Column expressions that type the results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens import params
from revlens.functions import fields
from revlens.functions.html import Node, parse_pages, strip

A, H, W = params.AMAZON, params.HOMEDEPOT, params.WALMART

# ---------------------------------------------------------------------------
# Extractors: parsed tree -> plain records (run in the Python worker).
# ---------------------------------------------------------------------------
AMAZON_RECORDS = T.ArrayType(T.StructType([
    T.StructField("date_text", T.StringType()),
    T.StructField("size_text", T.StringType()),
    T.StructField("rating_text", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("images", T.ArrayType(T.StringType())),
    T.StructField("images_ok", T.BooleanType()),
    T.StructField("badge", T.StringType()),
]))


def amazon_reviews(root: Node) -> list[dict]:
    """Every review block of an Amazon-layout page."""
    out = []
    for rv in root.sel_all(A["review"]):
        date, size, rating = rv.sel(A["date"]), rv.sel(A["size"]), rv.sel(A["rating"])
        title, body, badge = rv.sel(A["title"]), rv.sel(A["body"]), rv.sel(A["badge"])
        imgs = rv.sel_all(A["image"])
        out.append({
            "date_text": date.text if date else None,
            "size_text": size.text if size else None,
            "rating_text": rating.text if rating else None,
            "title": strip(title.text) if title else None,
            "body": strip(body.text) if body else None,
            "images": [i.attrs.get("src") for i in imgs],
            "images_ok": all("src" in i.attrs for i in imgs),
            "badge": strip(badge.text) if badge else None,
        })
    return out


HOMEDEPOT_RECORDS = T.ArrayType(T.StructType([
    T.StructField("date_text", T.StringType()),
    T.StructField("stars_style", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("media_styles", T.ArrayType(T.StringType())),
]))


def homedepot_reviews(root: Node) -> list[dict]:
    """Every ``review_item`` of a Home Depot-layout page."""
    out = []
    for rv in root.sel_all(H["review"]):
        date, stars = rv.sel(H["date"]), rv.sel(H["stars"])
        title, body = rv.sel(H["title"]), rv.sel(H["body"])
        styles = []
        for m in rv.sel_all(H["media"]):
            b = m.find("button")
            styles.append(b.attrs.get("style") if b is not None else None)
        out.append({
            "date_text": strip(date.text) if date else None,
            "stars_style": stars.attrs.get("style") if stars else None,
            "title": strip(title.text) if title else None,
            "body": strip(body.text) if body else None,
            "media_styles": styles,
        })
    return out


HOMEDEPOT_META = T.StructType([
    T.StructField("heading", T.StringType()),
    T.StructField("detail", T.StringType()),
])


def homedepot_meta(root: Node) -> dict:
    """E5: the page title heading and the second product detail bar."""
    h1 = root.sel(H["heading"])
    details = root.sel_all(H["detail"])
    return {"heading": h1.text if h1 else None, "detail": details[1].text if len(details) > 1 else None}


def first_h1(root: Node) -> str | None:
    """Text of the first ``h1``."""
    h = root.find("h1")
    return h.text if h is not None else None


TABLES = T.ArrayType(T.ArrayType(T.ArrayType(T.StringType())))


def _cell(n: Node) -> str:
    return " ".join(n.text.split())


def _span(cell: Node, name: str, most: int) -> int:
    said = cell.attrs.get(name, "").strip()
    return min(max(int(said), 1), most) if said.isdigit() else 1


def _own_rows(table: Node) -> list[Node]:
    """Rows of the table, without those of tables in its cells."""
    rows, stack = [], list(reversed(table.children))
    while stack:
        n = stack.pop()
        if not isinstance(n, Node) or n.tag == "table":
            continue
        if n.tag == "tr":
            rows.append(n)
        stack.extend(reversed(n.children))
    return rows


def _grid(rows: list[list[Node]]) -> list[list[str]]:
    """Cell texts by row: a cell fills every place it spans, down to the last row.  What still spans a row that ends
    before its column comes last in the row."""
    out: list[list[str]] = []
    above: list[tuple[int, str, int]] = []          # (column, text, rows it still fills) by column
    for cells in rows:
        row: list[str] = []
        below: list[tuple[int, str, int]] = []

        def put(column: int, text: str, high: int) -> None:
            row.append(text)
            if high > 1:
                below.append((column, text, high - 1))

        for cell in cells:
            while above and above[0][0] <= len(row):
                put(*above.pop(0))
            text, high = _cell(cell), _span(cell, "rowspan", 65534)
            for _ in range(_span(cell, "colspan", 1000)):
                put(len(row), text, high)
        for spanning in above:
            put(*spanning)
        above = sorted(below)
        if row:
            out.append(row)
    return out


def spec_tables(root: Node) -> list:
    """Every table as a grid of whitespace-normalised cell texts, tables in cells apart.  Cells that span rows or
    columns fill them; rows without cells are skipped; heading rows (in ``thead`` or, without one, the first rows of
    only ``th``) name the columns and are no data."""
    out = []
    for t in root.find_all("table"):
        rows = [(tr.parent.tag == "thead", [c for c in tr.children if isinstance(c, Node) and c.tag in ("td", "th")])
                for tr in _own_rows(t)]
        body = [cells for head, cells in rows if not head]
        if len(body) == len(rows):
            while body and all(c.tag == "th" for c in body[0]):
                body.pop(0)
        out.append(_grid(body))
    return out


HD_PODS = T.ArrayType(T.StructType([
    T.StructField("has_count", T.BooleanType()),
    T.StructField("href", T.StringType()),
]))


def homedepot_pods(root: Node) -> list[dict]:
    """Listing pods; the product link is the pod's anchor with an href
    and a class starting with 'header'."""
    out = []
    for pod in root.sel_all(H["pod"]):
        href = None
        for a in pod.find_all("a"):
            if "href" in a.attrs and a.attrs.get("class", "").startswith("header"):
                href = a.attrs["href"]
                break
        out.append({"has_count": pod.sel(H["ratings_count"]) is not None, "href": href})
    return out


WM_ITEMS = T.ArrayType(T.StructType([
    T.StructField("has_count", T.BooleanType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("href", T.StringType()),
    T.StructField("desc", T.StringType()),
]))


def walmart_items(root: Node) -> list[dict]:
    """Grid items; the product link is the item's second anchor, its
    description that anchor's first ``span``, its id the wrapper's data-id."""
    out = []
    for it in root.sel_all(W["grid_item"]):
        links = it.find_all("a")
        link = links[1] if len(links) > 1 else None
        span = link.find("span") if link is not None else None
        wrapper = it.sel(W["wrapper"])
        out.append({
            "has_count": it.sel(W["reviews_count"]) is not None,
            "product_id": wrapper.attrs.get("data-id") if wrapper is not None else None,
            "href": link.attrs.get("href") if link is not None else None,
            "desc": span.text.strip() if span is not None else None,
        })
    return out


def anchor_hrefs(root: Node) -> list[str]:
    """Every ``a[href]`` of a page, in document order."""
    return [a.attrs["href"] for a in root.find_all("a") if "href" in a.attrs]


# ---------------------------------------------------------------------------
# Spark side: explode the records and type them with Column expressions.
# ---------------------------------------------------------------------------
def _explode(parsed: DataFrame, col: str) -> DataFrame:
    keys = [c for c in parsed.columns if c != col]
    return parsed.select(*keys, F.posexplode(col).alias("pos", "__r")).select(*keys, "pos", "__r.*")


def amazon_page_reviews(landed: DataFrame) -> DataFrame:
    """Typed Amazon reviews ``(..., date, size, rating, title,
    body, image, badge, bad)``; ``bad`` marks a missing required field."""
    rows = _explode(parse_pages(landed, amazon_reviews, "__recs", AMAZON_RECORDS), "__recs")
    token = fields.trailing_date_token(F.col("date_text"))
    date = fields.parse_date(token, "amazon")
    rating = fields.rating_from_text(F.col("rating_text"))
    bad = (F.col("date_text").isNull() | (token == "") | date.isNull() | ~F.col("images_ok")
           | (F.col("rating_text").isNotNull() & rating.isNull()))
    return rows.select(
        *[c for c in landed.columns if c != "html"], "pos",
        date.alias("date"),
        fields.strip_size_label(F.col("size_text")).alias("size"),
        rating.alias("rating"),
        "title", "body",
        F.array_join(F.col("images"), "\n").alias("image"),
        "badge", bad.alias("bad"))


def homedepot_page_reviews(landed: DataFrame) -> DataFrame:
    """Typed Home Depot reviews with a ``bad`` flag."""
    rows = _explode(parse_pages(landed, homedepot_reviews, "__recs", HOMEDEPOT_RECORDS), "__recs")
    date = fields.parse_date(F.col("date_text"), "homedepot")
    urls = F.transform("media_styles", lambda s: fields.css_url(s))
    bad = (date.isNull() | F.col("stars_style").isNull()
           | F.regexp_extract(F.col("stars_style"), r"\d", 0).__eq__("")
           | F.exists(urls, lambda u: F.coalesce(u == "", F.lit(True))))
    return rows.select(
        *[c for c in landed.columns if c != "html"], "pos",
        date.alias("date"),
        fields.rating_from_width(F.col("stars_style")).alias("rating"),
        "title", "body",
        F.array_join(urls, "\n").alias("image"),
        bad.alias("bad"))


def homedepot_product_meta(pages: DataFrame) -> DataFrame:
    """Model description, model number and manufacturer per page."""
    m = parse_pages(pages, homedepot_meta, "__m", HOMEDEPOT_META)
    heading = fields.normalise_heading(F.col("__m.heading"))
    detail = F.replace(F.col("__m.detail"), F.lit("<!-- -->"), F.lit(""))
    desc = F.nullif(fields.description_from_heading(heading), F.lit(""))
    model = F.nullif(fields.model_from_heading(detail), F.lit(""))
    keys = [c for c in pages.columns if c != "html"]
    return m.select(*keys, desc.alias("model_description"), model.alias("model_no"),
                    F.nullif(fields.manufacturer(desc), F.lit("")).alias("manufacturer"))


def page_headline(pages: DataFrame) -> DataFrame:
    """First ``h1`` text of each page."""
    return parse_pages(pages, first_h1, "headline", T.StringType())


def page_links(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Anchor hrefs of each page with their position."""
    parsed = parse_pages(pages.select(key, "html"), anchor_hrefs, "__h", T.ArrayType(T.StringType()))
    return parsed.select(key, F.posexplode("__h").alias("pos", "href"))


PRODUCT_PAGE = T.StructType([T.StructField("headline", T.StringType()), T.StructField("tables", TABLES)])


def product_page(root: Node) -> dict:
    """E6 + E7 in one parse."""
    return {"headline": first_h1(root), "tables": spec_tables(root)}


def page_models(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Headline and model number of each product page, all within the page's row."""
    from revlens.operators.lookups import model_from_pairs, zip_spec_pairs

    parsed = parse_pages(pages, product_page, "__p", PRODUCT_PAGE)
    keys = [c for c in pages.columns if c != "html"]
    z = parsed.select(*keys, F.col("__p.headline").alias("headline"), zip_spec_pairs(F.col("__p.tables")).alias("__z"))
    return z.select(*keys, "headline", model_from_pairs(F.col("__z"), F.col(url_col)).alias("model_no"))


def homedepot_listing_targets(listing: DataFrame, prefix: str = params.HOMEDEPOT_REVIEW_PREFIX) -> DataFrame:
    """Distinct review-page URLs of pods with a ratings count."""
    pods = _explode(parse_pages(listing, homedepot_pods, "__p", HD_PODS), "__p")
    keep = pods.filter(F.col("has_count") & F.col("href").isNotNull())
    return keep.select("category", fields.review_url_from_href(F.col("href"), prefix).alias("review_url")).distinct()


def walmart_listing_targets(listing: DataFrame, keyword: str) -> DataFrame:
    """Distinct ``(product_id, url)`` of items with a review
    count whose description contains ``keyword`` (case-insensitive)."""
    items = _explode(parse_pages(listing, walmart_items, "__i", WM_ITEMS), "__i")
    keep = items.filter(F.col("has_count") & F.col("product_id").isNotNull() & F.col("desc").isNotNull()
                        & F.lower(F.col("desc")).contains(keyword.lower()))
    # a product listed under two descriptions is one target
    return keep.groupBy("category", "product_id", F.col("href").alias("url")).agg(F.min("desc").alias("description"))

