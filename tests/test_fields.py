"""Field parsing and lookups (FIXTURES 3.3-3.5, 3.7)."""

import datetime as dt

from pyspark.sql import functions as F

from revlens.functions import fields
from revlens.operators import lookups, recency


def _one(spark, col_expr, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(col_expr.alias("o")).collect()[0]["o"]


def test_dates(spark):
    v = F.col("v")
    d = dt.date(2021, 1, 5)
    assert _one(spark, fields.parse_date(fields.trailing_date_token(v), "amazon"),
                "Reviewed in the United States on January 5, 2021") == d
    assert _one(spark, fields.parse_date(v, "homedepot"), "Jan 5, 2021") == d
    assert _one(spark, fields.parse_date(v, "walmart"), "1/5/2021") == d
    assert _one(spark, fields.parse_date(v, "walmart"), "01/05/2021") == d
    assert _one(spark, fields.parse_date(fields.iso_date_prefix(v), "lowes"), "2021-01-05T10:00:00.000+00:00") == d
    assert _one(spark, fields.parse_date(v, "walmart"), "junk") is None


def test_ratings_and_urls(spark):
    v = F.col("v")
    assert _one(spark, fields.rating_from_text(v), "4.0 out of 5 stars") == 4
    for style, want in (("width: 80%", 4), ("width: 92.5%", 4), ("width: 100%", 5)):
        assert _one(spark, fields.rating_from_width(v), style) == want
    assert _one(spark, fields.last_path_segment(v), "https://x/pd/ac/1001") == "1001"
    assert _one(spark, fields.review_url_from_href(v), "/p/acme/123") == "https://www.homedepot.com/p/reviews/acme/123"
    assert _one(spark, fields.css_url(v), 'background-image: url("https://i/x.jpg")') == "https://i/x.jpg"
    assert _one(spark, fields.strip_size_label(v), "Size: 8,000 BTU") == "8,000 BTU"
    assert _one(spark, fields.manufacturer(v), "  ACME 8,000 BTU") == "ACME"
    assert _one(spark, fields.description_from_heading(fields.normalise_heading(v)),
                "Customer Reviews for\nACME 8,000 BTU") == "ACME 8,000 BTU"


def test_photos_join(spark):
    df = spark.createDataFrame([([],), ([{"Sizes": {"normal": {"Url": "a"}}}, {"Sizes": {"normal": {"Url": "b"}}}],)],
                               "p array<struct<Sizes:struct<normal:struct<Url:string>>>>")
    assert [r["o"] for r in df.select(fields.join_photo_urls(F.col("p")).alias("o")).collect()] == ["", "a\nb"]


def test_category_split(spark):
    df = spark.createDataFrame([(" Sound / WiFi ",), ("a / b/c",), (None,)], "c string")
    out = [list(r["t"]) if r["n"] else [] for r in
           df.select(fields.normalise_category(F.col("c")).alias("n"),
                     fields.split_tags(fields.normalise_category(F.col("c"))).alias("t")).collect()]
    assert out == [["sound", "wifi"], ["a", "b/c"], []]


def test_size_lookup(spark):
    reviews = spark.createDataFrame([(1, "8,000 BTU"), (2, "9,000 BTU"), (3, None)], "id int, size string")
    s2m = spark.createDataFrame([("8,000 BTU", "M8", "desc8")], "size string, model_no string, model_description string")
    got = {r["id"]: (r["model_no"], r["model_description"]) for r in lookups.size_to_model(reviews, s2m).collect()}
    assert got == {1: ("M8", "desc8"), 2: ("9,000 BTU", "9,000 BTU"), 3: (None, None)}


def test_model_priority(spark):
    rows = [("u1", [("Manufacturer Part Number", "A"), ("Model", "B"), ("Model", "C")]),
            ("u2", [("Manufacturer Part Number", "A"), ("manufacturer_part_number", "D")]),
            ("u3", [("Color", "White")]), ("u4", None), ("u5", [("Model", None), ("Model", "C")])]
    pages = spark.createDataFrame(rows, "url string, pairs array<struct<feature:string,item:string>>")
    got = {r["url"]: r["m"] for r in pages.select("url", lookups.model_from_pairs(F.col("pairs"), F.col("url")).alias("m")).collect()}
    assert got == {"u1": "B", "u2": "D", "u3": "u3", "u4": "u4", "u5": None}


def test_spec_table_zip(spark):
    df = spark.createDataFrame([
        (1, [[["Model", "B"], ["Color", "W"]]]),
        (2, [[["Color"], ["Model"]], [["hdr"], ["White"], ["X1"], ["extra"]]]),
        (3, []),
        (4, [[["General"], ["Model", "B"]]]),
    ], "id int, t array<array<array<string>>>")
    out = {r["id"]: ([(p["feature"], p["item"]) for p in r["z"]] if r["z"] else None)
           for r in df.select("id", lookups.zip_spec_pairs(F.col("t")).alias("z")).collect()}
    assert out == {1: [("Model", "B"), ("Color", "W")], 2: [("Color", "White"), ("Model", "X1")], 3: None,
                   4: [("General", None), ("Model", "B")]}


def test_recency_goldens(spark):
    rows = [("t", 1, 0, dt.date(2021, 6, 12)), ("t", 1, 1, dt.date(2021, 6, 10)),
            ("t", 1, 2, dt.date(2021, 6, 9)), ("t", 2, 0, dt.date(2021, 6, 11))]
    df = spark.createDataFrame(rows, "target string, page_no int, pos int, date date")
    earliest = F.lit(dt.date(2021, 6, 10))
    assert recency.take_while_recent(df, earliest).count() == 2
    assert recency.take_while_recent_window(df, earliest).count() == 2
    assert recency.recency_filter(df, earliest).count() == 3
    assert recency.recency_filter(df, fields.earliest_date(0, dt.date(2021, 6, 20))).count() == 4


def test_takewhile_equals_filter_when_sorted(spark):
    rows = [("t%d" % (i % 3), i // 3, 0, dt.date(2021, 1, 1) + dt.timedelta(days=100 - i)) for i in range(60)]
    df = spark.createDataFrame(rows, "target string, page_no int, pos int, date date")
    earliest = F.lit(dt.date(2021, 2, 15))
    a = recency.take_while_recent(df, earliest)
    b = recency.recency_filter(df, earliest)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_pager_cutoff(spark):
    rows = [("t", 1, "1"), ("t", 2, "1"), ("t", 3, "2"), ("t", 4, "3"), ("t", 5, "3"), ("t", 6, "1"), ("t", 7, "2")]
    df = spark.createDataFrame(rows, "target string, seq int, page_label string")
    got = sorted((r["seq"], r["page_label"]) for r in recency.pager_cutoff(df).collect())
    assert got == [(1, "1"), (3, "2"), (4, "3")]


def test_takewhile_aggregate_equals_window_random(spark):
    import random

    rng = random.Random(7)
    rows = []
    for i in range(600):
        target = "hot" if rng.random() < 0.6 else f"t{rng.randrange(5)}"   # one target holds most rows
        rows.append((target, rng.randrange(1, 8), rng.randrange(20), dt.date(2021, 6, 1) + dt.timedelta(days=rng.randrange(30))))
    rows = list({(t, p, q): (t, p, q, d) for t, p, q, d in rows}.values())   # unique read positions
    df = spark.createDataFrame(rows, "target string, page_no int, pos int, date date")
    earliest = F.lit(dt.date(2021, 6, 8))
    a = recency.take_while_recent(df, earliest)
    b = recency.take_while_recent_window(df, earliest)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
