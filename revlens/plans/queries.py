"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the supplied tables (or data Spark derives from them) in
full, so its work grows with the tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens import params, sinks
from revlens.functions import fields, text
from revlens.functions.stem import stem_word
from revlens.operators import extract, html_extract, label, lookups, nb, recency, rules, sets, tfidf
from revlens.operators import pages as pages_op
from revlens.plans import reviews as flows
from revlens.session import ensure_checkpoint_dir, written
from revlens.sources import config, landed, testbed
from revlens.sources.tables import table
from revlens.streaming import read_stream


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.reviews(table(spark, sf_dir, "documents"))


def review_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constant per-target columns and the review projection."""
    r = _reviews(spark, sf_dir)
    desc = F.concat(F.lit("ACME "), F.upper("target"), F.lit(" 8,000 BTU"))
    r = r.withColumns({
        "model_description": desc,
        "model_no": F.concat(F.lit("M-"), F.upper("target")),
    }).withColumn("manufacturer", fields.manufacturer(F.col("model_description")))
    return r.select("doc_id", "target", "manufacturer", "model_no", "model_description",
                    "date", "rating", "title", "body", "image", "badge")


def rule_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule labels and the category string."""
    tags = [t for t, _ in testbed.TEST_RULES]
    r = _reviews(spark, sf_dir)
    out = rules.rule_labels(r, testbed.TEST_RULES).transform(lambda d: rules.with_category(d, tags))
    return out.select("doc_id", "target", "rating", *tags, "category")


RECENCY_DAYS = 6      # with as_of 2024-01-30 the limit day is 2024-01-24


def _earliest():
    return fields.earliest_date(RECENCY_DAYS, testbed.AS_OF)


def recency_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inclusive recency filter."""
    r = _reviews(spark, sf_dir)
    return recency.recency_filter(r, _earliest()).select("doc_id", "target", "page_no", "date")


def recency_takewhile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the first too-old review (in page order) ends its target."""
    r = _reviews(spark, sf_dir)
    return recency.take_while_recent(r, _earliest()).select("doc_id", "target", "page_no", "date")


def recency_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cut-off as a running flag over the ordered reviews of a target (the form for small targets)."""
    r = _reviews(spark, sf_dir)
    return recency.take_while_recent_window(r, _earliest()).select("doc_id", "target", "page_no", "date")


def multi_source_union_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three frames with different column orders (one lacking a
    column) unioned by name, then a full-row dedupe."""
    r = _reviews(spark, sf_dir)
    cols = ["target", "date", "rating", "title", "body", "image", "badge"]
    a = r.filter(F.col("doc_id") % 3 != 0).select(*cols)
    b = r.filter(F.col("doc_id") % 3 != 1).select(*reversed(cols))
    c = r.filter(F.col("doc_id") % 3 == 2).select(*cols[:-1])
    return sets.dedupe_rows(sets.union_by_name([a, b, c]))


def _size2model(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    g = part.groupBy("p_size").agg(F.min("p_partkey").alias("k"),
                                   F.min_by("p_name", "p_partkey").alias("model_description"))
    return g.select(F.concat(F.col("p_size").cast("string"), F.lit(" BTU")).alias("size"),
                    F.concat(F.lit("BR"), F.col("p_size").cast("string"), F.lit("-"),
                             F.col("k").cast("string")).alias("model_no"),
                    "model_description")


def size_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6/J1/J3: 'Size: X' -> (model, description) with fallback; targets with
    an explicit model override the size lookup on every row."""
    r = _reviews(spark, sf_dir)
    r = r.select("doc_id", "target",
                 fields.strip_size_label(F.concat(F.lit("Size: "), F.col("size"))).alias("size"))
    out = lookups.size_to_model(r, _size2model(spark, sf_dir), "size")
    explicit = (r.select("target").distinct()
                .filter(F.ascii(F.expr("right(target, 1)")) % 2 == 0)
                .select("target", F.concat(F.lit("M-"), F.upper("target")).alias("model_no"),
                        F.concat(F.lit("ACME "), F.upper("target")).alias("model_description")))
    out = lookups.override_model(out, explicit)
    return out.select("doc_id", "target", "size", "model_no", "model_description")


def strict_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product id from the URL; model -> description is strict, so a
    target whose model has no description yields nothing."""
    r = _reviews(spark, sf_dir)
    url = F.concat(F.lit("https://www.lowes.com/pd/ac-"), F.col("target"), F.lit("/"),
                   (F.ascii(F.expr("right(target, 1)")) + 1000).cast("string"))
    models = F.array(*[F.lit(m) for m in testbed.MODELS])
    model = F.element_at(models, (F.ascii(F.expr("right(target, 1)")) % len(testbed.MODELS) + 1).cast("int"))
    r = r.select("doc_id", "target", fields.last_path_segment(url).alias("product_id"), model.alias("model_no"))
    out = lookups.strict_description(r, testbed.model_descriptions(table(spark, sf_dir, "part")))
    return out.select("doc_id", "target", "product_id", "model_no", "model_description")


# ---------------------------------------------------------------------------
# Landed JSON payloads
# ---------------------------------------------------------------------------
def walmart_json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4/E3/P3/P7/F3/3.4: Walmart payload pages -> reviews; reading stops at
    the first empty page; a target with a bad review is dropped whole."""
    out = extract.extract_reviews(testbed.landed_walmart(_reviews(spark, sf_dir)), "walmart")
    return out.select("target", "page_no", *extract.REVIEW_COLUMNS)


def lowes_json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5/E4/P2/P3/P7/F2/F3/3.4: Lowes payload pages with a day limit."""
    out = extract.extract_reviews(testbed.landed_lowes(_reviews(spark, sf_dir)), "lowes", _earliest())
    return out.select("target", "page_no", *extract.REVIEW_COLUMNS)


def failed_targets_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5/K6/A1/3.4: per-target outcome of the Lowes read with a day limit."""
    rows = extract.typed_reviews(testbed.landed_lowes(_reviews(spark, sf_dir)), "lowes", _earliest())
    return extract.read_targets(rows, extract.target_cuts(extract.read_events(rows, _earliest()), rows))[1]


def target_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6/A1: totals of the per-target outcome report in one row."""
    return sinks.totals(failed_targets_report(spark, sf_dir))


def lowes_request_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search request URL behind every landed Lowes page (offset
    10 per page), from the product URL's last path segment."""
    pages = testbed.landed_lowes(_reviews(spark, sf_dir))
    product_url = F.concat(F.lit("https://www.lowes.com/pd/ac-"), F.col("target"), F.lit("/"),
                           (F.ascii(F.expr("right(target, 1)")) + 1000).cast("string"))
    pid = fields.last_path_segment(product_url)
    return pages.select("target", "page_no", fields.lowes_request_url(pid, F.col("page_no")).alias("request_url"))


def page_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """re-observed pages skipped, reading ends when the pager wraps to 1."""
    seq = testbed.pager_sequence(_reviews(spark, sf_dir))
    return recency.pager_cutoff(seq).select("target", "page_label", "seq")


def stateful_read_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2/F3 over a stream: Lowes pages that land in two batches, the later pages first, read with state per target."""
    r = _reviews(spark, sf_dir)
    for m, k in testbed.LOWES_FAIL:
        r = r.filter(F.col("doc_id") % m != k)       # rows that are out can't be dropped with a failing target
    pages, folder = testbed.landed_lowes(r), _folder(spark, "stream")
    for batch in ("page_no > 1", "page_no = 1"):     # a run for each; the checkpoint keeps the state between them
        pages.filter(batch).write.mode("append").parquet(f"{folder}/pages")
        stream = spark.readStream.schema(pages.schema).parquet(f"{folder}/pages")
        query = (read_stream.reviews_as_they_land(stream, "lowes", _earliest()).writeStream.format("parquet").outputMode("append")
                 .option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/reviews")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    return spark.read.schema(read_stream.OUT).parquet(f"{folder}/reviews").drop("pos")


# ---------------------------------------------------------------------------
# Landed HTML pages
# ---------------------------------------------------------------------------
def amazon_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amazon-layout review pages -> typed reviews."""
    rows = written(html_extract.amazon_page_reviews(testbed.landed_amazon(_reviews(spark, sf_dir))), "typed-reviews")
    return _unfailed(rows).select("target", "page_no", "date", "size", "rating", "title", "body", "image", "badge")


def _unfailed(rows: DataFrame) -> DataFrame:
    return extract.read_targets(rows, extract.target_cuts(extract.read_events(rows, None), rows))[0]


def homedepot_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2/E2/E10/P3/P5/P7/P8/3.4: Home Depot-layout review pages; a review
    without its required stars style fails its whole target."""
    rows = written(html_extract.homedepot_page_reviews(testbed.landed_homedepot(_reviews(spark, sf_dir))), "typed-reviews")
    return _unfailed(rows).select("target", "page_no", "date", "rating", "title", "body", "image")


def product_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Description, model number and manufacturer from product pages."""
    pages = testbed.product_pages(table(spark, sf_dir, "part"))
    return html_extract.homedepot_product_meta(pages).select("target", "model_description", "model_no",
                                                             "manufacturer")


def spec_model_no(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model number from spec tables by priority, else the URL."""
    pages = testbed.spec_pages(table(spark, sf_dir, "part"))
    return html_extract.page_models(pages).select("target", "url", "model_no")


def target_discovery_hd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review-page URLs from Home Depot-layout listings."""
    listing = testbed.homedepot_listing(table(spark, sf_dir, "part"))
    return html_extract.homedepot_listing_targets(listing)


DISCOVERY_KEYWORD = "Red"   # matched case-insensitively


def target_discovery_kw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product ids and URLs from Walmart-layout listings whose
    description contains the keyword."""
    listing = testbed.walmart_listing(table(spark, sf_dir, "part"))
    return html_extract.walmart_listing_targets(listing, DISCOVERY_KEYWORD)


def page_headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First h1 of every supplied web page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return html_extract.page_headline(pages).select("page_id", "headline")


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E8-style link extraction: every anchor href of every supplied page."""
    return html_extract.page_links(table(spark, sf_dir, "pages"))


# ---------------------------------------------------------------------------
# End-to-end flows: reviews and per-target report of each layout
# ---------------------------------------------------------------------------
def _lowes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    r = _reviews(spark, sf_dir)
    pages = testbed.listed_twice(testbed.landed_lowes(r))
    models = testbed.listed_twice(testbed.target_runs(r))
    meta = lookups.strict_description(models, testbed.model_descriptions(table(spark, sf_dir, "part")), failed_col="lost")
    return flows.json_flow(pages, "lowes", meta.drop("lost"), RECENCY_DAYS, testbed.AS_OF)


def lowes_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2/U2/3.4: Lowes reviews by run; runs whose model has no description fail; equal rows of two targets are one."""
    return flows.dedupe_reviews(_lowes(spark, sf_dir)[0])


def lowes_flow_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lowes(spark, sf_dir)[1]


def _walmart(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    pages = testbed.spec_pages(table(spark, sf_dir, "part")).withColumn("target", testbed.target_of_part())
    meta = written(flows.walmart_meta(pages), "product-meta")
    return flows.json_flow(testbed.landed_walmart(_reviews(spark, sf_dir)), "walmart", meta, None)


def walmart_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3/E6/E7/A7/P12/3.4: Walmart reviews with product-page metadata; targets without a page fail."""
    return _walmart(spark, sf_dir)[0]


def walmart_flow_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _walmart(spark, sf_dir)[1]


def _amazon(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    r = _reviews(spark, sf_dir)
    named = testbed.last_code(F.col("target")) % 3 == 0
    targets = testbed.target_runs(r).withColumn("model_no", F.when(named, F.col("model_no")))
    return flows.amazon_flow(testbed.amazon_walk(r), _size2model(spark, sf_dir), targets, RECENCY_DAYS, testbed.AS_OF,
                             testbed.model_descriptions(table(spark, sf_dir, "part")))


def amazon_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1/F2/F4/J1-J3/3.4: Amazon reviews; equal ones are kept; an unchanged address ends a target."""
    return _amazon(spark, sf_dir)[0]


def amazon_flow_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _amazon(spark, sf_dir)[1]


def _homedepot(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    pages = testbed.product_pages(table(spark, sf_dir, "part")).withColumn("target", testbed.target_of_part())
    return flows.homedepot_flow(testbed.homedepot_walk(_reviews(spark, sf_dir)), pages, 20, testbed.AS_OF)


def homedepot_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2/E5/F2/F4/3.4: Home Depot reviews; pages seen again are skipped, page 1 again ends a target; targets
    without a product page or a model number fail."""
    return _homedepot(spark, sf_dir)[0]


def homedepot_flow_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _homedepot(spark, sf_dir)[1]


# ---------------------------------------------------------------------------
# Whole runs as a user calls them: config or listing, landed page files, flow, labels, output read back
# ---------------------------------------------------------------------------
RUN_TAGS = [t for t, _ in params.RULES]


def _landed_files(spark: SparkSession, pages: DataFrame, source: str, content: str = "html", key: str = "target") -> DataFrame:
    """The pages as files, one a page, read by the file source."""
    return landed.read_pages(spark, landed.land_pages(pages, _folder(spark, "landed"), content, key), source, content, key=key)


def _config_file(spark: SparkSession, text_row: DataFrame) -> str:
    path = _folder(spark, "config")
    text_row.write.text(path)
    return path


def _issue_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.issue_reviews(table(spark, sf_dir, "documents"))


def _lowes_run(spark: SparkSession, sf_dir: str) -> flows.Run:
    r = _issue_reviews(spark, sf_dir)
    pages = _landed_files(spark, testbed.landed_lowes(r), "lowes", "payload")
    cfg = _config_file(spark, testbed.lowes_config(r, table(spark, sf_dir, "part")))
    return flows.collect_reviews("lowes", pages, config_path=cfg, days=RECENCY_DAYS, as_of=testbed.AS_OF, tags=RUN_TAGS,
                                 output=_folder(spark, "Lowes_Reviews"), newest_first=True)


def lowes_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A configured Lowes run over page files, labelled; the output read back."""
    return spark.read.parquet(_lowes_run(spark, sf_dir).path)


def lowes_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: the report of the same run, which has every configured run, as it was written."""
    return spark.read.parquet(_lowes_run(spark, sf_dir).path + "_report")


def lowes_run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: the totals of the same run, measured while its output was written."""
    totals = _lowes_run(spark, sf_dir).totals
    return spark.createDataFrame([tuple(totals.values())], ", ".join(f"{k} bigint" for k in totals))


def amazon_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One category of an Amazon config over page files whose targets are addresses."""
    r, part = _issue_reviews(spark, sf_dir), table(spark, sf_dir, "part")
    named = testbed.amazon_walk(r).withColumn("target", F.concat(F.lit(testbed.AMAZON_URL), "target"))
    cfg = _config_file(spark, testbed.amazon_config(r, part, _size2model(spark, sf_dir)))
    run = flows.collect_reviews("amazon", _landed_files(spark, named, "amazon"), config_path=cfg, category="Window", days=RECENCY_DAYS,
                                as_of=testbed.AS_OF, tags=RUN_TAGS, output=_folder(spark, "Amazon_Reviews"))
    return spark.read.parquet(run.path)


def walmart_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A category found on listing page files, with product pages and labels on request."""
    part = table(spark, sf_dir, "part")
    r = _issue_reviews(spark, sf_dir).withColumn("target", testbed.source_number(F.col("target")).cast("string"))
    listing = _landed_files(spark, testbed.walmart_listing(testbed.window_parts(part)), "walmart", key="category")
    run = flows.collect_reviews("walmart", _landed_files(spark, testbed.landed_walmart(r), "walmart", "payload"), listing=listing,
                                category="Window", product_pages=testbed.spec_pages(part), days=20, as_of=testbed.AS_OF,
                                predict=True, tags=RUN_TAGS, output=_folder(spark, "Walmart_Reviews"))
    return spark.read.parquet(run.path)


def homedepot_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Home Depot category from page files that show their pager, which breaks off; what was
    read is kept; no labels by default."""
    part, r = table(spark, sf_dir, "part"), _reviews(spark, sf_dir)
    names = testbed.homedepot_targets(part)
    broken = (testbed.last_code(F.col("target")) % 3 == 1) & (F.col("page_no") == testbed.NO_LABEL)
    pages = testbed.homedepot_walk(r).withColumn("page_label", F.when(~broken, F.col("page_label")))
    pages = testbed.with_shown_pager(pages).join(names, "target").drop("target").withColumnRenamed("review_url", "target")
    pages = _landed_files(spark, pages, "homedepot").withColumn("page_label", pages_op.pager_label(F.col("html")))
    product = testbed.product_pages(part).withColumn("target", F.concat(F.lit("src"), "target")).join(names, "target")
    listing = testbed.homedepot_listing(testbed.window_parts(part).withColumn("p_name", F.regexp_replace("p_name", " window unit$", "")))
    run = flows.collect_reviews("homedepot", pages, listing=listing, category="Window", on_error="keep_prefix", days=20,
                                as_of=testbed.AS_OF, product_pages=product.select(F.col("review_url").alias("target"), "html"),
                                output=_folder(spark, "Homedepot_Reviews"))
    return spark.read.parquet(run.path)


def newest_first_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1/K1: reviews written newest first; per date its rows, and whether no file starts newer than the one before ends."""
    path = sinks.write_reviews(_reviews(spark, sf_dir).drop("photos"), _folder(spark, "Reviews"), newest_first=True, files=8)
    read = spark.read.parquet(path).select("date", F.col("_metadata.file_name").alias("file"))
    files = read.groupBy("file").agg(F.max("date").alias("newest"), F.min("date").alias("oldest"))     # one row a file
    before = F.lag("oldest").over(Window.partitionBy(F.lit(1)).orderBy("file"))
    order = files.select(F.coalesce(F.col("newest") <= before, F.lit(True)).alias("ok")).agg(F.bool_and("ok").alias("in_order"))
    return read.groupBy("date").agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit(1)).join(
        order.withColumn("k", F.lit(1)), "k").drop("k")


# ---------------------------------------------------------------------------
# Sources, sinks and saved models, written and read back
# ---------------------------------------------------------------------------
def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def training_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training table as CSV with quoted multi-line fields, read by the training source."""
    path = _folder(spark, "training")
    _training(spark, sf_dir).select(F.col("title").alias("Title"), F.col("body").alias("Body"),
                                    F.col("category").alias("Category"), F.lit("x").alias("Extra")).write.option(
        "header", True).option("escape", '"').option("quoteAll", True).csv(path)
    return config.training_csv(spark, path).groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length(F.coalesce("title", F.lit("")))).alias("title_chars"),
        F.sum(F.length(F.coalesce("body", F.lit("")))).alias("body_chars"))


def lowes_config_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Lowes config file made from the part types, read back as targets and descriptions."""
    part = table(spark, sf_dir, "part")
    types = part.groupBy("p_type").agg(F.min("p_partkey").alias("lo"), F.max("p_partkey").alias("hi"),
                                       F.min_by("p_name", "p_partkey").alias("name"))   # one row a type
    url = lambda k: F.concat(F.lit("https://www.lowes.com/pd/x/"), F.col(k).cast("string"))
    cfg = types.agg(F.map_from_entries(F.collect_list(F.struct("p_type", F.array(url("lo"), url("hi"))))).alias("urls"),
                    F.map_from_entries(F.collect_list(F.struct("p_type", "name"))).alias("model2desc"))
    path = _folder(spark, "lowes-config")
    cfg.select(F.to_json(F.struct("urls", "model2desc")).alias("value")).write.text(path)
    read = config.lowes_config(spark, path)
    return read["targets"].join(read["model2desc"], "model_no")


def amazon_config_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An Amazon config file with one category a part type, either one address or one a model."""
    part = table(spark, sf_dir, "part")
    types = part.groupBy("p_type").agg(F.min("p_partkey").alias("lo"), F.max("p_partkey").alias("hi"))
    url = lambda k: F.concat(F.lit("https://www.amazon.com/dp/"), F.col(k).cast("string"))
    many = F.to_json(F.map_from_arrays(F.array(F.lit("A"), F.lit("B")), F.array(url("lo"), url("hi"))))
    value = F.when(F.length("p_type") % 2 == 0, many).otherwise(F.concat(F.lit('"'), url("lo"), F.lit('"')))
    urls = types.agg(F.array_join(F.sort_array(F.collect_list(F.concat(F.lit('"'), "p_type", F.lit('":'), value))), ",").alias("u"))
    path = _folder(spark, "amazon-config")
    urls.select(F.concat(F.lit('{"urls":{'), "u", F.lit('},"size2model":{"5 BTU":["M5","five"]},"model2desc":{"A":"a"}}'))
                .alias("value")).write.text(path)
    return config.amazon_config(spark, path)["targets"]


def versioned_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1/K2: labelled reviews written twice under one name, the second time as CSV, both read back."""
    tags = [t for t, _ in testbed.TEST_RULES]
    out = rules.with_category(rules.rule_labels(_reviews(spark, sf_dir), testbed.TEST_RULES), tags)
    out = out.select("doc_id", "target", "date", "rating", "category")
    base = _folder(spark, "Reviews")
    first, second = sinks.write_versioned(out, base), sinks.write_versioned(out, base, fmt="csv")
    if (first, second) != (base, base + "1"):
        raise AssertionError("the second table must have the next free name")
    csv = spark.read.option("header", True).csv(second).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("Category", F.lit("")).alias("csv_category"),
        F.col("Rating").cast("int").alias("csv_rating"))
    return spark.read.parquet(first).join(csv, "doc_id")


def saved_model_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifiers trained one after the other into one folder, loaded again and applied."""
    path = _folder(spark, "model")
    for tag in testbed.TEST_ML_TAGS:
        flows.train_models(_training(spark, sf_dir), [tag], path, stem=False)
    r = _reviews(spark, sf_dir).select("doc_id", "rating", "title", "body")
    out = label.predict_labels(r, testbed.TEST_ML_TAGS, model_path=path, rules=[], stem=False)
    return out.select("doc_id", *[F.col(f"`{t}`") for t in testbed.TEST_ML_TAGS])


def issue_rule_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five issue rules on reviews with phrases that hit and narrowly miss them."""
    tags = [t for t, _ in params.RULES]
    r = testbed.issue_reviews(table(spark, sf_dir, "documents"))
    out = rules.with_category(rules.rule_labels(r, params.RULES), tags)
    return out.select("doc_id", "rating", *[F.col(f"`{t}`") for t in tags], "category")


# ---------------------------------------------------------------------------
# Text, TF-IDF and Naive Bayes chain
# ---------------------------------------------------------------------------
ML_CANDIDATES = ["license", "low quality", "contact", "decimal", "toxic", "gap", "number"]


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.training_set(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def compose_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """title/body composition."""
    r = _reviews(spark, sf_dir)
    return r.select("doc_id", text.compose_text(F.col("title"), F.col("body")).alias("text"))


def clean_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned tokens re-joined (no stemming)."""
    r = _reviews(spark, sf_dir)
    toks = text.review_tokens(F.col("title"), F.col("body"), stem=False)
    return r.select("doc_id", text.clean_text(toks).alias("clean"))


def stem_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct cleaned word of the reviews with its stem."""
    r = _reviews(spark, sf_dir)
    words = (r.select(F.explode_outer(text.review_tokens(F.col("title"), F.col("body"), stem=False)).alias("word"))
             .filter(F.col("word").isNotNull()).distinct())
    return words.select("word", stem_word(F.col("word")).alias("stem"))


def tag_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct training tags."""
    return nb.tag_vocabulary(_training(spark, sf_dir))


def tag_onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary one-hot tags of the labelled training rows."""
    t = nb.training_tags(_training(spark, sf_dir))
    return t.select("doc_id", *[F.array_contains("tags", g).cast("int").alias(g) for g in testbed.TEST_ML_TAGS])


def _labelled(spark: SparkSession, sf_dir: str, stem: bool) -> DataFrame:
    return nb.labelled_ngrams(_training(spark, sf_dir), stem=stem)


def term_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top terms of the training corpus (no stemming)."""
    return tfidf.frequent_terms(written(_labelled(spark, sf_dir, False).select("ngrams"), "ngrams"))


def _fit(spark: SparkSession, sf_dir: str, stem: bool = False):
    return nb.fit(_training(spark, sf_dir), testbed.TEST_ML_TAGS, stem=stem)


def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2-normalised tf-idf of every review (no stemming)."""
    model = _fit(spark, sf_dir)
    r = text.with_review_ngrams(_reviews(spark, sf_dir), stem=False).select("doc_id", "ngrams")
    w = tfidf.tfidf_long(r, model.vocab)
    return w.select("doc_id", "term", F.round("weight", 6).alias("weight"))


def nb_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per tag and class, log-probabilities and priors."""
    vocab, tbl = nb.fit_table(written(_labelled(spark, sf_dir, False), "labelled"), testbed.TEST_ML_TAGS)
    return tbl.select("tag", "cls", "term", F.round("log_prob", 6).alias("log_prob"),
                      F.round("log_prior", 6).alias("log_prior"))


def nb_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model labels of every review, masked by eligibility."""
    model = _fit(spark, sf_dir)
    r = _reviews(spark, sf_dir).select("doc_id", "rating", "title", "body")
    out = label.predict_labels(r, testbed.TEST_ML_TAGS, model=model, rules=[], stem=False)
    return out.select("doc_id", *[F.col(f"`{t}`") for t in testbed.TEST_ML_TAGS])


def _predict(spark: SparkSession, sf_dir: str, stem: bool) -> DataFrame:
    r = _reviews(spark, sf_dir).select("doc_id", "target", "date", "rating", "title", "body", "image")
    return label.predict_labels(r, ML_CANDIDATES, training=_training(spark, sf_dir),
                                rules=testbed.TEST_RULES, stem=stem)


def predict_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X18-X20 (flagship): rule tags and model tags routed per tag, eligibility
    masks, one-hot columns and the category string (no stemming)."""
    return _predict(spark, sf_dir, stem=False)


def predict_labels_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X19 with Porter stemming, as in the original tool's default."""
    return _predict(spark, sf_dir, stem=True)


def predict_default_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven default tags, the two model tags trained on the labels, with stemming."""
    documents = table(spark, sf_dir, "documents")
    training = testbed.training_set(documents, table(spark, sf_dir, "labels"), *params.TRAIN_TAGS, of=testbed.issue_reviews)
    r = testbed.issue_reviews(documents).select("doc_id", "rating", "title", "body")
    out = flows.label_reviews(r, training=training)
    return out.select("doc_id", *[F.col(f"`{t}`") for t in params.DEFAULT_TAGS], "category")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "review_base": review_base,
        "rule_labels": rule_labels,
        "recency_filter": recency_filter,
        "recency_takewhile": recency_takewhile,
        "recency_window": recency_window,
        "multi_source_union_dedupe": multi_source_union_dedupe,
        "size_lookup": size_lookup,
        "strict_lookup": strict_lookup,
        "walmart_json_extract": walmart_json_extract,
        "lowes_json_extract": lowes_json_extract,
        "stateful_read_stream": stateful_read_stream,
        "failed_targets_report": failed_targets_report,
        "page_cutoff": page_cutoff,
        "target_totals": target_totals,
        "lowes_request_urls": lowes_request_urls,
        "amazon_html_extract": amazon_html_extract,
        "homedepot_html_extract": homedepot_html_extract,
        "product_meta": product_meta,
        "spec_model_no": spec_model_no,
        "target_discovery_hd": target_discovery_hd,
        "target_discovery_kw": target_discovery_kw,
        "lowes_flow": lowes_flow,
        "lowes_flow_report": lowes_flow_report,
        "walmart_flow": walmart_flow,
        "walmart_flow_report": walmart_flow_report,
        "amazon_flow": amazon_flow,
        "amazon_flow_report": amazon_flow_report,
        "homedepot_flow": homedepot_flow,
        "homedepot_flow_report": homedepot_flow_report,
        "lowes_run": lowes_run,
        "lowes_run_report": lowes_run_report,
        "lowes_run_totals": lowes_run_totals,
        "amazon_run": amazon_run,
        "walmart_run": walmart_run,
        "homedepot_run": homedepot_run,
        "newest_first_sink": newest_first_sink,
        "training_csv_roundtrip": training_csv_roundtrip,
        "lowes_config_roundtrip": lowes_config_roundtrip,
        "amazon_config_roundtrip": amazon_config_roundtrip,
        "versioned_sink_roundtrip": versioned_sink_roundtrip,
        "saved_model_predict": saved_model_predict,
        "issue_rule_labels": issue_rule_labels,
        "predict_default_tags": predict_default_tags,
        "page_headline": page_headline,
        "page_links": page_links,
        "compose_text": compose_text,
        "clean_tokens": clean_tokens,
        "stem_vocab": stem_vocab,
        "tag_vocabulary": tag_vocabulary,
        "tag_onehot": tag_onehot,
        "term_stats": term_stats,
        "tfidf": tfidf_weights,
        "nb_model": nb_model,
        "nb_predict": nb_predict,
        "predict_labels": predict_labels,
        "predict_labels_stemmed": predict_labels_stemmed,
    }
