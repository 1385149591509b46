"""End-to-end review flows per source layout (category mode and config mode).

Each flow takes landed pages/payloads plus target metadata and returns
``(reviews, report)``: the review table (engine column names) of the runs
that did not fail, and the outcome report by run.  Labelling and writing
are separate steps (``label_reviews``, ``revlens.sinks``).

HTML pages that are certainly behind a target's stop never reach the parser
(``operators.pages``).  The others are parsed once and the typed rows written;
one aggregate per target says where reading stops (empty page, too old review,
pager) and whether the target fails (bad review that is read, missing pager);
one join applies that.  A target serves each of its runs (under a model), which
fail alone without their metadata.  Then constant columns, dedupe (Lowes), labels.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens import params, sinks
from revlens.functions import fields
from revlens.operators import extract, html_extract, label, lookups, pages, recency, sets
from revlens.session import written
from revlens.sources import config

REVIEW_COLUMNS = ["manufacturer", "model_no", "model_description", "date", "rating", "title", "body",
                  "image", "badge"]


def _earliest(days: int | None, as_of: _dt.date | None):
    return fields.earliest_date(days, as_of)


def _project(df: DataFrame) -> DataFrame:
    """The review columns, missing ones as NULL."""
    cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in REVIEW_COLUMNS]
    return df.select("target", *cols)


def _by_run(reviews: DataFrame, report: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A target read once serves every run of it, ``runs(target, model_no, ..., __lost)``: the rows of each run that has
    its metadata, and the report by ``(target, model_no)``."""
    r = report.withColumnsRenamed({"status": "__status", "n_reviews": "__n"})
    lines = runs.select("target", "model_no", "__lost").join(r, "target").select(
        "target", "model_no", F.when(F.col("__lost"), F.lit("failed")).otherwise(F.col("__status")).alias("status"),
        F.when(F.col("__lost"), F.lit(0)).otherwise(F.col("__n")).cast("bigint").alias("n_reviews"))
    return reviews.join(runs.where(~F.col("__lost")).drop("__lost"), "target"), lines


def json_flow(landed: DataFrame, layout: str, meta: DataFrame, days: int | None = params.DEFAULT_DAYS,
              as_of: _dt.date | None = None, targets: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Walmart / Lowes payload pages -> reviews.

    ``meta(target, model_no, model_description)`` gives the constants of a run (P16): a target under each of its
    models.  A run without a description fails (J2), the target's other runs do not.  Targets without any model
    fail.  Walmart's manufacturer is the first word of the description (P12), Lowes has none.  The Lowes report has one
    line a run, ``(target, model_no)``; a Walmart product is one run.
    """
    targets = (landed if targets is None else targets).select("target").distinct()
    earliest = _earliest(days, as_of)
    rows = extract.typed_reviews(landed, layout, earliest)
    reviews, report = extract.read_targets(rows, extract.target_cuts(extract.read_events(rows, earliest), targets))
    columns = ["target", "model_no", "model_description"]
    meta = meta.select(*columns).distinct()
    runs = targets.join(meta, "target", "left").withColumn("__lost", F.col("model_description").isNull())
    if layout == "walmart":
        runs = runs.withColumn("manufacturer", fields.manufacturer(F.col("model_description")))
    out, report = _by_run(reviews, report, runs)
    return _project(out), report if layout == "lowes" else report.drop("model_no")


def _pager_events(pages: DataFrame, label_col: str, wrap_label: str | None, on_error: str) -> tuple[DataFrame, DataFrame]:
    """(events, skipped pages) of F4 over narrow ``(target, page_no, label)`` rows, written once.  A page without a
    label fails its target, or with ``keep_prefix`` ends it."""
    flagged = recency.pager_flags(pages, "target", "page_no", label_col, wrap_label)
    missing = F.col(label_col).isNull()
    flagged = written(flagged.filter(F.col("__ends") | F.col("__repeat") | missing), "pager")
    keep = F.lit(on_error == "keep_prefix")
    events = flagged.filter(F.col("__ends") | missing).select(
        "target", F.col("page_no").cast("long").alias("page_no"), F.lit(-1).cast("long").alias("pos"),
        (F.col("__ends") | (missing & keep)).alias("stop"), (missing & ~keep).alias("bad"))
    return events, flagged.filter("__repeat").select("target", "page_no").distinct()


def amazon_flow(landed: DataFrame, size2model: DataFrame, targets: DataFrame,
                days: int | None = params.DEFAULT_DAYS, as_of: _dt.date | None = None,
                model2desc: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Amazon pages -> reviews: size lookup (J1) unless the run names an explicit model (J3), whose missing
    description fails the run (J2).  A page whose address is that of the page before ends its target (F4).

    ``targets(target, model_no)`` are the runs: NULL model_no means "use the size lookup".  Every run has a report
    line, also one whose target has no landed page.
    """
    earliest = _earliest(days, as_of)
    marks = None
    if "url" in landed.columns:
        marks, _ = _pager_events(landed.select("target", "page_no", "url").filter("url IS NOT NULL"), "url", None, "")
    rows = written(html_extract.amazon_page_reviews(pages.pages_to_parse(landed, "amazon", earliest, marks)), "typed-reviews")
    events = extract.read_events(rows, earliest)
    if marks is not None:
        events = events.unionByName(marks)
    runs = targets.select("target", "model_no").distinct()
    if model2desc is None:
        runs = runs.withColumn("model_description", F.lit(None).cast("string"))
    else:
        runs = lookups.strict_description(runs, model2desc, failed_col="__none").drop("__none")
    runs = runs.withColumn("__lost", F.col("model_no").isNotNull() & F.col("model_description").isNull())
    reviews, report = extract.read_targets(rows, extract.target_cuts(events, targets))
    named = runs.withColumnsRenamed({"model_no": "__run_model", "model_description": "__run_text"})
    _, report = _by_run(reviews, report, runs)
    out = lookups.size_to_model(reviews.join(named.where(~F.col("__lost")).drop("__lost"), "target"), size2model, "size")
    explicit = F.col("__run_model").isNotNull()
    out = out.withColumns({"model_no": F.when(explicit, F.col("__run_model")).otherwise(F.col("model_no")),
                           "model_description": F.when(explicit, F.col("__run_text")).otherwise(F.col("model_description"))})
    return _project(out), report


def homedepot_flow(landed: DataFrame, product_pages: DataFrame, days: int | None = params.DEFAULT_DAYS,
                   as_of: _dt.date | None = None, targets: DataFrame | None = None,
                   on_error: str = "drop_target") -> tuple[DataFrame, DataFrame]:
    """Home Depot pages -> reviews with metadata from the product page (E5); a target without a product page,
    description or model number fails (3.4).

    With a ``page_label`` column (``pages.pager_label`` reads it off the pages) the pager rule (F4) holds: a page observed again is skipped, coming back to
    page 1 ends the target, and a page without a label fails it (``on_error="keep_prefix"``: ends it).  The first
    page's own label is not looked at: it is page 1, with or without a pager.
    """
    if on_error not in ("drop_target", "keep_prefix"):
        raise ValueError(f"invalid on_error: {on_error}")
    targets = (landed if targets is None else targets).select("target").distinct()
    earliest = _earliest(days, as_of)
    meta = written(html_extract.homedepot_product_meta(product_pages).select(
        "target", "model_description", "model_no", "manufacturer"), "product-meta")
    marks = skipped = ends = None
    if "page_label" in landed.columns:
        label_ = F.when(F.col("page_no") == 1, F.lit("1")).otherwise(F.col("page_label")).alias("page_label")
        marks, skipped = _pager_events(landed.select("target", "page_no", label_), "page_label", "1", on_error)
        ends = marks.where("stop")
    landed = pages.pages_to_parse(landed, "homedepot", earliest, ends, skipped)
    rows = written(html_extract.homedepot_page_reviews(landed), "typed-reviews")
    events = extract.read_events(rows, earliest)
    if marks is not None:
        events = events.unionByName(marks)
    reviews, report = extract.read_targets(rows, extract.target_cuts(events, targets))
    runs = targets.join(meta.distinct(), "target", "left").withColumn(
        "__lost", F.col("model_description").isNull() | F.col("model_no").isNull())
    out, report = _by_run(reviews, report, runs)
    return _project(out), report.drop("model_no")


def walmart_meta(product_pages: DataFrame) -> DataFrame:
    """``(target, model_no, model_description)`` from the product page: the first h1 and the spec
    tables, in one parse and without a shuffle."""
    return html_extract.page_models(product_pages).select("target", "model_no",
                                                          F.col("headline").alias("model_description"))


def dedupe_reviews(reviews: DataFrame) -> DataFrame:
    """U2 (Lowes): full-row dedupe over the review columns, before labels."""
    return sets.dedupe_rows(reviews.select(*REVIEW_COLUMNS))


def label_reviews(reviews: DataFrame, tags: Sequence[str] = params.DEFAULT_TAGS, **kwargs) -> DataFrame:
    """X19 with one-hot columns, as all four original entry points do."""
    return label.predict_labels(reviews, tags, one_hot=True, **kwargs)


def train_models(training: DataFrame, tags: Sequence[str] = params.TRAIN_TAGS, model_path: str | None = None,
                 stem: bool = True):
    """Fit the vectorizer and one classifier per tag on a training table
    ``(title, body, category)`` and, with ``model_path``, save them (K3, K4)."""
    from revlens.operators.nb import fit

    model = fit(training, tags, stem=stem)
    if model_path:
        model.save(training.sparkSession, model_path)
    return model


def discovered_targets(layout: str, listing: DataFrame, category: str) -> DataFrame:
    """The targets of one category's landed listing pages.  An unknown category is an error."""
    config.resolve_category(layout, category)
    pages = listing.filter(F.col("category") == category)
    if layout == "homedepot":
        return html_extract.homedepot_listing_targets(pages).select(F.col("review_url").alias("target")).distinct()
    return html_extract.walmart_listing_targets(pages, category).select(
        F.col("product_id").alias("target")).distinct()


class Run(NamedTuple):
    """What one run of a source gives.  ``totals`` (K6) is measured while the report is written, with
    ``rows_written`` measured while the review table is; None without an output."""

    reviews: DataFrame
    report: DataFrame
    path: str | None = None
    totals: dict | None = None


def collect_reviews(layout: str, landed: DataFrame, *, meta: DataFrame | None = None,
                    product_pages: DataFrame | None = None, size2model: DataFrame | None = None,
                    targets: DataFrame | None = None, model2desc: DataFrame | None = None,
                    listing: DataFrame | None = None, mode: str = "category", category: str | None = None,
                    target: str | None = None, config_path: str | None = None,
                    days: int | None = params.DEFAULT_DAYS, as_of: _dt.date | None = None,
                    on_error: str = "drop_target", predict: bool | None = None,
                    tags: Sequence[str] = params.DEFAULT_TAGS, training: DataFrame | None = None,
                    model_path: str | None = None, output: str | None = None, fmt: str = "parquet",
                    newest_first: bool = False) -> Run:
    """One run of a source.

    * ``mode="product"`` keeps only ``target``; ``mode="category"`` with ``listing`` pages keeps the products
      that ``category``'s pages list.
    * ``config_path`` (Amazon, Lowes) reads the targets and lookups from a config file; Amazon takes the
      ``category`` of it (an unknown one fails when the plan runs).  Landed targets are the product URLs (Amazon) or
      the product ids (Lowes).  Every configured target is in the report, landed or not.
    * ``days`` 0/None means no limit; ``on_error`` as in ``homedepot_flow``.
    * ``predict`` adds the tag columns and category; by default on for Amazon and Lowes, off for the others.
    * ``output`` writes the table to the first free versioned path, and the report beside it under
      ``<path>_report``; ``newest_first`` orders the table's files by date.
    """
    if layout not in ("walmart", "lowes", "amazon", "homedepot"):
        raise ValueError(f"unknown layout: {layout}")
    if mode not in ("category", "product"):
        raise ValueError(f"invalid mode: {mode}")
    spark = landed.sparkSession
    known = None
    if config_path is not None:
        if layout == "amazon":
            cfg = config.amazon_config(spark, config_path)
            targets = written(config.check_config_category(cfg["targets"], category).select(
                F.col("url").alias("target"), "model_no"), "targets")
            size2model, model2desc = cfg["size2model"], cfg["model2desc"]
        elif layout == "lowes":
            cfg = config.lowes_config(spark, config_path)
            targets = cfg["targets"].select(F.col("product_id").alias("target"), "model_no")
            meta = lookups.strict_description(targets, cfg["model2desc"], failed_col="__lost").drop("__lost")
        else:
            raise ValueError(f"{layout} has no config file")
        known = targets.select("target").distinct()
    if mode == "product":
        if not target:
            raise ValueError("product mode needs a target")
        known = spark.range(1).select(F.lit(target).alias("target"))
        targets = None if targets is None else targets.filter(F.col("target") == target)
    elif listing is not None:
        if layout not in ("homedepot", "walmart"):
            raise ValueError(f"{layout} has no listing pages")
        known = written(discovered_targets(layout, listing, category), "targets")
    if known is not None:
        landed = landed.join(known, "target", "left_semi")
    if layout in ("walmart", "lowes"):
        if layout == "walmart" and meta is None:
            meta = written(walmart_meta(product_pages), "product-meta")
        reviews, report = json_flow(landed, layout, meta, days, as_of, known)
    else:
        # the pager, the dates and the parser each look at the pages: the files behind them are opened once
        landed = written(landed, "landed-pages")
        if layout == "amazon":
            reviews, report = amazon_flow(landed, size2model, targets, days, as_of, model2desc)
        else:
            reviews, report = homedepot_flow(landed, product_pages, days, as_of, known, on_error)
    reviews = dedupe_reviews(reviews) if layout == "lowes" else reviews.drop("target")
    if predict or (predict is None and layout in ("amazon", "lowes")):
        reviews = label_reviews(reviews, tags, training=training, model_path=model_path)
    if not output:
        return Run(reviews, report)
    path, rows = sinks.write_measured(reviews, output, {"rows_written": F.count(F.lit(1))}, fmt, newest_first)
    _, totals = sinks.write_measured(report, f"{path}_report", sinks.total_measures())
    return Run(reviews, report, path, totals | rows)
