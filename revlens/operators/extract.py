"""Reviews out of landed JSON payloads (E3, E4) and the per-target read rules.

A landed page is one row ``(source, target, page_no, payload)``.  Every payload
is parsed once, to a VARIANT; the review list, the reviews and their fields are
paths into it, so a missing key (a failure) differs from a JSON null (a value).
The original read loop becomes set logic:

* reading stops at a target's first page without reviews (F3: an empty list, a
  JSON null or another false value) and, with a day limit, at its first review
  older than the limit (F2) - one take-while cut;
* a target is atomic: one bad review inside the part that is read (missing
  required key, unparseable date, missing product entry) drops all of that
  target's rows, and the target is reported as failed (3.4).

A page's reviews behind its own first too old one are cut off inside the row,
before they are typed, exploded or written; so of the pages behind a target's
stop, which are newest first, one marker row each is left.  The typed rows are
written, and one aggregate per target gives where reading stops and whether the
target fails.  One join applies it.  No step groups a whole target into one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens import schemas
from revlens.functions import fields
from revlens.session import written

REVIEW_COLUMNS = ["date", "rating", "title", "body", "image"]


def _get(value: Column, path: str, as_type: str = "variant") -> Column:
    """The value at a path; NULL if it is missing or of another type.  A JSON null is a (variant) value."""
    return F.try_variant_get(value, path, as_type)


def _missing_any(review: Column, required: Sequence[str]) -> Column:
    gone = [_get(review, f"$.{k}").isNull() for k in required]
    out = gone[0]
    for g in gone[1:]:
        out = out | g
    return out


def _walmart_list(landed: DataFrame) -> DataFrame:
    """``__list``: the target's ``customerReviews`` (NULL: no such entry)."""
    by_product = _get(F.try_parse_json("payload"), "$.payload.reviews", "map<string,variant>")
    return landed.withColumn("__list", _get(F.try_element_at(by_product, F.col("target")), "$.customerReviews"))


def _lowes_list(landed: DataFrame) -> DataFrame:
    return landed.withColumn("__list", _get(F.try_parse_json("payload"), "$.Results"))


def _walmart_date(review: Column) -> Column:
    return fields.parse_date(_get(review, "$.reviewSubmissionTime", "string"), "walmart")


def _lowes_date(review: Column) -> Column:
    return fields.parse_date(fields.iso_date_prefix(_get(review, "$.SubmissionTime", "string")), "lowes")


def _typed(review: Column, date: Column, required: Sequence[str], rating: str, title: str, body: str, photos: str) -> Column:
    """The typed fields of one review object and whether it is bad."""
    images = _get(review, f"$.{photos}", schemas.PHOTOS)
    bad = _missing_any(review, required) | date.isNull() | fields.photos_bad(images)
    return F.struct(date.alias("date"), _get(review, f"$.{rating}", "double").alias("rating"),
                    _get(review, f"$.{title}", "string").alias("title"), _get(review, f"$.{body}", "string").alias("body"),
                    fields.join_photo_urls(images).alias("image"), bad.alias("bad"))


def _walmart_review(review: Column) -> Column:
    return _typed(review, _walmart_date(review), schemas.WALMART_REQUIRED, "rating", "reviewTitle", "reviewText", "photos")


def _lowes_review(review: Column) -> Column:
    return _typed(review, _lowes_date(review), schemas.LOWES_REQUIRED, "Rating", "Title", "ReviewText", "Photos")


_LAYOUTS: dict[str, tuple[Callable, Callable, Callable]] = {
    "walmart": (_walmart_list, _walmart_date, _walmart_review),
    "lowes": (_lowes_list, _lowes_date, _lowes_review),
}


def _is_false(value: Column, items: Column) -> Column:
    """What ends reading like an empty list: null, {}, "", 0, false (but not a string that looks so)."""
    nothing = [F.is_variant_null(value), F.size(_get(value, "$", "map<string,variant>")) == 0, _get(value, "$", "string") == "",
               (F.schema_of_variant(value) != "STRING") & (_get(value, "$", "double") == 0.0)]
    other = F.array_contains(F.array(*(F.coalesce(t, F.lit(False)) for t in nothing)), True)
    return F.when(items.isNotNull(), F.size(items) == 0).otherwise(other)       # a list is never turned into text


def page_reviews(landed: DataFrame, layout: str, earliest: Column | None = None) -> DataFrame:
    """One typed row per review object, ``(..., pos, empty_page, date, rating, title, body, image, bad)``, with
    every landed column but ``payload``.  A page without reviews keeps one row at ``pos`` -1, which is ``bad`` unless the
    list is there and empty.  With ``earliest`` a page's rows end at its first too old review (which is kept)."""
    listed, date_of, typed = _LAYOUTS[layout]
    keep = [c for c in landed.columns if c != "payload"]
    p = listed(landed).withColumn("__items", _get(F.col("__list"), "$", "array<variant>"))
    empty = F.coalesce(_is_false(F.col("__list"), F.col("__items")), F.lit(False))
    p = p.select(*keep, "__items", empty.alias("empty_page"))
    if earliest is not None:
        old = F.array_position(F.transform("__items", lambda r: F.coalesce(date_of(r) < earliest, F.lit(False))), True)
        first = F.slice("__items", F.lit(1), old.cast("int"))
        p = p.withColumn("__items", F.when(old > 0, first).otherwise(F.col("__items")))
    e = p.select(*keep, "empty_page", F.posexplode_outer(F.transform("__items", typed)).alias("pos", "r"))
    return e.select(*keep, "empty_page", F.coalesce("pos", F.lit(-1)).alias("pos"), *[f"r.{c}" for c in REVIEW_COLUMNS],
                    F.coalesce("r.bad", ~F.col("empty_page")).alias("bad"))


def extract_reviews(landed: DataFrame, layout: str, earliest: Column | None = None) -> DataFrame:
    """Landed JSON pages -> typed reviews of the targets that did not fail."""
    typed = typed_reviews(landed, layout, earliest)
    return read_targets(typed, target_cuts(read_events(typed, earliest), typed))[0]


def typed_reviews(landed: DataFrame, layout: str, earliest: Column | None = None) -> DataFrame:
    """Landed JSON pages -> typed rows, written once (parsed once)."""
    return written(page_reviews(landed, layout, earliest), "typed-reviews")


def read_events(rows: DataFrame, earliest: Column | None, key: str = "target") -> DataFrame:
    """Narrow ``(key, page_no, pos, stop, bad)`` of typed rows: what ends reading, what fails a target."""
    stop = F.coalesce(F.col("empty_page"), F.lit(False)) if "empty_page" in rows.columns else F.lit(False)
    if earliest is not None:
        stop = stop | F.coalesce(F.col("date") < earliest, F.lit(False))
    return rows.select(key, F.col("page_no").cast("long").alias("page_no"), F.col("pos").cast("long").alias("pos"),
                       stop.alias("stop"), F.col("bad"))


def target_cuts(events: DataFrame, targets: DataFrame, failed: DataFrame | None = None, key: str = "target") -> DataFrame:
    """One row per target: ``__stop``, the place from which on nothing is read, and ``__failed``: something bad
    before that place, or the target is among ``failed`` (no metadata).  One grouped aggregate."""
    at = F.struct("page_no", "pos")
    cuts = events.groupBy(key).agg(F.min(F.when(F.col("stop"), at)).alias("__stop"),
                                   F.min(F.when(F.col("bad"), at)).alias("__bad"))
    t = targets.select(key).distinct().join(cuts, key, "left")
    lost = F.lit(False)
    if failed is not None:
        t = t.join(failed.select(key, F.lit(True).alias("__lost")).distinct(), key, "left")
        lost = F.coalesce("__lost", F.lit(False))
    bad = F.col("__bad").isNotNull() & (F.col("__stop").isNull() | (F.col("__bad") < F.col("__stop")))
    return t.select(key, "__stop", (lost | bad).alias("__failed"))


def read_targets(rows: DataFrame, cuts: DataFrame, key: str = "target") -> tuple[DataFrame, DataFrame]:
    """(reviews, report): one join of the typed rows with the per-target cuts applies where reading stops and
    which targets fail; the report counts what is left (K5, A1)."""
    at = F.struct(F.col("page_no").cast("long").alias("page_no"), F.col("pos").cast("long").alias("pos"))
    read = rows.join(cuts, key).filter(~F.col("__failed") & (F.col("__stop").isNull() | (at < F.col("__stop"))))
    if "empty_page" in rows.columns:
        read = read.filter(~F.col("empty_page"))
    read = read.drop("__stop", "__failed")
    counts = read.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    n = F.coalesce("__n", F.lit(0)).cast("bigint")
    status = (F.when(F.col("__failed"), F.lit("failed")).when(n > 0, F.lit("success"))
              .otherwise(F.lit("no new reviews")))
    report = cuts.join(counts, key, "left").select(key, status.alias("status"), n.alias("n_reviews"))
    return read, report
