"""Declared schemas: landed inputs, JSON payloads, review table, model tables."""

from __future__ import annotations

from pyspark.sql import types as T

LANDED_HTML = "source string, target string, page_no int, url string, html string"
LANDED_LISTING = "source string, category string, page_no int, html string"
LANDED_JSON = "source string, target string, page_no int, payload string"

# Payloads are parsed to VARIANT; these are the types and keys taken out of a review object.
PHOTOS = "array<struct<Sizes:struct<normal:struct<Url:string>>>>"
WALMART_REQUIRED = ["reviewSubmissionTime", "rating", "photos"]
LOWES_REQUIRED = ["SubmissionTime", "Rating", "Title", "ReviewText", "Photos"]

REVIEW = T.StructType([
    T.StructField("manufacturer", T.StringType()),
    T.StructField("model_no", T.StringType()),
    T.StructField("model_description", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("rating", T.DoubleType()),   # payload ratings may have fractions
    T.StructField("title", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("image", T.StringType()),
    T.StructField("badge", T.StringType()),
])

TRAINING = "Title string, Body string, Category string"

# Spreadsheet column names of the review table (sink only).
SHEET_NAMES = {
    "manufacturer": "Manufacturer",
    "model_no": "Model No.",
    "model_description": "Model Description",
    "date": "Date",
    "rating": "Rating",
    "title": "Title",
    "body": "Body",
    "image": "Image",
    "badge": "Badge",
    "category": "Category",
}
