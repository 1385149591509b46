"""Scalar field functions (Column -> Column), all built-in JVM expressions.

Regular expressions carry ``(?dU)`` so Java's engine treats line ends and
Unicode classes the way Python's ``re`` does on str.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from revlens import params

_RX = "(?dU)"


def trailing_date_token(text: Column) -> Column:
    """P1: 'Reviewed in X on January 5, 2021' -> 'January 5, 2021' ('' if absent)."""
    return F.regexp_extract(text, _RX + r"\S+\s+\d+,\s+\d+$", 0)


def iso_date_prefix(ts: Column) -> Column:
    """First 10 characters of an ISO timestamp."""
    return F.substring(ts, 1, 10)


def parse_date(text: Column, layout: str) -> Column:
    """Layout-specific date parse; NULL (not an error) on junk."""
    return F.try_to_date(text, params.DATE_FORMATS[layout])


def rating_from_text(text: Column) -> Column:
    """P4: '4.0 out of 5 stars' -> 4 (first character as an integer); NULL on other
    text, which the caller treats as a failure."""
    return F.substring(text, 1, 1).try_cast("int")


def rating_from_width(style: Column) -> Column:
    """P5: 'width: 92.5%' -> 92 div 20 = 4 (first integer, floor-divided by 20)."""
    first_int = F.regexp_extract(style, _RX + r"\d+", 0).try_cast("int")
    return F.floor(first_int / F.lit(20)).cast("int")


def strip_size_label(text: Column) -> Column:
    """Remove every 'Size: ' from the string."""
    return F.replace(text, F.lit(params.SIZE_LABEL), F.lit(""))


def join_photo_urls(photos: Column) -> Column:
    """Newline-joined ``Sizes.normal.Url`` of each photo; an empty list gives ''."""
    return F.array_join(F.transform(photos, lambda p: p["Sizes"]["normal"]["Url"]), "\n")


def photos_bad(photos: Column) -> Column:
    """No list of photos, or a photo without its URL, is a failure."""
    return photos.isNull() | F.exists(photos, lambda p: p["Sizes"]["normal"]["Url"].isNull())


def css_url(style: Column) -> Column:
    """The URL inside ``url("...")`` of a style attribute."""
    return F.regexp_extract(style, _RX + r'url\("?(\S+?)"?\)', 1)


def normalise_heading(text: Column) -> Column:
    """Newline -> space, drop the literal '<!-- -->'."""
    return F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("<!-- -->"), F.lit(""))


def description_from_heading(text: Column) -> Column:
    """P10: 'Customer Reviews for X' -> X."""
    return F.regexp_extract(text, _RX + r"Customer\s+Reviews\s+for\s+(.+)", 1)


def model_from_heading(text: Column) -> Column:
    """P11: 'Model #X1' -> X1."""
    return F.regexp_extract(text, _RX + r"Model\s+#(.+)$", 1)


def manufacturer(description: Column) -> Column:
    """First whitespace-separated token of the description."""
    return F.regexp_extract(description, _RX + r"^\s*(\S+)", 1)


def last_path_segment(url: Column) -> Column:
    """P13: 'https://x/pd/ac/1001' -> '1001'."""
    return F.element_at(F.split(url, "/"), -1)


def review_url_from_href(href: Column, prefix: str = params.HOMEDEPOT_REVIEW_PREFIX) -> Column:
    """Prefix + href without its first two characters."""
    return F.concat(F.lit(prefix), F.substring(href, 3, 1 << 30))


def lowes_request_url(product_id: Column, page_no: Column) -> Column:
    """Search URL of a landed Lowes page (offset = 10 per page)."""
    offset = ((page_no - 1) * params.LOWES_PAGE_SIZE).cast("string")
    return F.concat(F.format_string(params.LOWES_SEARCH_URL.replace("{}", "%s"), product_id), offset)


def normalise_category(cat: Column) -> Column:
    """Strip + lower; NULL -> ''."""
    return F.coalesce(F.lower(F.regexp_replace(cat, _RX + r"^\s+|\s+$", "")), F.lit(""))


def split_tags(cat: Column) -> Column:
    """Split a multi-label string on whitespace-slash-whitespace."""
    return F.split(cat, _RX + r"\s+/\s+")


def earliest_date(days: int | None, as_of: _dt.date | Column | None = None) -> Column | None:
    """as_of minus ``days``; 0 or None means no limit (returns None)."""
    if not days:
        return None
    base = F.current_date() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of))
    return F.date_sub(base, int(days))
