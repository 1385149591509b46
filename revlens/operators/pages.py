"""Which landed HTML pages need parsing (F2, F4), found before the parser runs.

The original tool never fetches a page behind a target's stop.  Landed pages are all there, so a narrow job finds
those that are certainly behind one, from the pager columns and from dates read off the raw text in the JVM, and a
join on ``(target, page_no)`` keeps them from the parser.  It only ever leaves out pages that the read rules would
drop: a page counts as stopping only if its text, comments and scripts aside, is a plain sequence of tags in which
a too old date stands in a review element with nothing closed in between.  Any other page is parsed, and the rules
on the parsed reviews decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens import params
from revlens.functions import fields

#: Parts without elements; each becomes one HIDDEN character, which ends any certainty around it.
_RAW = "script|style|title|textarea|iframe|noembed|noframes|xmp"
_NO_MARKUP = rf"(?is)<!--.*?-->|<({_RAW})\b[^>]*>.*?</\1\s*>"
_HIDDEN = "\u0001"
_ATTRIBUTE = r"""\s++[^\s"'<>/=]++(?:="[^"<>]*+"|='[^'<>]*+'|=[^\s"'<>=]++)?+"""
#: A whole page of text and tags whose attribute values hold no angle bracket (possessive: one pass, no stack).
_PLAIN_PAGE = rf"""(?s)\A(?:[^<>]++|</[A-Za-z][\w-]*+\s*+>|<!?(?!(?i:{_RAW}|plaintext)\b)[A-Za-z][\w-]*+(?:{_ATTRIBUTE})*+\s*+/?+>)*+\z"""


def _open_tag(spec: tuple[str, str, str]) -> str:
    """Pattern of a start tag with one attribute equal to (``class``: holding) a value."""
    tag, attr, value = spec
    other = rf"""(?:\s+(?!{attr}\b)[^\s"'<>/=]+(?:="[^"<>]*"|='[^'<>]*'|=[^\s"'<>=]+)?)*"""
    quoted = rf'(?:[^"<>]*\s)?{value}(?:\s[^"<>]*)?' if attr == "class" else value
    return rf"""<{tag}{other}\s+{attr}="{quoted}"{other}\s*>"""


def _dated(review: tuple[str, str, str], date: tuple[str, str, str]) -> str:
    """Pattern of a review element up to its first date, with no end tag and no table part in between; group 1 is
    the date's text."""
    step = rf"<(?!/|t(?:able|body|head|foot|[dhr])\b|{_open_tag(date)[1:]})[^<>]*+>"
    return rf"{_open_tag(review)}(?:[^<{_HIDDEN}]++|{step})*+{_open_tag(date)}([^<&{_HIDDEN}]*+)</{date[0]}\s*>"


def _amazon_day(text: Column) -> Column:
    return fields.parse_date(fields.trailing_date_token(text), "amazon")


def _homedepot_day(text: Column) -> Column:
    return fields.parse_date(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), "homedepot")


_LAYOUTS = {
    "amazon": (_dated(params.AMAZON["review"], params.AMAZON["date"]), _amazon_day),
    "homedepot": (_dated(params.HOMEDEPOT["review"], params.HOMEDEPOT["date"]), _homedepot_day),
}


def pager_label(html: Column) -> Column:
    """the page number that a Home Depot page's pager shows, read off the raw text (comments and scripts aside); NULL
    without a pager."""
    text = F.regexp_replace(html, _NO_MARKUP, _HIDDEN)
    return F.get(F.regexp_extract_all(text, F.lit(_open_tag(params.HOMEDEPOT["pager"]) + "([^<]*)"), F.lit(1)), F.lit(0))


def certainly_old(html: Column, layout: str, earliest: Column) -> Column:
    """Whether reading surely stops on the page: it has a review older than ``earliest``."""
    pattern, day = _LAYOUTS[layout]
    text = F.regexp_replace(html, _NO_MARKUP, _HIDDEN)
    old = F.exists(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda t: F.coalesce(day(t) < earliest, F.lit(False)))
    return F.coalesce(old & text.rlike(_PLAIN_PAGE), F.lit(False))


def pages_to_parse(landed: DataFrame, layout: str, earliest: Column | None = None, ends: DataFrame | None = None,
                   skipped: DataFrame | None = None) -> DataFrame:
    """The landed pages, all columns, that may be read.

    ``ends(target, page_no)``: pages from which on nothing of the target is read; ``skipped(target, page_no)``: pages
    that are not read themselves.  Only narrow rows are grouped and joined; the pages come in by one semi-join.
    """
    key = ["target", "page_no"]
    unread = [] if ends is None else [ends.select("target", F.col("page_no").cast("long").alias("from"))]
    if earliest is not None:
        old = landed.where(certainly_old(F.col("html"), layout, earliest)).select(*key)
        if skipped is not None:
            old = old.join(skipped, key, "left_anti")
        unread.append(old.select("target", (F.col("page_no").cast("long") + 1).alias("from")))
    if not unread and skipped is None:
        return landed
    pages = landed.select(*key).distinct()
    if unread:
        stops = unread[0] if len(unread) == 1 else unread[0].unionByName(unread[1])
        stops = stops.groupBy("target").agg(F.min("from").alias("from"))
        pages = pages.join(stops, "target", "left").where(F.col("from").isNull() | (F.col("page_no") < F.col("from"))).drop("from")
    if skipped is not None:
        pages = pages.join(skipped, key, "left_anti")
    return landed.join(pages, key, "left_semi")
