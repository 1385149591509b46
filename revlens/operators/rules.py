"""Keyword-rule labels (one 0/1 column per rule tag).

A rule fires when its pattern occurs in the lower-cased title or, searched
separately, in the lower-cased body.  Reviews rated 3 or more never get a
rule label; a NULL rating counts as negative (it is eligible).

Everything is one narrow projection of Column expressions: no shuffle and no
Python worker, so it runs unchanged on a streaming DataFrame.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens import params

# Java regex flags that make the patterns behave like Python's ``re`` on str:
# (?d) only '\n' ends a line, so '.' also matches '\r';
# (?U) '\s', '\d' and friends are Unicode aware.
_FLAGS = "(?dU)"


# A literal segment: letters, digits, spaces or escaped characters.
_LITERAL = r"(?:[A-Za-z0-9 ]|\\.)+"
_LAZY_CHAIN = re.compile(rf"{_LITERAL}(?:\.\+\?{_LITERAL})+")


def _commit_lazy_chains(pattern: str) -> str:
    """Rewrite alternatives of the form ``A.+?B.+?C`` (literal segments joined
    by lazy dots) to ``A(?>.+?B)(?>.+?C)``.

    For an existence test this is the same predicate: if any B after A leaves
    room for C, the first B after A does too, so committing to it loses no
    match.  It removes the backtracking over every later B, which is what
    makes such patterns slow on long lines.  Patterns with groups or other
    shapes are left exactly as written.
    """
    if "(" in pattern or "[" in pattern or "\\|" in pattern:
        return pattern
    out = []
    for alt in pattern.split("|"):
        if _LAZY_CHAIN.fullmatch(alt):
            head, *rest = alt.split(".+?")
            alt = head + "".join(f"(?>.+?{seg})" for seg in rest)
        out.append(alt)
    return "|".join(out)


def java_pattern(pattern: str) -> str:
    """The pattern as a Java regex with Python-like flags (see ``_FLAGS``),
    for use with ``rlike`` (an existence test)."""
    return _FLAGS + _commit_lazy_chains(pattern)


def rule_ineligible(rating: Column) -> Column:
    """True when the rating rules the review out; a NULL rating is eligible."""
    return F.coalesce(rating >= 3, F.lit(False))


def rule_match(title: Column, body: Column, pattern: str) -> Column:
    p = java_pattern(pattern)
    return (F.coalesce(F.lower(title).rlike(p), F.lit(False))
            | F.coalesce(F.lower(body).rlike(p), F.lit(False)))


def rule_flag(rating: Column, title: Column, body: Column, pattern: str) -> Column:
    return F.when(rule_ineligible(rating), F.lit(0)).otherwise(
        rule_match(title, body, pattern).cast("int"))


def rule_labels(df: DataFrame, rules: Sequence[tuple[str, str]] | None = None,
                rating: str = "rating", title: str = "title", body: str = "body") -> DataFrame:
    """Add one integer 0/1 column per ``(tag, pattern)``."""
    rules = list(params.RULES if rules is None else rules)
    return df.withColumns({
        tag: rule_flag(F.col(rating), F.col(title), F.col(body), pattern) for tag, pattern in rules
    })


def category_string(tags: Sequence[str]) -> Column:
    """Tags whose column is 1, in the given order, joined by `` / ``; none -> ''."""
    parts = [F.when(F.col(f"`{t}`") == 1, F.lit(t)) for t in tags]
    return F.concat_ws(" / ", *parts) if parts else F.lit("")


def with_category(df: DataFrame, tags: Sequence[str], name: str = "category") -> DataFrame:
    return df.withColumn(name, category_string(tags))
