"""Secret scans in plain DataFrame expressions: fixed patterns, and windows of high entropy.

*Patterns* (leftmost, non-overlapping per kind): ``assign`` a keyword with a value of 6 or more characters,
``access`` an access key id of 20 or more, ``hex`` a run of 24 or more lower-case hex digits.

*Entropy.* Candidate strings are runs of one character class (``ENTROPY``) of at least ``WINDOW`` characters.
A window of that many characters slides over the candidate; as one character enters and one leaves, the sum of
c * log2 c over the window's character counts c is kept up to date from the counts of these two alone, and with it the
window's Shannon entropy, log2(WINDOW) - sum / WINDOW.  Windows at or above the class's threshold that touch are one
span.  The allow-list has two parts: candidates that match an ``ALLOWED`` pattern as a whole are known to be harmless and
are left out; ``SAMPLES``, words of examples, are blanked out before candidates are formed, so they are no part of a
secret and hide none beside them.

Spans are (kind, start, end) in code points, end exclusive.  A null text counts as empty; an empty text has
no spans; rows keep their ids, null or repeated; an empty table gives an empty result.  Everything is
within a row: no shuffle, whatever the skew.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import id_text

_WORDS = ("[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
          "[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]")
ASSIGN = f"""({_WORDS})["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A failing access or hex match holds no passing one, so the least lengths can be part of the pattern.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

WINDOW = 24
#: Class: (kind, characters, least entropy in bits of a window).
ENTROPY = (("entropy_hex", "0-9A-Fa-f", 3.0), ("entropy_base64", "A-Za-z0-9+/=_-", 3.9))
ALLOWED = (
    "^[0-9]+$", "^[A-Za-z]+$", "^[-=_+/]+$",                                   # numbers, words, rulers
    "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",                    # identifiers without meaning
    "^(/[A-Za-z0-9_-]+){3,}/?$",                                               # paths
)
#: In either case.
SAMPLES = ("0123456789abcdef", "abcdefghijklmnop", "placeholder", "example", "xxxx")
#: c * log2(c) in millionths, so sums are exact.
SCALE = 1_000_000


def count_terms(window: int) -> list[int]:
    return [round(c * math.log2(c) * SCALE) if c else 0 for c in range(window + 1)]


def most_sum(window: int, least_bits: float) -> int:
    """Largest sum of count terms at which a window still has the entropy."""
    return math.floor(window * (math.log2(window) - least_bits) * SCALE)


def _at(kind: str, start: Column, end: Column) -> Column:
    return F.struct(start.cast("long").alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                    F.lit(kind).alias("kind"), end.cast("long").alias("end"))


EMPTY = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"


def _none() -> Column:
    return F.array().cast(EMPTY)


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, matched string): the text between matches gives the positions."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,string:string>>").alias("all"))
    return F.aggregate(
        F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("string")), start,
        lambda s, m: F.struct(
            (s["at"] + F.length(m["gap"]) + F.length(m["string"])).cast("long").alias("at"),
            F.array_append(s["all"], F.struct((s["at"] + F.length(m["gap"])).cast("long").alias("start"),
                                              m["string"].alias("string"))).alias("all")),
        lambda s: s["all"])


def _plain(text: Column, kind: str, pattern: str) -> Column:
    spans = F.transform(matches(text, pattern),
                        lambda m: _at(kind, m["start"], m["start"] + F.length(m["string"])))
    return F.when(text.rlike(pattern), spans).otherwise(_none())


def _assigned(text: Column) -> Column:
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    pairs = F.filter(F.arrays_zip(matches(text, ASSIGN).alias("m"), values.alias("value")),
                     lambda p: F.length(p["value"]) >= 6)
    spans = F.transform(pairs, lambda p: _at("assign", p["m"]["start"], p["m"]["start"] + F.length(p["m"]["string"])))
    return F.when(text.rlike(ASSIGN.removesuffix("+)") + "{6,})"), spans).otherwise(_none())


def hot_windows(string: Column, window: int, least_bits: float) -> Column:
    """Maximal spans (start, end) of a candidate that windows of high entropy cover."""
    terms = F.array(*(F.lit(t).cast("long") for t in count_terms(window + 1)))   # one more enters before one leaves
    most = F.lit(most_sum(window, least_bits)).cast("long")
    spans_type = "array<struct<low:int,high:int>>"
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("n"), F.array().cast(spans_type).alias("spans"))

    def change(codes: Column, code: Column, i: Column) -> Column:
        """What the sum gains as character i enters and the one a window before leaves: their counts are how often
        they stand among the ``window`` characters before, and among those and the entering one."""
        before = F.slice(codes, F.greatest(i - window, F.lit(0)) + 1, F.least(i, F.lit(window)))
        count = F.size(before) - F.size(F.array_remove(before, code))
        gone = F.get(codes, i - window)
        left = window - F.size(F.array_remove(before, gone)) + F.when(gone == code, 1).otherwise(0)
        return (F.get(terms, count + 1) - F.get(terms, count)
                + F.when(i >= window, F.get(terms, left - 1) - F.get(terms, left)).otherwise(0)).cast("long")

    def step(state: Column, gain: Column) -> Column:
        total, n = state["sum"] + gain, state["n"] + 1
        low, last = n - window, F.try_element_at(state["spans"], F.lit(-1))
        grown = F.array_append(F.slice(state["spans"], F.lit(1), F.greatest(F.size(state["spans"]) - 1, F.lit(0))),
                               F.struct(last["low"].alias("low"), n.alias("high")))
        spans = F.when(last.isNotNull() & (last["high"] >= low), grown).otherwise(
            F.array_append(state["spans"], F.struct(low.alias("low"), n.alias("high"))))
        return F.struct(total.cast("long").alias("sum"), n.alias("n"),
                        F.when((low >= 0) & (total <= most), spans).otherwise(state["spans"]).cast(spans_type).alias("spans"))

    # the codes are bound once, so a step looks into them instead of into the string
    per_candidate = F.transform(F.array(F.transform(F.split(string, ""), F.ascii)), lambda codes: F.aggregate(
        F.transform(codes, lambda c, i: change(codes, c, i)), start, step, lambda s: s["spans"]))
    return F.element_at(per_candidate, 1)


def without_samples(text: Column, samples: tuple[str, ...]) -> Column:
    """The text with every sample word blanked out, at the same places."""
    blank = text
    for word in samples:
        blank = F.regexp_replace(blank, f"(?i){word}", " " * len(word))
    return F.when(text.rlike("(?i)" + "|".join(samples)), blank).otherwise(text) if samples else text


def _entropy(text: Column, kind: str, chars: str, least_bits: float, window: int, allowed: tuple[str, ...]) -> Column:
    pattern = f"[{chars}]{{{window},}}"
    harmless = "|".join(f"({allow})" for allow in allowed)
    kept = matches(text, pattern)
    if allowed:
        kept = F.filter(kept, lambda m: ~m["string"].rlike(harmless))
    spans = F.flatten(F.transform(kept, lambda m: F.transform(
        hot_windows(m["string"], window, least_bits), lambda s: _at(kind, m["start"] + s["low"], m["start"] + s["high"]))))
    return F.when(text.rlike(pattern), spans).otherwise(_none())


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                 classes: tuple = ENTROPY, allowed: tuple[str, ...] = ALLOWED, samples: tuple[str, ...] = SAMPLES) -> DataFrame:
    """Per row: ``doc_id``, ``text``, the array ``base`` of pattern spans and ``entropy`` of entropy spans."""
    text, rest = F.col("text"), F.col("rest")
    entropy = F.concat(*(_entropy(rest, *c, window, allowed) for c in classes)) if classes else _none()
    return id_text(docs, id_col, text_col).withColumn("rest", without_samples(text, samples)).select(
        "doc_id", "text", F.concat(_assigned(text), _plain(text, "access", ACCESS), _plain(text, "hex", HEX)).alias("base"),
        entropy.alias("entropy"))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans``, ``n_entropy``."""
    found = secret_spans(docs, id_col, text_col)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.concat("base", "entropy")).alias("spans"),
                        F.size("entropy").cast("long").alias("n_entropy"))
