"""Quality rules with risk-controlled cutoffs, in plain DataFrame expressions.

*Counts.* Words are runs of characters other than space and tab to carriage return.  Per text: its words, the
code points in them, symbols, lines that equal an earlier line with a word, and words that lie in a three-word
window which occurs twice or more.  A text of fewer than ``LEAST_WORDS`` words, or with more than half of its
words repeated, fails the base rule.

*Rules.* Each rule is a whole number that grows as a text gets worse (``RULES``); a rule rejects a text whose
number reaches the cutoff of the text's stratum (its language).  Cutoffs come from labelled documents that pass
the base rule, which are a holdout, as nothing else is fitted on them.  From the laxest cutoff on, a cutoff that
rejects k of a stratum's n good documents is accepted while the exact binomial test rejects a false rejection
rate above ``risk`` divided among the rules: P(X <= k) <= error for X of n trials (the Clopper-Pearson bound).
Testing from lax to strict up to the first failure costs no correction; over strata and rules the error
1 - ``confidence`` is divided among them (Bonferroni).  So with that confidence, in every stratum at once, the
rules reject at most a share ``risk`` of the good documents.  Among accepted cutoffs the laxest that rejects as
many of the labelled bad documents as the strictest is taken; a rule that rejects none of them, or has too few
good documents for any cutoff, is off in that stratum.

Defined cases: a null text counts as empty; a null language is a stratum; texts of strata without cutoffs are kept
unless they fail the base rule; labels other than 0 and 1, of unknown documents, or contradicting each other for
one id are left out; repeated rows count as often as they come; an empty table gives an empty result.

Plan: the counts are within a row and written once as narrow numbers; the labelled ones are folded to counts by
(stratum, rule, number), at most ``len(RULES)`` x ``TOP`` rows a stratum, before any window; the cutoffs, one row a
stratum, are broadcast when counting finds them few.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import broadcast_if_small, scratch

#: Other than words, for Java's patterns.
SPACE = r"[ \t\n\x0B\f\r]+"
NO_SPACE = r"[^ \t\n\x0B\f\r]"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
#: Largest share of good documents that the rules together may reject, and the confidence in it.
RISK, CONFIDENCE = 0.05, 0.95
#: Numbers of a rule are clipped to 0 ... TOP.
TOP = 2000
#: Strata (one narrow row each) whose cutoffs a join may broadcast.
BROADCAST_STRATA = 100_000


def _per(part: str, whole: str, scale: int) -> Column:
    return F.least(F.lit(TOP), F.expr(f"({scale} * {part}) div nullif({whole}, 0)")).cast("int")


def rule_numbers() -> dict[str, Column]:
    """Rule: its number, growing as a text gets worse."""
    length = _per("word_chars", "n_words", 100)
    return {
        "symbols": _per("n_symbols", "word_chars", 1000),      # a thousandth of the characters
        "long_words": length,                                   # hundredths of a character a word
        "short_words": F.lit(TOP) - length,
        "dup_lines": _per("n_dup_lines", "n_lines", 1000),
        "repeats": _per("n_repeat_words", "n_words", 1000),
    }


RULES = ("symbols", "long_words", "short_words", "dup_lines", "repeats")


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Per row: ``doc_id``, ``stratum``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines`` (with a word),
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed``."""
    t = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[stratum_col].cast("string").alias("stratum"),
                    F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    t = t.select("doc_id", "stratum", F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
                 F.filter(F.split("text", SPACE), lambda w: w != "").alias("words"),
                 F.filter(F.split("text", "\n"), lambda line: line.rlike(NO_SPACE)).alias("lines"))
    keys = ["doc_id", "stratum", "n_symbols"]
    firsts = F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0)))
    t = t.select(*keys, F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
                 F.size("words").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "words",
                 F.transform(firsts, lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))).alias("hashes"))
    keys += ["word_chars", "n_words", "n_lines", "n_dup_lines"]
    # only texts with two windows of one hash are looked at closely: their windows are compared as strings, and
    # equal ones are neighbours once sorted
    again = F.size(F.array_distinct("hashes")) < F.size("hashes")
    t = t.select(*keys, F.when(again, F.sort_array(F.transform(firsts, lambda w, i: F.struct(
        F.concat_ws(" ", w, F.get("words", i + 1), F.get("words", i + 2)).alias("g"), i.alias("i"))))).alias("sorted"))
    twice = F.filter(F.transform("sorted", lambda x, j: F.when(
        (x["g"] == F.get("sorted", j - 1)["g"]) | (x["g"] == F.get("sorted", j + 1)["g"]), x["i"])), lambda i: i.isNotNull())
    t = t.select(*keys, F.sort_array(twice).alias("at"))
    # a window covers three words, or up to the next repeated window
    covered = F.aggregate(F.zip_with(F.slice("at", F.lit(2), F.size("at")), F.slice("at", F.lit(1), F.size("at") - 1),
                                     lambda b, a: F.least(b - a, F.lit(3))), F.lit(3), lambda s, x: s + x)
    t = t.select(*keys, F.when(F.size("at") > 0, covered).otherwise(0).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return t.withColumn("base_failed", failed)


def _log_factorial(x: Column) -> Column:
    """ln(x!) by Stirling's series of (x + 8)!, which is off by less than 1e-11."""
    z = x.cast("double") + 9
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * F.pow(z, 3)) \
        + 1 / (1260 * F.pow(z, 5)) - 1 / (1680 * F.pow(z, 7))
    product = x.cast("double") + 1
    for i in range(2, 9):
        product = product * (x + i)
    return series - F.log(product)


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of n trials with probability p, for k < n * p: the term at k times the sum of the ratios of
    the terms below it, of which those beyond ten deviations add nothing in double precision."""
    at_k = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
                 + k * math.log(p) + (n - k) * math.log1p(-p))
    terms = F.least(k, (F.ceil(10 * F.sqrt(n * p * (1 - p))) + 60)).cast("int")
    first = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def below(s: Column, j: Column) -> Column:
        i = k - j + 1
        term = s["term"] * (i * (1 - p)) / ((n - i + 1) * p)
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

    steps = F.when(terms > 0, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>"))
    return at_k * F.aggregate(steps, first, below, lambda s: s["sum"])


def cutoffs(counts: DataFrame, labels: DataFrame, risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """Per ``stratum`` and ``rule``: ``cutoff`` (a text is rejected from it on; null: the rule is off), ``n_good``,
    ``false_rejected`` and ``bad_rejected`` of the labelled documents.

    ``counts`` as ``text_counts`` gives it; ``labels`` has ``doc_id`` and ``quality`` (1: good).
    """
    known = (labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id")
             .agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most").drop("most"))
    numbers = rule_numbers()
    rows = counts.where("NOT base_failed").join(known, "doc_id").select("stratum", "quality", F.explode(F.array(
        *(F.struct(F.lit(r).alias("rule"), numbers[r].alias("number")) for r in RULES))).alias("r"))
    folded = scratch(rows.groupBy("stratum", F.col("r.rule").alias("rule"), F.col("r.number").alias("number")).agg(
        F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad")), "rule-counts")
    strata = max(folded.select("stratum").distinct().count(), 1)
    each = Window.partitionBy("stratum", "rule")
    from_worst = each.orderBy(F.col("number").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = folded.select("stratum", "rule", "number", F.sum("good").over(from_worst).alias("k"),
                          F.sum("bad").over(from_worst).alias("bad"), F.sum("good").over(each).alias("n"))
    rate, error = risk / len(RULES), (1 - confidence) / (strata * len(RULES))
    accepted = (F.col("k") < F.col("n") * rate) & (binomial_cdf(F.col("k"), F.col("n"), rate) <= error)
    best = F.max(F.when(accepted & (F.col("bad") > 0), F.struct("bad", "number", "k")))
    return steps.groupBy("stratum", "rule").agg(best.alias("best"), F.max("n").alias("n_good")).select(
        "stratum", "rule", F.col("best.number").alias("cutoff"), "n_good", F.col("best.k").alias("false_rejected"),
        F.col("best.bad").alias("bad_rejected"))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  stratum_col: str = "lang", risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """Per row: ``doc_id``, the counts, ``base_failed``, ``kept``, and ``failed_rules`` (comma-joined, as listed;
    empty where the base rule fails)."""
    counts = scratch(text_counts(docs, id_col, text_col, stratum_col), "rule-texts")
    found = cutoffs(counts, labels, risk, confidence).where("cutoff IS NOT NULL")
    found = scratch(found.groupBy(F.col("stratum").alias("of")).agg(
        *(F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES)), "rule-cutoffs")
    numbers = rule_numbers()
    failed = F.filter(F.array(*(F.when(numbers[r] >= F.col(f"cut_{r}"), F.lit(r)) for r in RULES)), lambda r: r.isNotNull())
    judged = counts.join(broadcast_if_small(found, BROADCAST_STRATA), F.col("stratum").eqNullSafe(F.col("of")), "left")
    judged = judged.withColumn("failed_rules", F.when(F.col("base_failed"), "").otherwise(F.array_join(failed, ",")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept"), "failed_rules")


def passing(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            stratum_col: str = "lang", risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """The rows of ``docs``, all columns, that the base rule and the rules keep."""
    from revlens.llm.common import without

    judged = quality_rules(docs, labels, id_col, text_col, stratum_col, risk, confidence)
    return without(docs, judged.where(~F.col("kept") & F.col("doc_id").isNotNull()), id_col)
