"""Risk-controlled quality rules."""

import math
import random
import re
from collections import Counter, defaultdict

from llm_fixtures import make, nothing, odd  # noqa: F401
from pyspark.sql import functions as F
from revlens.llm import quality_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    grams = list(zip(words, words[1:], words[2:]))
    times = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if times[g] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(words)
    return (n, sum(map(len, words)), sum(text.count(s) for s in rules.SYMBOLS), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_counts_against_plain_python(make):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choices(["a", "b", "é😀", "#x", "$", "c\n", "d\t", "\r\x0b\x0c", "\n\n", "e\x85f", "\x1f"], k=rnd.randint(0, 120))))
            for i in range(60)] + [(100, None), (101, ""), (102, " \n"), (103, "x y z " * 40), (104, "a b c"), (105, "a a a a")]
    got = {r.doc_id: r for r in rules.text_counts(make(rows), stratum_col="n").collect()}
    for i, text in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == counted(text), (i, text)


def tail(k, n, p):
    return sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p)
                        + (n - i) * math.log1p(-p)) for i in range(k + 1))


def test_binomial_tail_is_exact(spark):
    cases = [(k, n) for n in (1, 5, 299, 600, 5000, 200_000) for k in (0, 1, 3, 20, 900) if k < n * 0.01]
    df = spark.createDataFrame(cases, "k long, n long")
    for r in df.select("k", "n", rules.binomial_cdf(F.col("k"), F.col("n"), 0.01).alias("p")).collect():
        assert math.isclose(r.p, tail(r.k, r.n, 0.01), rel_tol=1e-7), r


def planted(seed):
    """Good texts, a few of which hold a symbol; bad texts full of them; language "b" has few labels."""
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(1200):
        lang, good = ("a", "b", None)[i % 10 // 8 + (i % 10 == 9)], i % 4 != 0
        words = [f"w{rnd.randint(0, 10**6)}" for _ in range(60)]
        if not good:
            words[::2] = ["##$$"] * 30
        elif rnd.random() < 0.02:
            words[0] = "#"
        docs.append((i, " ".join(words), lang))
        labels.append((i, int(good)))
    return docs, labels


def chosen(docs, labels, risk, confidence):
    """The documented rule in plain Python: (stratum, rule) -> cutoff."""
    quality, per = dict(labels), defaultdict(list)
    for i, text, lang in docs:
        n, chars, symbols, dups, repeats, failed = counted(text)
        if failed or i not in quality:
            continue
        lines = sum(bool(WORD.search(line)) for line in text.split("\n"))
        length = min(rules.TOP, 100 * chars // n)
        for rule, number in zip(rules.RULES, (1000 * symbols // chars, length, rules.TOP - length, 1000 * dups // lines,
                                              1000 * repeats // n)):
            per[lang, rule].append((number, quality[i]))
    strata = len({lang for lang, _ in per})
    rate, error = risk / len(rules.RULES), (1 - confidence) / strata / len(rules.RULES)
    cuts = {}
    for key, found in per.items():
        n, best = sum(q for _, q in found), None
        for cut in sorted({v for v, _ in found}, reverse=True):
            k, bad = sum(q for v, q in found if v >= cut), sum(1 - q for v, q in found if v >= cut)
            if k >= n * rate or tail(k, n, rate) > error:
                break
            if bad and (best is None or bad > best[0]):
                best = (bad, cut)
        if best:
            cuts[key] = best[1]
    return cuts


def test_cutoffs_against_plain_python(spark):
    docs, labels = planted(1)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4)
    lab = spark.createDataFrame(labels + [(5, 0), (5, 1), (6, None), (None, 1), (999_999, 0), (7, 3)], "doc_id long, quality int")
    for risk, confidence in ((0.05, 0.95), (0.2, 0.9), (0.4, 0.5)):
        got = rules.cutoffs(rules.text_counts(df), lab, risk, confidence).where("cutoff IS NOT NULL").collect()
        known = [(i, q) for i, q in labels if i != 5]
        assert {(r.stratum, r.rule): r.cutoff for r in got} == chosen(docs, known, risk, confidence)
    cuts = {(r.stratum, r.rule) for r in got}
    assert ("a", "symbols") in cuts                      # the test is of something


def test_verdicts_keep_good_and_drop_bad(spark):
    docs, labels = planted(2)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    out = {r.doc_id: r for r in rules.quality_rules(df, lab, risk=0.4, confidence=0.9).collect()}
    good = [out[i].kept for i, q in labels if q and docs[i][2] == "a"]
    bad = [out[i].kept for i, q in labels if not q and docs[i][2] == "a"]
    assert sum(good) >= 0.6 * len(good) and not any(bad)
    assert all(r.kept == (not r.base_failed and r.failed_rules == "") for r in out.values())
    # far too few labels for a bound: every rule is off, only the base rule rejects
    few = rules.quality_rules(df, lab.limit(20), risk=0.05).collect()
    assert all(r.kept == (not r.base_failed) for r in few)
    kept = rules.passing(df, lab, risk=0.4, confidence=0.9)
    assert {r.doc_id for r in kept.collect()} == {i for i, r in out.items() if r.kept} and kept.columns == df.columns


def test_edges(spark, odd, nothing):
    lab = spark.createDataFrame([(1, 1), (16, 0)], "doc_id long, quality int")
    rows = rules.quality_rules(odd, lab, stratum_col="word").collect()
    assert len(rows) == odd.count()
    assert all(r.n_words == 0 and r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3))
    long = [r for r in rows if r.doc_id == 6]
    assert long[0].n_words == 40_000
    assert rules.quality_rules(nothing, lab, stratum_col="word").count() == 0
    assert rules.quality_rules(odd, lab.limit(0), stratum_col="word").count() == odd.count()
