"""Review text to tokens and n-grams (X3-X10), as Column expressions.

Only the optional stemming step (X7) runs in Python; the rest are built-in
string and array functions evaluated in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens import params
from revlens.functions.stem import stem_tokens
from revlens.session import small_batches


def compose_text(title: Column, body: Column) -> Column:
    """The body alone when the title is a truncated copy of it (ends with
    '...' and the rest occurs in the body); otherwise title + ' ' + body."""
    t = F.coalesce(title, F.lit(""))
    b = F.coalesce(body, F.lit(""))
    truncated = t.endswith("...") & b.contains(
        F.substring(t, F.lit(1), F.greatest(F.length(t) - 3, F.lit(0))))
    return F.when(truncated, b).otherwise(F.concat(t, F.lit(" "), b))


def letters_only(text: Column) -> Column:
    """Lower-case, then every character outside A-Z / a-z becomes a space."""
    return F.regexp_replace(F.lower(text), "[^A-Za-z]", " ")


def split_contractions(text: Column) -> Column:
    """X5 (part): the word tokenizer splits a few apostrophe-free contractions."""
    # one pass: the groups of the alternatives that did not match are empty
    halves = [parts.split(" ") for _, parts in params.TOKENIZER_SPLITS]
    pattern = r"\b(?:" + "|".join(f"({a})({b})" for a, b in halves) + r")\b"
    first = "".join(f"${2 * i + 1}" for i in range(len(halves)))
    second = "".join(f"${2 * i + 2}" for i in range(len(halves)))
    return F.regexp_replace(text, pattern, f"{first} {second}")


def tokenize(text: Column) -> Column:
    """Whitespace tokens (the text holds only letters and spaces here)."""
    return F.filter(F.split(split_contractions(text), " "), lambda t: t != F.lit(""))


def drop_stopwords(tokens: Column) -> Column:
    """Remove stopwords, keeping duplicates and order (negations are kept)."""
    return F.filter(tokens, lambda t: ~t.isin(list(params.EFFECTIVE_STOPWORDS)))


def review_tokens(title: Column, body: Column, stem: bool = True) -> Column:
    """Cleaned (optionally stemmed) tokens of a review."""
    toks = drop_stopwords(tokenize(letters_only(compose_text(title, body))))
    return stem_tokens(toks) if stem else toks


def clean_text(tokens: Column) -> Column:
    """Tokens re-joined with single spaces."""
    return F.array_join(tokens, " ")


def vectorizer_tokens(tokens: Column) -> Column:
    """The vectorizer's token pattern keeps words of two or more characters."""
    return F.filter(tokens, lambda t: F.length(t) >= params.MIN_TOKEN_LEN)


def uni_bigrams(tokens: Column) -> Column:
    """Unigrams followed by bigrams of adjacent tokens.

    The bigrams zip the array with itself shifted by one; no lambda refers to
    ``tokens``, so nothing is recomputed per element.
    """
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    bigrams = F.zip_with(F.slice(tokens, 1, n), F.slice(tokens, 2, n),
                         lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(tokens, bigrams)


def with_ngrams(df: DataFrame, tokens: Column, out_col: str = "ngrams") -> DataFrame:
    """Add the vectorizer input (uni + bigrams over 2+ character tokens).

    The token arrays are materialised as columns first, so each row's text
    is cleaned once; the optimizer keeps the projections apart because the
    expensive token expression is referenced more than once.
    """
    tmp = "__vtoks"
    return (df.withColumn(tmp, vectorizer_tokens(tokens))
            .withColumn(out_col, uni_bigrams(F.col(tmp))).drop(tmp))


def with_review_ngrams(df: DataFrame, title: str = "title", body: str = "body", stem: bool = True,
                       out_col: str = "ngrams") -> DataFrame:
    """Vectorizer input of each review."""
    if stem:
        small_batches(df.sparkSession)
    return with_ngrams(df, review_tokens(F.col(title), F.col(body), stem), out_col)
