"""TF-IDF vocabulary fit and transform.

Fit: the vocabulary is the top ``max_features`` terms by total count, ties
broken by term (``frequent_terms``).  Rare n-grams, which are nearly all of
them, are never shuffled: each task keeps a heavy-hitter summary, the merged
summaries name the candidates, and only those are counted, exactly.  The
vocabulary's size is bounded by ``max_features``, which is what makes it safe
to hold on the driver and ship to every task (like a fitted
``CountVectorizerModel``).

Transform: Spark ML's ``CountVectorizerModel`` counts in-vocabulary n-grams
per row, ``ElementwiseProduct`` applies the idf and ``Normalizer`` the L2
norm.  All three are narrow JVM transforms: no shuffle, whatever the corpus
size.  idf = ln((1 + n) / (1 + df)) + 1 (smoothed, with the +1 that Spark's
own ``IDF`` leaves out).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens import params


@dataclass
class Vocabulary:
    terms: list[str]          # index order (alphabetical)
    doc_freq: list[int]
    n_docs: int

    @property
    def idf(self) -> list[float]:
        return [math.log((1 + self.n_docs) / (1 + d)) + 1.0 for d in self.doc_freq]

    def __len__(self) -> int:
        return len(self.terms)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """K3: ``vocab(term, idx, df, idf, n_docs)``."""
        rows = [(t, i, int(d), float(w), int(self.n_docs))
                for i, (t, d, w) in enumerate(zip(self.terms, self.doc_freq, self.idf))]
        schema = "term string, idx int, df bigint, idf double, n_docs bigint"
        return spark.createDataFrame(rows, schema)

    @classmethod
    def from_frame(cls, df: DataFrame, most: int = params.MAX_FEATURES) -> "Vocabulary":
        """A saved vocabulary; one of more than ``most`` terms is an error."""
        rows = df.orderBy("idx").limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"saved vocabulary has more than {most} terms")
        n = int(rows[0]["n_docs"]) if rows else 0
        return cls([r["term"] for r in rows], [int(r["df"]) for r in rows], n)


def term_stats(docs: DataFrame, ngrams_col: str = "ngrams") -> DataFrame:
    """A2: ``(term, total_count, doc_freq)`` over all documents: every n-gram counts once for the total, every
    distinct n-gram of a row once for the documents; one shuffle, by term, after map-side sums."""
    # explode_outer: a plain explode makes the optimizer infer a size() > 0
    # filter and push it below the projection that builds the n-grams, which
    # would evaluate the whole text pipeline a second time.
    one = lambda n, d: lambda t: F.struct(t.alias("term"), F.lit(n).alias("n"), F.lit(d).alias("d"))
    counts = F.concat(F.transform(ngrams_col, one(1, 0)), F.transform(F.array_distinct(ngrams_col), one(0, 1)))
    return (docs.select(F.explode_outer(counts).alias("t")).filter(F.col("t").isNotNull())
            .groupBy(F.col("t.term").alias("term"))
            .agg(F.sum("t.n").alias("total_count"), F.sum("t.d").alias("doc_freq")))


def top_terms(stats: DataFrame, max_features: int = params.MAX_FEATURES) -> DataFrame:
    """O2: the ``max_features`` most frequent terms (ties: term ascending)."""
    return stats.orderBy(F.desc("total_count"), F.asc("term")).limit(max_features)


#: Terms a summary keeps, at first and at most (the most that Spark's sketch takes), and the step between.
TRACKED, MOST_TRACKED, WIDER = 10_000, 1_000_000, 10
#: Candidates counted, as a multiple of the terms wanted.
CANDIDATES = 4


def _summary_error(tracked: int) -> float:
    """Largest share of all occurrences by which a frequent-items summary can be wrong: 3.5 / its table size, the power
    of two that holds ``tracked`` items at a load of three quarters."""
    return 3.5 / 2 ** math.ceil(math.log2(tracked / 0.75))


def frequent_terms(docs: DataFrame, ngrams_col: str = "ngrams", max_features: int = params.MAX_FEATURES,
                   tracked: int = TRACKED) -> DataFrame:
    """A2/O2: ``(term, total_count, doc_freq)`` of the ``max_features`` most frequent terms (ties: term ascending), equal to
    ``top_terms(term_stats(docs))``.

    1. One pass builds a summary of ``tracked`` terms a task and merges them (a frequent-items sketch): what is
       shuffled is bounded by tasks x summary.  A term that it does not return occurs at most ``bound`` times: twice its
       error, or the least estimate it returned.
    2. The returned terms are counted exactly, their occurrences folded map-side.
    3. If the last wanted term occurs more often than ``bound``, no other term can belong to the result.  Otherwise
       the summary is widened; beyond ``MOST_TRACKED`` (a corpus without frequent terms) all terms are counted.
    """
    most = CANDIDATES * max_features
    one = docs.select(F.explode_outer(ngrams_col).alias("term")).filter(F.col("term").isNotNull())
    while most <= tracked <= MOST_TRACKED:
        seen = one.agg(F.call_function("approx_top_k", F.col("term"), F.lit(most), F.lit(tracked)).alias("top"),
                       F.count(F.lit(1)).alias("n")).first()
        terms = [r["item"] for r in seen["top"]]
        if seen["n"] == 0:
            break
        least = min((r["count"] for r in seen["top"]), default=0) if len(terms) == most else 0
        # with no more occurrences than tracked terms the summary holds all of them
        bound = max(least, 0 if seen["n"] <= tracked else 2 * math.ceil(_summary_error(tracked) * seen["n"]))
        known = docs.select(F.filter(ngrams_col, lambda t: t.isin(terms)).alias(ngrams_col))
        top = top_terms(term_stats(known, ngrams_col), max_features).collect()      # max_features rows
        if (len(top) == max_features and top[-1]["total_count"] > bound) or (bound == 0 and len(terms) < most):
            schema = "term string, total_count bigint, doc_freq bigint"
            return docs.sparkSession.createDataFrame([tuple(r) for r in top], schema)
        tracked *= WIDER
    return top_terms(term_stats(docs, ngrams_col), max_features)


def fit_vocabulary(docs: DataFrame, ngrams_col: str = "ngrams",
                   max_features: int = params.MAX_FEATURES, n_docs: int | None = None) -> Vocabulary:
    """X11: fit the vocabulary and document frequencies on ``docs``
    (``n_docs``, if known, saves a count)."""
    if n_docs is None:
        n_docs = docs.count()
    top = frequent_terms(docs, ngrams_col, max_features).collect()
    assert len(top) <= max_features
    top = sorted(top, key=lambda r: r["term"])
    return Vocabulary([r["term"] for r in top], [int(r["doc_freq"]) for r in top], int(n_docs))


def sparse_tfidf(df: DataFrame, vocab: Vocabulary, ngrams_col: str = "ngrams", out_col: str = "v") -> DataFrame:
    """Add ``out_col`` = sparse L2-normalised tf-idf vector over the vocabulary."""
    cv = CountVectorizerModel.from_vocabulary(vocab.terms, inputCol=ngrams_col, outputCol="__tf")
    scale = ElementwiseProduct(scalingVec=Vectors.dense(vocab.idf), inputCol="__tf", outputCol="__tfidf")
    norm = Normalizer(p=2.0, inputCol="__tfidf", outputCol=out_col)
    return norm.transform(scale.transform(cv.transform(df))).drop("__tf", "__tfidf")


def tfidf_vectors(df: DataFrame, vocab: Vocabulary, ngrams_col: str = "ngrams",
                  out_col: str = "w") -> DataFrame:
    """Add ``out_col`` = dense L2-normalised tf-idf array over the vocabulary."""
    if len(vocab) == 0:
        return df.withColumn(out_col, F.array().cast(T.ArrayType(T.DoubleType())))
    return sparse_tfidf(df, vocab, ngrams_col, "__vec").withColumn(out_col, vector_to_array("__vec")).drop("__vec")


def tfidf_long(df: DataFrame, vocab: Vocabulary, doc_col: str = "doc_id",
               ngrams_col: str = "ngrams") -> DataFrame:
    """Long form ``(doc_id, term, weight)`` of the non-zero weights."""
    v = tfidf_vectors(df.select(doc_col, ngrams_col), vocab, ngrams_col, "__w")
    terms = F.array(*[F.lit(t) for t in vocab.terms])
    e = v.select(doc_col, F.posexplode_outer("__w").alias("idx", "weight")).filter(F.col("weight") != 0)
    return e.select(doc_col, F.element_at(terms, F.col("idx") + 1).alias("term"), "weight")
