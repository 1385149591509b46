"""Multinomial Naive Bayes per tag over tf-idf vectors.

Fit: one pass computes, for every tag at once, class counts and per-term
weight sums as grouped aggregations (the tag is a grouping key).
log_prob = ln((sum_w + alpha) / (class_total + alpha * V)); the prior is
ln(n_c / n), unsmoothed (Spark's built-in ``NaiveBayes`` smooths it).

The fitted parameters are at most ``tags x 2 x max_features`` numbers, so,
like Spark ML models, they are held on the driver and scoring is a narrow
expression per row: class 1 wins only when prior + dot(weights, log_prob) is
strictly greater than class 0's.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens import params
from revlens.functions import fields
from revlens.operators.tfidf import Vocabulary, fit_vocabulary, sparse_tfidf


def training_tags(df: DataFrame, category_col: str = "category") -> DataFrame:
    """Normalised tag array; rows with a blank category dropped."""
    cat = fields.normalise_category(F.col(category_col))
    return (df.withColumn("__cat", cat).filter(F.col("__cat") != "")
            .withColumn("tags", F.array_distinct(fields.split_tags(F.col("__cat")))).drop("__cat"))


def tag_vocabulary(df: DataFrame, category_col: str = "category") -> DataFrame:
    """Distinct tags of the training set ('' excluded)."""
    cat = fields.normalise_category(F.col(category_col))
    return (df.select(F.explode(fields.split_tags(cat)).alias("tag"))
            .filter(F.col("tag") != "").distinct())


def class_statistics(vectors: DataFrame, tags: Sequence[str], vec_col: str = "v",
                     tags_col: str = "tags") -> tuple[DataFrame, DataFrame]:
    """A4/A5: ``(tag, cls, n_c, total_w)`` and ``(tag, cls, idx, sum_w)``."""
    tag_arr = F.array(*[F.lit(t) for t in tags])
    per_tag = vectors.select(F.explode(tag_arr).alias("tag"), tags_col, vec_col).withColumn(
        "cls", F.array_contains(F.col(tags_col), F.col("tag")).cast("int"))
    # sparse vectors are summed map-side: one dense vector per tag, class and task is shuffled
    per_class = per_tag.groupBy("tag", "cls").agg(F.count(F.lit(1)).alias("n_c"),
                                                  Summarizer.sum(F.col(vec_col)).alias("s"))
    per_class = per_class.withColumn("s", vector_to_array("s"))
    totals = per_class.select("tag", "cls", "n_c", F.aggregate("s", F.lit(0.0), lambda a, x: a + x).alias("total_w"))
    sums = per_class.select("tag", "cls", F.posexplode("s").alias("idx", "sum_w"))
    return totals, sums


def log_prob_table(totals: DataFrame, sums: DataFrame, vocab: Vocabulary, n_docs: int,
                   alpha: float = params.NB_ALPHA) -> DataFrame:
    """``(tag, cls, idx, term, log_prob, log_prior)`` for every term of
    every class present, zero-count terms included (generated per class with
    a literal index sequence, not a cross join)."""
    v = len(vocab)
    terms = F.array(*[F.lit(t) for t in vocab.terms])
    grid = totals.select("tag", "cls", "n_c", "total_w",
                         F.posexplode(terms).alias("idx", "term"))
    j = grid.join(sums, ["tag", "cls", "idx"], "left")
    s = F.coalesce(F.col("sum_w"), F.lit(0.0))
    return j.select(
        "tag", "cls", "idx", "term",
        F.log((s + alpha) / (F.col("total_w") + alpha * v)).alias("log_prob"),
        F.log(F.col("n_c") / F.lit(float(n_docs))).alias("log_prior"))


@dataclass
class NBModel:
    vocab: Vocabulary
    tags: list[str]
    log_prior: dict = field(default_factory=dict)   # (tag, cls) -> float
    log_prob: dict = field(default_factory=dict)    # (tag, cls) -> list[float] over vocab

    # -- persistence (K3, K4, S10) -----------------------------------------
    def table(self, spark: SparkSession) -> DataFrame:
        rows = []
        for (tag, cls), probs in self.log_prob.items():
            for idx, lp in enumerate(probs):
                rows.append((tag, int(cls), idx, self.vocab.terms[idx], int(self.vocab.doc_freq[idx]),
                             int(self.vocab.n_docs), float(lp), float(self.log_prior[(tag, cls)])))
        return spark.createDataFrame(rows, "tag string, cls int, idx int, term string, df bigint, n_docs bigint, "
                                           "log_prob double, log_prior double")

    def save(self, spark: SparkSession, path: str) -> None:
        """Every tag's classifier with the vocabulary it was fitted on, in one write that replaces the
        partitions of these tags only: other saved tags stay, and no half of a model is ever newer."""
        (self.table(spark).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("tag").parquet(path))

    @classmethod
    def load(cls, spark: SparkSession, path: str, tags: Sequence[str]) -> "NBModel":
        """The classifiers of ``tags``; a tag that isn't saved, or tags saved with different vocabularies, are
        a ``KeyError`` (train again); any other error is the caller's."""
        nb = spark.read.parquet(path).filter(F.col("tag").cast("string").isin(list(tags)))
        rows = nb.limit(len(tags) * 2 * params.MAX_FEATURES + 1).collect()
        if len(rows) > len(tags) * 2 * params.MAX_FEATURES:
            raise ValueError("model table larger than tags x 2 x vocabulary")
        kept = {(str(r["tag"]), r["cls"]): set() for r in rows}
        for r in rows:
            kept[str(r["tag"]), r["cls"]].add((r["idx"], r["term"], r["df"], r["n_docs"]))
        if {t for t, _ in kept} != set(tags) or len({frozenset(v) for v in kept.values()}) != 1:
            raise KeyError("no classifiers of one vocabulary for the requested tags")
        words = sorted(next(iter(kept.values())))
        vocab = Vocabulary([w[1] for w in words], [int(w[2]) for w in words], int(words[0][3]))
        return cls._from_rows(vocab, rows, tags)

    @classmethod
    def from_table(cls, vocab: Vocabulary, nb: DataFrame, tags: Sequence[str]) -> "NBModel":
        most = max(1, len(tags)) * 2 * max(1, len(vocab))
        rows = nb.select("tag", "cls", "idx", "log_prob", "log_prior").limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError("model table larger than tags x 2 x vocabulary")
        return cls._from_rows(vocab, rows, tags)

    @classmethod
    def _from_rows(cls, vocab: Vocabulary, rows, tags: Sequence[str]) -> "NBModel":
        m = cls(vocab, list(tags))
        for r in rows:
            key = (str(r["tag"]), int(r["cls"]))
            m.log_prior[key] = r["log_prior"]
            m.log_prob.setdefault(key, [0.0] * len(vocab))[int(r["idx"])] = r["log_prob"]
        missing = [t for t in m.tags if not any(k[0] == t for k in m.log_prior)]
        if missing:
            raise KeyError(f"model has no classifier for: {missing}")
        return m

    # -- scoring (X17, A8) --------------------------------------------------
    def predict(self, vec: Column, tag: str) -> Column:
        """1 where class 1 scores strictly higher: one product with the difference of the two classes."""
        have = [c for c in (0, 1) if (tag, c) in self.log_prob]
        if len(have) < 2:
            return F.lit(have[0])
        more = F.array(*[F.lit(float(b - a)) for a, b in zip(self.log_prob[tag, 0], self.log_prob[tag, 1])])
        prior = F.lit(float(self.log_prior[tag, 1] - self.log_prior[tag, 0]))
        return (F.aggregate(F.zip_with(vec, more, lambda w, d: w * d), prior, lambda total, x: total + x) > 0).cast("int")


def labelled_ngrams(train: DataFrame, stem: bool = True, title: str = "title", body: str = "body",
                    category: str = "category") -> DataFrame:
    """Training rows with a non-blank category as ``(tags, ngrams)``."""
    from revlens.functions.text import with_review_ngrams

    labelled = training_tags(train, category).select("tags", title, body)
    return with_review_ngrams(labelled, title, body, stem, "ngrams").select("tags", "ngrams")


def fit_table(labelled: DataFrame, tags: Sequence[str],
              max_features: int = params.MAX_FEATURES) -> tuple[Vocabulary, DataFrame]:
    """X11 + X14 on ``(tags, ngrams)``: the vocabulary (bounded by
    ``max_features``) and the Spark-computed log-probability table."""
    # One pass: the document count and, per requested tag, whether any row has it.
    probe = labelled.agg(F.count(F.lit(1)).alias("n"), *[
        F.max(F.array_contains("tags", t).cast("int")).alias(f"t{i}") for i, t in enumerate(tags)]).collect()[0]
    unknown = [t for i, t in enumerate(tags) if not probe[f"t{i}"]]
    if unknown:
        raise KeyError(f"tags not in the training data: {unknown}")
    vocab = fit_vocabulary(labelled, "ngrams", max_features, n_docs=int(probe["n"]))
    if len(vocab) == 0:
        raise ValueError("empty vocabulary: the training texts have no terms")
    vectors = sparse_tfidf(labelled, vocab, "ngrams", "v")
    totals, sums = class_statistics(vectors, tags)
    return vocab, log_prob_table(totals, sums, vocab, vocab.n_docs)


def fit(train: DataFrame, tags: Sequence[str], stem: bool = True,
        max_features: int = params.MAX_FEATURES, title: str = "title", body: str = "body",
        category: str = "category") -> NBModel:
    """Fit the vectorizer and one classifier per tag on a training table
    ``(title, body, category)``.  An unknown tag is an error, raised before
    any classifier is built."""
    labelled = labelled_ngrams(train, stem, title, body, category).cache()
    try:
        vocab, table = fit_table(labelled, tags, max_features)
        return NBModel.from_table(vocab, table, list(tags))
    finally:
        labelled.unpersist()
