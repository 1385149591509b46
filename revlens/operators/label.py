"""End-to-end labelling of a review table.

Tags found in the rule dictionary are labelled by rules; the rest by the
Naive Bayes model, which is loaded from saved tables or, when any requested
classifier is missing, trained on the training table (all model tags
together) and saved.

Model labels are forced to 0 for reviews rated 3 or more (a NULL rating
stays eligible) and for a NULL, empty or placeholder body.  Ineligible rows
are given no tokens, so they skip stemming and vectorising altogether; the
result is the same as scoring everything and masking afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens import params
from revlens.functions.stem import stem_tokens
from revlens.functions.text import compose_text, drop_stopwords, letters_only, tokenize, with_ngrams
from revlens.operators import rules as rules_op
from revlens.operators.nb import NBModel, fit
from revlens.operators.tfidf import tfidf_vectors
from revlens.session import small_batches


def model_eligible(rating: Column, body: Column) -> Column:
    """F8: True when a model label may be 1."""
    bad = (F.coalesce(rating >= 3, F.lit(False)) | body.isNull()
           | body.isin("", params.PLACEHOLDER_BODY))
    return ~bad


def load_or_train(spark, ml_tags: Sequence[str], model_path: str | None = None,
                  training: DataFrame | None = None, stem: bool = True) -> NBModel:
    """All requested classifiers from ``model_path``, else train them all."""
    if model_path:
        try:
            return NBModel.load(spark, model_path, ml_tags)
        except KeyError:                       # a tag is missing: train all requested ones
            pass
        except AnalysisException as e:         # nothing saved there; any other error is not ours to hide
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    if training is None:
        raise FileNotFoundError("no saved model for the requested tags and no training table")
    model = fit(training, ml_tags, stem=stem)
    if model_path:
        model.save(spark, model_path)
    return model


def predict_labels(df: DataFrame, candidate_tags: Sequence[str] = params.DEFAULT_TAGS,
                   model: NBModel | None = None, training: DataFrame | None = None,
                   rules: Sequence[tuple[str, str]] = params.RULES, one_hot: bool = True,
                   stem: bool = True, model_path: str | None = None,
                   rating: str = "rating", title: str = "title", body: str = "body") -> DataFrame:
    """Add tag columns (when ``one_hot``) and ``category`` to a review table."""
    columns = list(df.columns)
    rule_dict = dict(rules)
    rule_tags = [t for t in candidate_tags if t in rule_dict]
    ml_tags = [t for t in candidate_tags if t not in rule_dict]
    out = rules_op.rule_labels(df, [(t, rule_dict[t]) for t in rule_tags], rating, title, body)
    if ml_tags:
        if model is None:
            model = load_or_train(df.sparkSession, ml_tags, model_path, training, stem)
        eligible = model_eligible(F.col(rating), F.col(body))
        toks = drop_stopwords(tokenize(letters_only(compose_text(F.col(title), F.col(body)))))
        toks = F.when(eligible, toks).otherwise(F.array().cast("array<string>"))
        if stem:
            small_batches(df.sparkSession)
            toks = stem_tokens(toks)
        out = with_ngrams(out, toks, "__ngrams")
        out = tfidf_vectors(out, model.vocab, "__ngrams", "__w")
        out = out.withColumns({
            t: F.when(eligible, model.predict(F.col("__w"), t)).otherwise(F.lit(0)) for t in ml_tags
        }).drop("__ngrams", "__w")
    out = out.withColumn("category", rules_op.category_string(candidate_tags))
    keep = columns + (list(candidate_tags) if one_hot else []) + ["category"]
    return out.select(*[F.col(f"`{c}`") for c in keep])
