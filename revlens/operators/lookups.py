"""Dictionary lookups and spec-table model-number resolution.

Lookup dictionaries come from configuration and are small, but their size
is data: no broadcast is forced here.  Spark's planner broadcasts them when
the scan estimate is under ``autoBroadcastJoinThreshold`` and AQE converts
the join at runtime when the measured side is small; otherwise it stays a
shuffle join and still works.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens import params


def size_to_model(df: DataFrame, size2model: DataFrame, size_col: str = "size") -> DataFrame:
    """Size -> (model_no, model_description); unknown or NULL size falls back
    to the size itself for both.  ``size2model`` has ``size, model_no, model_description``."""
    lk = size2model.select(F.col("size").alias("__size"),
                           F.col("model_no").alias("__model"),
                           F.col("model_description").alias("__desc"))
    j = df.join(lk, F.col(size_col) == F.col("__size"), "left")
    return (j.withColumns({
        "model_no": F.coalesce("__model", F.col(size_col)),
        "model_description": F.coalesce("__desc", F.col(size_col)),
    }).drop("__size", "__model", "__desc"))


def strict_description(df: DataFrame, model2desc: DataFrame, model_col: str = "model_no",
                       failed_col: str | None = None) -> DataFrame:
    """Model -> description where a missing key is a failure.

    With ``failed_col`` the rows are kept and flagged; without it rows
    whose model has no description are dropped (inner join).
    """
    lk = model2desc.select(F.col("model_no").alias("__m"), F.col("model_description").alias("__d"))
    if failed_col is None:
        j = df.join(lk, F.col(model_col) == F.col("__m"), "inner")
        return j.withColumn("model_description", F.col("__d")).drop("__m", "__d")
    j = df.join(lk, F.col(model_col) == F.col("__m"), "left")
    return (j.withColumns({"model_description": F.col("__d"), failed_col: F.col("__m").isNull()})
            .drop("__m", "__d"))


def override_model(df: DataFrame, targets: DataFrame, key: str = "target") -> DataFrame:
    """A target with an explicit model overrides J1's result on every row.
    ``targets`` has ``key, model_no, model_description`` (NULL model = no override)."""
    t = targets.select(F.col(key), F.col("model_no").alias("__tm"),
                       F.col("model_description").alias("__td"))
    j = df.join(t, key, "left")
    has = F.col("__tm").isNotNull()
    return (j.withColumns({
        "model_no": F.when(has, F.col("__tm")).otherwise(F.col("model_no")),
        "model_description": F.when(has, F.col("__td")).otherwise(F.col("model_description")),
    }).drop("__tm", "__td"))


def zip_spec_pairs(tables: Column) -> Column:
    """E7 + J4: feature/item pairs from a page's tables (array of tables, each
    an array of rows, each an array of cell strings).

    One table: column 0 against column 1.  Several: column 0 of the first
    against column 0 of the second without its first row.  Zip is positional
    and the shorter side wins; a cell that a row lacks is NULL.
    """
    first = F.try_element_at(tables, F.lit(1))
    second = F.try_element_at(tables, F.lit(2))
    # a ragged row has no such cell: NULL, not an error
    col0 = lambda t: F.transform(t, lambda r: F.try_element_at(r, F.lit(1)))
    col1 = lambda t: F.transform(t, lambda r: F.try_element_at(r, F.lit(2)))
    feats = F.when(F.size(tables) == 1, col0(first)).when(F.size(tables) > 1, col0(first))
    items = (F.when(F.size(tables) == 1, col1(first))
             .when(F.size(tables) > 1, F.slice(col0(second), 2, 1 << 30)))
    n = F.least(F.size(feats), F.size(items))
    return F.when(n > 0, F.arrays_zip(F.slice(feats, 1, n).alias("feature"),
                                      F.slice(items, 1, n).alias("item")))


def model_from_pairs(pairs: Column, url: Column) -> Column:
    """Model number by priority from a page's (feature, item) pairs: the first ``Model``, else the last
    part-number feature, else the page URL.  Within the row: no shuffle."""
    models = F.filter(pairs, lambda p: p["feature"] == F.lit(params.MODEL_FEATURE))
    parts = F.filter(pairs, lambda p: p["feature"].isin(*params.PART_NUMBER_FEATURES))
    return (F.when(F.size(models) > 0, F.try_element_at(models, F.lit(1))["item"])
            .when(F.size(parts) > 0, F.try_element_at(parts, F.lit(-1))["item"]).otherwise(url))
