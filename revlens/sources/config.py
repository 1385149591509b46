"""Configuration and training sources.

Config files are small JSON documents; they are read with Spark as whole
text and turned into lookup tables with ``from_json`` and ``explode``, so
they join with review data like any other table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens import params, schemas

_LOWES = "urls map<string,array<string>>, model2desc map<string,string>"


def read_json_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with its whole text in ``value``."""
    return spark.read.text(path, wholetext=True)


def amazon_config(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """``targets(category, model_no, url)``, ``size2model(size, model_no,
    model_description)`` and ``model2desc(model_no, model_description)``.

    A category maps either to one URL or to an object of model -> URL, told apart by the VARIANT's type.
    """
    cfg = read_json_text(spark, path).select(F.parse_json("value").alias("c"))
    part = lambda name, of: F.variant_get("c", f"$.{name}", of)
    urls = cfg.select(F.explode(part("urls", "map<string,variant>")).alias("category", "v"))
    by_model = F.try_variant_get("v", "$", "map<string,string>")
    single = urls.filter(by_model.isNull()).select("category", F.lit(None).cast("string").alias("model_no"),
                                                   F.variant_get("v", "$", "string").alias("url"))
    multi = urls.filter(by_model.isNotNull()).select("category", F.explode(by_model).alias("model_no", "url"))
    size2model = cfg.select(F.explode(part("size2model", "map<string,array<string>>")).alias("size", "v")).select(
        "size", F.element_at("v", 1).alias("model_no"), F.element_at("v", 2).alias("model_description"))
    model2desc = cfg.select(F.explode(part("model2desc", "map<string,string>")).alias("model_no", "model_description"))
    return {"targets": single.unionByName(multi), "size2model": size2model, "model2desc": model2desc}


def lowes_config(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """``targets(model_no, url, product_id)`` and ``model2desc``."""
    from revlens.functions.fields import last_path_segment

    cfg = read_json_text(spark, path).select(F.from_json("value", _LOWES).alias("c"))
    targets = (cfg.select(F.explode("c.urls").alias("model_no", "urls"))
               .select("model_no", F.explode("urls").alias("url"))
               .withColumn("product_id", last_path_segment(F.col("url"))))
    model2desc = cfg.select(F.explode("c.model2desc").alias("model_no", "model_description"))
    return {"targets": targets, "model2desc": model2desc}


def training_csv(spark: SparkSession, path: str) -> DataFrame:
    """Training rows ``(title, body, category)``; quoted multi-line fields."""
    df = (spark.read.schema(schemas.TRAINING).option("header", True).option("multiLine", True)
          .option("escape", '"').csv(path))
    return df.select(F.col("Title").alias("title"), F.col("Body").alias("body"), F.col("Category").alias("category"))


def category_urls(spark: SparkSession) -> DataFrame:
    """Built-in ``(source, category, url)`` listing table (a fixed parameter table)."""
    rows = [(src, cat, url) for src, cats in params.CATEGORY_URLS.items() for cat, url in cats.items()]
    return spark.createDataFrame(rows, "source string, category string, url string")


def resolve_category(source: str, category: str) -> str:
    """Listing URL of a category; an unknown one is an error."""
    cats = params.CATEGORY_URLS.get(source)
    if cats is None:
        raise ValueError(f"unknown source: {source}")
    if category not in cats:
        raise ValueError(f"invalid category: {category}")
    return cats[category]


def check_config_category(targets: DataFrame, category: str | None) -> DataFrame:
    """S12 for config files: the category must be a key of ``urls``.  The check is part of the plan: a config without
    the category fails whatever job reads the result, and no job runs before."""
    hits = F.col("category") == F.lit(category)
    found = targets.agg(F.count_if(hits).alias("n"))
    wrong = F.assert_true(F.col("n") > 0, f"invalid category: {category}")      # NULL, or an error
    none = found.where(wrong.isNotNull()).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in targets.schema.fields])
    return targets.filter(hits).unionByName(none)
