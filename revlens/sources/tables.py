"""Readers for the supplied parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revlens.session import ship_package

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one supplied table, as the scan splits it; Catalyst prunes columns and pushes filters down."""
    if name not in TABLES:
        raise ValueError(f"unknown table: {name}")
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
