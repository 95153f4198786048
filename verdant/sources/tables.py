"""Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """One table; callers select the columns they need so the scan is pruned."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def fact_table(spark: SparkSession, data_dir: str, name: str, *cols: str) -> DataFrame:
    """A fact table with only ``cols``."""
    return table(spark, data_dir, name).select(*cols)
