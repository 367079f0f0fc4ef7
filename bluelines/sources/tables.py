"""Readers for the input tables.

Every reader returns a lazy DataFrame; Catalyst prunes columns and pushes filters
into the Parquet scan, so callers select only what they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, schema=None) -> DataFrame:
    """Scan one input table. With ``schema`` the declared types are enforced (no inference)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(table_path(sf_dir, name))


class Tables:
    """Named access to the input tables of one data folder: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
