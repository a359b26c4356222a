"""Readers for the parquet test tables.

Reads are lazy: Catalyst prunes the columns each plan uses and pushes its filters into
the parquet scan, so a caller never selects columns by hand for speed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Attribute access to the test tables of one folder: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]
