"""Readers for the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table; callers select columns so that only the
    needed ones reach ``ReadSchema``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
