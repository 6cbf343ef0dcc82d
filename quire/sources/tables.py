"""Parquet table scans (S1 and the driver tables)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def text_table(spark: SparkSession, sf_dir: str, name: str, cols: list[str]) -> DataFrame:
    """Scan the needed columns of a text-heavy table. The number of tasks is
    the scan's (``spark.sql.files.maxPartitionBytes``)."""
    return table(spark, sf_dir, name).select(*cols)
