"""Parquet tables of the test data set (one file per table)."""

from __future__ import annotations

import os
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Read one table; selecting ``columns`` here prunes the parquet scan."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*columns) if columns else df
