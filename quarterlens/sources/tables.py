"""Parquet tables.

Every reader selects only the columns it needs, so the Parquet scan's
``ReadSchema`` is pruned and filters written after it are pushed into the scan.
"""

from __future__ import annotations

import os
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet table, pruned to ``columns``; its files are listed anew by each call."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
