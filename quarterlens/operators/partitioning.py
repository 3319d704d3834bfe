"""Spreading CPU-heavy row work over more tasks than the input has file splits."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame

SPREAD_CONF = "quarterlens.spreadPartitions"


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` hash-partitioned on ``keys`` if the session asks for it, else ``df`` as it is.

    Text parsing and scoring cost CPU per row. A table in many file splits needs nothing: the
    setting ``quarterlens.spreadPartitions`` is off (0) by default, so the plan is the same at
    every size. For tables stored as one file or row group, whose scan is one task,
    set it to the number of tasks wanted; rows are then hash-partitioned on a unique or
    well-spread key, which is deterministic on retry, and a later aggregation on the same keys
    reuses the partitioning.
    """
    n = int(df.sparkSession.conf.get(SPREAD_CONF, "0"))
    return df.repartition(n, *keys) if n > 0 else df
