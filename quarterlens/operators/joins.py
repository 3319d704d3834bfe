"""Join helper: an explicit broadcast only behind a size bound by construction.

Every other join side carries no hint: the planner broadcasts below
``spark.sql.autoBroadcastJoinThreshold``, AQE plans anew from measured sizes, and beyond
that the join stays sort-merge or shuffled hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a table whose row count is bounded by construction.

    Use only for tables such as one row per calendar quarter or per nation,
    whose size cannot grow with the fact data.
    """
    return F.broadcast(df)
