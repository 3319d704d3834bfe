"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Each callable takes (spark, sf_dir) and returns a lazy DataFrame over the whole
input tables. Double columns are rounded at the very end (6 digits) so results
compare across engines; the library functions themselves keep full precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (presentation for cross-engine comparison)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def load_all() -> None:
    """Import every query module so their ``register`` calls run."""
    from quarterlens.plans import (q_calendar, q_features, q_index, q_prices,  # noqa: F401
                                   q_sentiment)
