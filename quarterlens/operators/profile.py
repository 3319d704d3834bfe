"""Column profile: type, non-null count and row count per column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_profile(df: DataFrame) -> DataFrame:
    """One aggregate pass (partial + final), then unpivoted to one row per column."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count(F.col(c)).alias(f"_nn_{i}") for i, c in enumerate(cols)])
    pairs = [F.struct(F.lit(c).alias("column_name"),
                      F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                      F.col(f"_nn_{i}").alias("non_null")) for i, c in enumerate(cols)]
    return wide.select(F.explode(F.array(*pairs)).alias("p"), F.col("_rows").alias("n_rows")) \
        .select("p.column_name", "p.data_type", "p.non_null", "n_rows")
