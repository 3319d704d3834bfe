"""Reshaping."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wide_to_long(df: DataFrame, ids: Sequence[str], value_cols: Sequence[str],
                 name_col: str = "ticker", value_col: str = "close", drop_nulls: bool = True) -> DataFrame:
    """One column per series -> (ids..., name, value) rows (``unpivot``)."""
    long = df.unpivot(list(ids), list(value_cols), name_col, value_col)
    return long.filter(F.col(value_col).isNotNull()) if drop_nulls else long


def map_to_rows(df: DataFrame, map_col: str, key_name: str = "key", value_name: str = "value",
                keep: Sequence[str] = ()) -> DataFrame:
    """A keyed dictionary column -> one row per entry; struct values are flattened."""
    x = df.select(*keep, F.explode(map_col).alias(key_name, value_name))
    vt = x.schema[value_name].dataType
    if vt.typeName() == "struct":
        return x.select(*keep, key_name, *[F.col(f"{value_name}.{f.name}").alias(f.name) for f in vt.fields])
    return x
