"""Enrichment with a fallback table."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def any_null(columns: Sequence[str]) -> Column:
    """True when any of ``columns`` is null."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def rows_with_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The complement of ``dropna()``."""
    return df.filter(any_null(columns or df.columns))


def null_tokens(df: DataFrame, token: str = "None",
                columns: Sequence[str] | None = None) -> DataFrame:
    """C11: the text ``token`` becomes null in every string column."""
    cols = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.select(*[F.when(F.col(c) == token, F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def enrich_with_fallback(base: DataFrame, primary: DataFrame, fallback: DataFrame,
                         key: str, fields: Sequence[str]) -> DataFrame:
    """Take ``fields`` from ``primary``; if any of them is missing, take all of
    them from ``fallback`` instead (whole-row fallback, never field by field).

    One plan, no second pass over ``base``: the fallback join condition includes
    "primary incomplete", so complete rows never match (and never fan out on) the
    fallback table. Several primary or fallback rows per key fan out, as a plain
    left join does.
    """
    fields = list(fields)
    p = primary.select(F.col(key).alias("_pk"), *[F.col(f).alias(f"_p_{f}") for f in fields])
    fb = fallback.select(F.col(key).alias("_fk"), *[F.col(f).alias(f"_f_{f}") for f in fields])
    j = base.join(p, base[key] == p["_pk"], "left")
    incomplete = reduce(lambda a, b: a | b, [F.col(f"_p_{f}").isNull() for f in fields])
    j = j.withColumn("_incomplete", incomplete)
    j = j.join(fb, (j[key] == fb["_fk"]) & F.col("_incomplete"), "left")
    out = [F.col(c) for c in base.columns]
    out += [F.when(F.col("_incomplete"), F.col(f"_f_{f}")).otherwise(F.col(f"_p_{f}")).alias(f)
            for f in fields]
    return j.select(*out)


def left_dim_with_default(df: DataFrame, dim: DataFrame, key: str, fields: Sequence[str],
                          default: str = "N/A", null_token: str | None = "None") -> DataFrame:
    """D13 + C11 + C13: dictionary lookup; text ``None`` and misses become ``default``."""
    d = null_tokens(dim, null_token, list(fields)) if null_token else dim
    j = df.join(d.select(key, *fields), key, "left")
    return j.select(*[F.coalesce(F.col(c), F.lit(default)).alias(c) if c in fields else F.col(c)
                      for c in j.columns])
