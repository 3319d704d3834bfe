"""Feature preparation with scikit-learn-compatible semantics.

Estimators follow Spark ML's fit / transform split: ``fit`` runs one aggregate job
and keeps a few numbers per column (or its category list); ``transform`` is
plain column arithmetic. Spark ML's own scalers differ from the reference on a
constant column (MinMaxScaler gives 0.5) and on the deviation (sample, not
population), hence these versions.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_BUCKETS = 10_000


def hash_bucket(*cols) -> Column:
    """0..9999 from the md5 of the '|'-joined key (same value in any SQL engine)."""
    key = F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c for c in cols])
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % HASH_BUCKETS)


def hash_split(df: DataFrame, key_cols: Sequence[str], test: float = 0.15,
               val_of_rest: float = 0.10) -> DataFrame:
    """K6: deterministic random split: ``test`` of the rows, then ``val_of_rest`` of the
    remainder, the rest train. Rows with equal keys always land together, and the
    result does not depend on partitioning (``randomSplit`` does)."""
    h = hash_bucket(*key_cols)
    t_cut = int(round(HASH_BUCKETS * test))
    v_cut = t_cut + int(round(HASH_BUCKETS * (1 - test) * val_of_rest))
    return df.withColumn("split", F.when(h < t_cut, "test").when(h < v_cut, "val").otherwise("train"))


@dataclass
class MinMaxScaling:
    """K1: (x - min) / (max - min); a constant column maps to 0 (scikit-learn).

    ``fit`` runs one aggregate; ``fit_lazy`` keeps it as scalar subqueries, so nothing runs before
    the transformed rows do.
    """
    columns: Sequence[str]
    stats: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "MinMaxScaling":
        self.stats = _numbers(df, self.columns, F.min, F.max)
        return self

    def fit_lazy(self, df: DataFrame) -> "MinMaxScaling":
        self.stats = _subqueries(df, self.columns, F.min, F.max)
        return self

    def transform(self, df: DataFrame, suffix: str = "_scaled") -> DataFrame:
        out = df
        for c, (lo, hi) in self.stats.items():
            lo, hi = _as_column(lo), _as_column(hi)
            constant = F.when(F.col(c).isNotNull(), F.lit(0.0))
            out = out.withColumn(c + suffix, F.when(hi == lo, constant).otherwise(
                (F.col(c) - lo) / (hi - lo)))
        return out


@dataclass
class StandardScaling:
    """K2: (x - mean) / population std; a zero deviation divides by 1 (scikit-learn).
    ``fit`` and ``fit_lazy`` as in :class:`MinMaxScaling`."""
    columns: Sequence[str]
    stats: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "StandardScaling":
        self.stats = _numbers(df, self.columns, F.avg, F.stddev_pop)
        return self

    def fit_lazy(self, df: DataFrame) -> "StandardScaling":
        self.stats = _subqueries(df, self.columns, F.avg, F.stddev_pop)
        return self

    def transform(self, df: DataFrame, suffix: str = "_std") -> DataFrame:
        out = df
        for c, (mean, std) in self.stats.items():
            mean, std = _as_column(mean), _as_column(std)
            scale = F.when(std == 0, 1.0).otherwise(F.coalesce(std, F.lit(1.0)))
            out = out.withColumn(c + suffix, (F.col(c) - mean) / scale)
        return out


def _numbers(df: DataFrame, columns: Sequence[str], a, b) -> dict:
    """{column: (a, b)} of two aggregates, by one job for all columns."""
    row = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("a", a), ("b", b))]).first()
    return {c: (row[f"a_{c}"], row[f"b_{c}"]) for c in columns}


def _subqueries(df: DataFrame, columns: Sequence[str], a, b) -> dict:
    """The same as scalar subqueries (one scan: equal subqueries are planned once)."""
    one = df.agg(F.struct(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("a", a), ("b", b))])
                 .alias("s")).scalar()
    return {c: (one[f"a_{c}"], one[f"b_{c}"]) for c in columns}


def _as_column(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.lit(None).cast("double") if x is None else F.lit(x)


@dataclass
class OneHotEncoding:
    """K3: one 0/1 column per category, categories sorted ascending, null last.

    ``drop_if_binary`` drops the first category of a two-category column. A value
    not seen by ``fit`` raises at transform time (scikit-learn's default). The encoding
    itself has one column per category, so the categories are held by the driver.
    """
    columns: Sequence[str]
    drop_if_binary: bool = True
    categories: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "OneHotEncoding":
        """One distributed pass for all columns (distinct values are found in each task
        first); no cap on their number."""
        aggs = [x for c in self.columns for x in (F.collect_set(c).alias(f"v_{c}"),
                                                  F.count_if(F.col(c).isNull()).alias(f"n_{c}"))]
        row = df.agg(*aggs).first()
        for c in self.columns:
            self.categories[c] = sorted(row[f"v_{c}"]) + ([None] if row[f"n_{c}"] else [])
        return self

    def kept(self, c: str) -> list:
        cats = self.categories[c]
        return cats[1:] if self.drop_if_binary and len(cats) == 2 else cats

    def indicator_columns(self, c: str) -> list[Column]:
        out = []
        for v in self.kept(c):
            hit = F.col(c).isNull() if v is None else (F.col(c) == F.lit(v))
            out.append(F.coalesce(hit, F.lit(False)).cast("double"))
        return out

    def checked(self, c: str) -> Column:
        """The column itself, raising on a category unseen at fit time."""
        cats = self.categories[c]
        known = [v for v in cats if v is not None]
        seen = F.col(c).isin(known) if known else F.lit(False)
        if None in cats:
            seen = seen | F.col(c).isNull()
        return F.when(F.coalesce(seen, F.lit(False)), F.col(c)).otherwise(
            F.raise_error(F.concat(F.lit(f"unknown category in {c}: "), F.col(c).cast("string"))))

    def transform(self, df: DataFrame, vector_col: str = "onehot") -> DataFrame:
        parts = []
        for c in self.columns:
            parts += self.indicator_columns(c)
        guarded = df.select(*[self.checked(c).alias(c) if c in self.columns else F.col(c)
                              for c in df.columns])
        vec = F.array(*parts) if parts else F.array().cast("array<double>")
        return guarded.withColumn(vector_col, vec)
