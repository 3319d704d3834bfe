"""As-of join.

Spark has no public as-of join and the private one plans a nested-loop join.
Here both sides are tagged and unioned, and a window keeps the last right row
seen before each left row. To keep one hot key (say a third of all rows) from
landing in a single task, the window is partitioned by (key, time bucket), and
each bucket learns about right rows before it in one of two ways:

* copy - when the tolerance is at most one bucket wide, a right row is copied
  into the (at most two) buckets it can serve, so each bucket is complete;
* carry - otherwise (a wider tolerance, or none, or a bucket that was split) the best right
  row of all earlier buckets is joined to the bucket from a small per-(key, bucket) aggregate
  (one row per key and bucket, not per event), and the tolerance is checked on the match:
  the nearest earlier row is out of tolerance exactly when every earlier row is.

Bucket sizes are measured, not assumed: a (key, bucket) with more than ``max_group_rows`` rows is
cut at quantiles of its times, so a burst is split as finely as its instants allow, and left
rows that share one instant are dealt over several window partitions, each of which gets that
instant's few right rows. A window partition stays near the target as long as a bucket has at most
``MAX_CUTS`` times half of it (2e9 rows by default); beyond that its parts grow, and none is dropped.

Left rows are never de-duplicated or dropped (L33); a left row without a match
gets nulls. Right payload travels as one struct, so a null value in the matched
row never lets an older row's value leak through. Equal right timestamps resolve
to the largest ``right_tie`` value (pass a unique column for determinism).

Time columns may be DATE (units: days) or TIMESTAMP / TIMESTAMP_NTZ (units:
microseconds; NTZ values as wall clock, independent of the session time zone).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterlens.operators.latest import time_units
from quarterlens.session import cut_lineage

MICROS_PER_DAY = 86_400_000_000
MAX_GROUP_ROWS = 1_000_000      # rows of a window partition above which it is split
MAX_CUTS = 4096                 # parts of one split bucket
MAX_BROADCAST_BYTES = 8 << 20   # measured tables of splits up to this size are broadcast


def _is_date(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.DateType)


def _units(delta: dt.timedelta | int | None, is_date: bool) -> int | None:
    if delta is None:
        return None
    if isinstance(delta, int):
        return delta
    if is_date:
        if delta % dt.timedelta(days=1):
            raise ValueError("date columns need a whole-day tolerance")
        return delta.days
    return delta // dt.timedelta(microseconds=1)


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str,
              right_time: str, direction: str = "backward", allow_exact: bool = True,
              tolerance: dt.timedelta | int | None = None, right_tie: str | None = None,
              bucket_width: dt.timedelta | int | None = None,
              max_group_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Each left row with the nearest right row by time within equal ``on`` keys.

    ``direction='backward'``: latest right time <= left time (< when
    ``allow_exact`` is False); ``'forward'``: earliest right time >= left time.
    ``tolerance`` bounds the gap (inclusive). Output: left columns, then the right
    columns other than ``on`` (``right_time`` included, null when unmatched).

    ``bucket_width``: the tolerance (at least a day), or 30 days without one. One aggregate over
    the keys and times counts the rows of each (key, bucket); those with more than
    ``max_group_rows`` are split (see the module text). None leaves the count out, for sides whose
    groups are bounded by construction (such as one row per key and day on both).
    """
    if direction not in ("backward", "forward"):
        raise ValueError(direction)
    on = list(on)
    is_date = _is_date(left, left_time)
    if is_date != _is_date(right, right_time):
        raise TypeError("left and right time columns must both be DATE or both timestamps")
    tol = _units(tolerance, is_date)
    one_day = 1 if is_date else MICROS_PER_DAY
    if bucket_width is not None:
        width = max(int(_units(bucket_width, is_date)), 1)
    else:
        width = 30 * one_day if tol is None else max(tol, one_day)
    back = direction == "backward"

    payload_cols = [c for c in right.columns if c not in on]
    tie_col = right_tie or right_time
    left_cols = left.columns
    l_struct_t = T.StructType([left.schema[c] for c in left_cols])
    r_struct_t = T.StructType([right.schema[c] for c in payload_cols])
    tie_t = right.schema[tie_col].dataType
    key_types = {k: left.schema[k].dataType for k in on}
    n = F.col("_n")
    bucket = lambda x: F.floor(x / F.lit(width)).cast("long")

    # Right side: null keys / times never match in SQL; numeric time once per side.
    r_ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on + [right_time]])
    r = right.where(r_ok).select(*[F.col(k).cast(key_types[k]).alias(k) for k in on],
                                 time_units(right, right_time).alias("_n"),
                                 F.col(tie_col).alias("_tie"),
                                 F.struct(*[F.col(c) for c in payload_cols]).alias("_r"))
    l = left.select(*[F.col(k) for k in on], time_units(left, left_time).alias("_n"),
                    F.struct(*[F.col(c) for c in left_cols]).alias("_l"))
    cuts, deals = (None, None) if max_group_rows is None else \
        _splits(l, r, on, bucket, max_group_rows)

    # Side order at equal time: inclusive -> right first, strict -> left first.
    right_side, left_side = (0, 1) if allow_exact else (1, 0)
    order_n = n.asc() if back else n.desc()

    def as_left(df: DataFrame) -> DataFrame:
        return df.select(*on, "_b", "_deal", "_n", F.lit(left_side).alias("_side"),
                         F.lit(None).cast(tie_t).alias("_tie"), "_l",
                         F.lit(None).cast(r_struct_t).alias("_r"))

    def as_right(df: DataFrame) -> DataFrame:
        return df.select(*on, "_b", "_deal", "_n", F.lit(right_side).alias("_side"), "_tie",
                         F.lit(None).cast(l_struct_t).alias("_l"), "_r")

    group = [*on, "_b", "_deal"]
    if cuts is None and tol is not None and tol <= width:
        lo, hi = (n, n + F.lit(tol)) if back else (n - F.lit(tol), n)
        no_deal = F.lit(0).alias("_deal")
        u = as_left(l.select("*", bucket(n).alias("_b"), no_deal)).unionByName(as_right(
            r.select("*", F.explode(F.sequence(bucket(lo), bucket(hi))).alias("_b"), no_deal)))
        found = None
    else:
        l, r = (_placed(x, on, bucket, cuts) for x in (l, r))
        l = _dealt(l, on, deals, F.lit(0) if deals is None else F.pmod(
            F.xxhash64("_l"), F.coalesce("_m", F.lit(1))).cast("int"))
        if deals is not None:
            # few right rows are left where an instant is hot: the best one of each instant
            best = F.max(F.struct("_tie", "_r"))
            r = r.groupBy(*on, "_b", "_n").agg(best.alias("_x")).select(
                *on, "_b", "_n", F.col("_x._tie").alias("_tie"), F.col("_x._r").alias("_r"))
        r = _dealt(r, on, deals, F.lit(0) if deals is None else F.explode(
            F.sequence(F.lit(0), F.coalesce("_m", F.lit(1)) - 1)))
        # one exchange, read by the window and by the summaries
        u = as_left(l).unionByName(as_right(r)).repartition(*group)
        found = _carry(u, on, back, left_side)

    w = (Window.partitionBy(*group).orderBy(order_n, F.col("_side").asc(), F.col("_tie").asc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    matched = F.when(F.col("_r").isNotNull(), F.struct(n.alias("n"), F.col("_r").alias("r")))
    if found is not None:
        # coalesce keeps Catalyst from inferring a not-null filter for the summaries' input alone,
        # which would make their exchange differ from the window's
        theirs = {c: F.col(f"_c_{c.lstrip('_')}") for c in group}
        cond = reduce(lambda a, b: a & b, [F.col(c) == F.coalesce(t, t) for c, t in theirs.items()])
        u = u.join(found, cond, "left")
        seen = u.select("_n", "_l", F.coalesce(F.last(matched, ignorenulls=True).over(w),
                                               F.col("_carried")).alias("_m"))
    else:
        seen = u.select("_n", "_l", F.last(matched, ignorenulls=True).over(w).alias("_m"))
    ok = F.col("_m").isNotNull()
    if tol is not None:
        gap = (n - F.col("_m.n")) if back else (F.col("_m.n") - n)
        ok = ok & (gap <= F.lit(tol))
    return seen.where(F.col("_l").isNotNull()).select(
        *[F.col("_l")[c].alias(c) for c in left_cols],
        *[F.when(ok, F.col("_m.r")[c]).alias(c) for c in payload_cols])


def _small(df: DataFrame, row_bytes: int) -> DataFrame:
    """Broadcast a measured table of splits if it is small; beyond that the join shuffles."""
    return F.broadcast(df) if df.count() * row_bytes <= MAX_BROADCAST_BYTES else df


def _splits(l: DataFrame, r: DataFrame, on: list[str], bucket, target: int):
    """(cuts, deals), both None if no (key, bucket) has more than ``target`` rows.

    cuts: (on, _b, _cuts) quantile times of the groups to be split; deals: (on, _b, _m) the
    resulting groups whose left rows still exceed the target (one hot instant), with the number
    of parts, or None if there is no such group. Both have at most rows / target rows.
    """
    both = l.select(*on, "_n").unionByName(r.select(*on, "_n")) \
        .withColumn("_b", bucket(F.col("_n"))).where(F.col("_b").isNotNull())
    counts = both.groupBy(*on, "_b").agg(F.count(F.lit(1)).alias("_rows"))
    top = counts.agg(F.max("_rows")).first()[0]
    if top is None or top <= target:
        return None, None
    hot = cut_lineage(counts.where(F.col("_rows") > target))
    k = min(MAX_CUTS, -(-int(top) // max(1, target // 2)))
    key = hot.select(*[F.col(c).alias(f"_h_{c}") for c in [*on, "_b"]])
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_h_{c}") for c in [*on, "_b"]])
    points = F.percentile_approx("_n", [i / k for i in range(1, k)] or [0.5], max(10_000, 20 * k))
    cuts = cut_lineage(both.join(_small(key, 256), same).groupBy(*on, "_b")
                       .agg(F.array_distinct(points).alias("_cuts")))
    left = _placed(l, on, bucket, cuts)
    deals = cut_lineage(left.groupBy(*on, "_b").agg(F.count(F.lit(1)).alias("_rows"))
                        .where(F.col("_rows") > target)
                        .select(*on, "_b", F.ceil(F.col("_rows") / target).cast("int").alias("_m")))
    return cuts, (None if deals.isEmpty() else deals)


def _placed(df: DataFrame, on: list[str], bucket, cuts: DataFrame | None) -> DataFrame:
    """``df`` with its bucket ``_b``: the time bucket, and within a split one the number of cuts
    before the row. Order of buckets is order of time; equal times share a bucket."""
    df = df.withColumn("_b", bucket(F.col("_n")))
    if cuts is None:
        return df
    c = _small(cuts.select(*[F.col(x).alias(f"_h_{x}") for x in [*on, "_b"]], "_cuts"),
               8 * MAX_CUTS)
    same = reduce(lambda a, b: a & b, [F.col(x) == F.col(f"_h_{x}") for x in [*on, "_b"]])
    part = F.size(F.filter("_cuts", lambda x: x < F.col("_n")))
    # an instant that fills several quantiles is a cut of its own: rows at it stay together
    j = df.join(c, same, "left")
    at = F.coalesce(2 * part + F.array_contains("_cuts", F.col("_n")).cast("int"), F.lit(0))
    return j.withColumn("_b", F.col("_b") * F.lit(4 * MAX_CUTS) + at).select(*df.columns)


def _dealt(df: DataFrame, on: list[str], deals: DataFrame | None, deal: Column) -> DataFrame:
    """``df`` with ``_deal``, the part of its group that a row belongs to (0 if undivided)."""
    if deals is None:
        return df.withColumn("_deal", deal)
    d = _small(deals.select(*[F.col(x).alias(f"_h_{x}") for x in [*on, "_b"]], "_m"), 64)
    same = reduce(lambda a, b: a & b, [F.col(x) == F.col(f"_h_{x}") for x in [*on, "_b"]])
    return df.join(d, same, "left").withColumn("_deal", deal).select(*df.columns, "_deal")


def _carry(u: DataFrame, on: list[str], back: bool, left_side: int) -> DataFrame:
    """Best right row of all strictly earlier (backward) / later (forward) buckets, for every
    group of ``u`` that holds left rows: (_c_* group columns, _carried).

    Per key, the per-bucket best right rows and one marker per group with left rows
    are ordered by bucket, a marker before its own bucket's summary; the last
    summary strictly before a marker is the carried row. Only summary rows (one
    per key and bucket) reach this window, never events.
    """
    # One aggregate for both, which reads every column of ``u``: nothing can be pruned below the
    # exchange, so it is the one that the join's own window reads.
    n = F.col("_n") if back else -F.col("_n")
    best = F.max(F.when(F.col("_r").isNotNull(), F.struct(
        n.alias("k"), F.col("_tie").alias("t"), F.col("_n").alias("n"), F.col("_r").alias("r"))))
    is_left = (F.col("_side") == left_side) & F.col("_l").isNotNull()
    groups = u.groupBy(*on, "_b", "_deal").agg(best.alias("_best"),
                                               F.max(F.when(is_left, 1)).alias("_left"))
    none = F.lit(None).cast(groups.schema["_best"].dataType)
    rows = groups.select(*on, "_b", "_deal", F.explode(F.array(
        F.struct(F.when(F.col("_left") == 1, 0).alias("o"), none.alias("best")),
        F.struct(F.when(F.col("_best").isNotNull(), 1).alias("o"), F.col("_best").alias("best"))))
        .alias("_x")).select(*on, "_b", "_deal", "_x.o", "_x.best").where(F.col("o").isNotNull())
    order_b = F.col("_b").asc() if back else F.col("_b").desc()
    w = Window.partitionBy(*on).orderBy(order_b, F.col("o").asc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    c = rows.withColumn("_last", F.last("best", ignorenulls=True).over(w))
    c = c.where((F.col("o") == 0) & F.col("_last").isNotNull())
    return c.select(*[F.col(x).alias(f"_c_{x.lstrip('_')}") for x in [*on, "_b", "_deal"]],
                    F.struct(F.col("_last.n").alias("n"), F.col("_last.r").alias("r"))
                    .alias("_carried"))
