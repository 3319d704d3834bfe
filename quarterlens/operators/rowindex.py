"""Distributed global row index.

A window ``row_number()`` without a partition sends every row to one task. Here
rows are range-partitioned and sorted on the order key; after the sort,
``monotonically_increasing_id()`` holds (partition id << 33) + position within
the partition, computed in the JVM inside the sort's stage. The per-partition
counts (one number per partition, never per row) give offsets, and index =
offset + position.
"""

from __future__ import annotations

from itertools import accumulate
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterlens.session import cut_lineage

_POSITION_BITS = 33  # low bits of monotonically_increasing_id: row position in its partition


def global_row_index(df: DataFrame, order_cols: Sequence[str], index_col: str = "row_index",
                     num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """Return (df with a 0-based ``index_col`` in ``order_cols`` order, total row count).

    ``order_cols`` should identify a row; rows tied on them are numbered in an
    arbitrary but fixed order. The input and the numbered rows are checkpointed to
    the shared checkpoint folder: the upstream plan runs once, and the offsets and
    the data they apply to come from one materialisation (a recomputation could
    otherwise renumber ties).
    """
    n_parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Range partitioning samples its input in a job of its own before the shuffle;
    # reading a written copy keeps an expensive upstream plan from running twice.
    base = cut_lineage(df)
    ranged = base.repartitionByRange(n_parts, *order_cols).sortWithinPartitions(*order_cols)
    mid = F.monotonically_increasing_id()
    numbered = cut_lineage(ranged.select(
        *df.columns, F.shiftright(mid, _POSITION_BITS).alias("_pid"),
        mid.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_local")))
    # One number per partition comes to the driver and goes back as a table of as many rows.
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).orderBy("_pid").collect()
    ends = list(accumulate(r["n"] for r in counts))
    offsets = df.sparkSession.createDataFrame(
        [(r["_pid"], end - r["n"]) for r, end in zip(counts, ends)], "_part long, _offset long")
    out = numbered.join(F.broadcast(offsets), F.col("_pid") == F.col("_part")) \
        .withColumn(index_col, F.col("_offset") + F.col("_local"))
    return out.select(*df.columns, index_col), ends[-1] if ends else 0


def positional_split(df: DataFrame, order_cols: Sequence[str], train: float = 0.6,
                     val: float = 0.8) -> DataFrame:
    """First ``train`` share of rows -> train, up to ``val`` -> val, rest -> test."""
    indexed, n = global_row_index(df, order_cols)
    train_end, val_end = int(n * train), int(n * val)
    i = F.col("row_index")
    return indexed.withColumn("split", F.when(i < train_end, "train").when(i < val_end, "val")
                              .otherwise("test"))
