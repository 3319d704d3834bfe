"""Reading embedding columns: which vectors take part, and their packed form."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, vec: str) -> DataFrame:
    """``vectors`` with ``vec`` (an array of numbers) packed as little-endian doubles.

    Null where it is null, empty, zero, or holds null or non-finite components.
    """
    at = vectors.columns.index(vec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(at)
            out = []
            for i in range(len(col)):
                x = col[i].values
                ok = x is not None and len(x) and not x.null_count
                v = x.to_numpy(zero_copy_only=False).astype("<f8") if ok else None
                ok = ok and np.isfinite(v).all() and v.any()
                out.append(v.tobytes() if ok else None)
            columns = list(b.columns)
            columns[at] = pa.array(out, pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    schema = vectors.withColumn(vec, F.lit(None).cast("binary")).schema
    return vectors.mapInArrow(run, schema)


def unpacked(packed: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Packed vectors of one length as the rows of a matrix."""
    rows = packed.to_pylist()
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1)
