"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterlens.session import ensure_checkpoint_dir
from quarterlens.sources.tables import table_path

SLICE_ROWS = 1024      # rows that Python works on at a time
# A word is a run of bytes that are not ASCII white space; bytes.split() uses the same set.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A Parquet table of ``sf_dir``, pruned to ``columns`` (all of them if none is given)."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in ``spark.checkpoint.dir``: read again after a lost executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(df: DataFrame | Iterable[str], *names: str) -> list[str]:
    """Column names like ``names`` that clash with no column of ``df`` (case-insensitive)."""
    taken = {c.lower() for c in (df.columns if isinstance(df, DataFrame) else df)}
    out = []
    for name in names:
        new = f"__{name}"
        while new.lower() in taken:
            new += "_"
        taken.add(new.lower())
        out.append(new)
    return out


def with_python_columns(df: DataFrame, inputs: Sequence[str], fields: Sequence[T.StructField],
                        work: Callable[[list[pa.Array]], list[pa.Array]]) -> DataFrame:
    """``df`` plus ``fields``, computed from its columns ``inputs`` one Arrow batch at a time.

    ``work`` gets the input columns of at most ``SLICE_ROWS`` rows and returns one array per field. All other
    columns pass through unchanged, so no join is needed to bring a result back to its row.
    """
    at = [df.columns.index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), SLICE_ROWS):
                b = batch.slice(start, SLICE_ROWS)
                made = work([b.column(i) for i in at])
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, *made], names=[*b.schema.names, *(f.name for f in fields)])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields]))


def as_bytes(texts: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null: empty."""
    return [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]


def text_bytes(df: DataFrame, text: str) -> int:
    """Bytes of all texts (one aggregate over the text column)."""
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0


def sha256_hex(col: Column) -> Column:
    return F.sha2(col, 256)
