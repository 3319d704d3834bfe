"""Index membership snapshot text.

Each line holds a date and a quoted comma list of tickers, ``2019-03-29,"A,B,C"``, or one
unquoted ticker, ``2019-06-28,A``.
A quoted list may run over line ends. A line that begins with a date always begins a record, so
a quote that is never closed costs its own record only (the reference pairs dates and lists over the
whole file, so one malformed line shifts every later pair; we keep the intent).

Files are read in splits. Within a split records are joined as the lines stream by: a record is open
while it has an odd number of quotes. Only what a split cannot decide alone leaves it - the lines
before its first date, and a record that is open at its end - and is joined file by file, in the
order of the splits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: the date and quoted-list patterns.
DATE_PATTERN = r"\d{4}-\d{2}-\d{2}"
QUOTED_PATTERN = r"\"([^\"]+)\""


def parse_membership_lines(lines: DataFrame, line_col: str = "value",
                           keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep..., date DATE, ticker STRING), one row per ticker of each line.

    Dates and quoted lists of a line are paired by position; pairing stops at the
    shorter list (zip semantics). A line without a quoted list lists what follows its
    first date and a comma (a single ticker needs no quotes in CSV). Tickers are split
    on ``,`` without trimming. An impossible date (30 February) gives a null date.
    """
    line = F.col(line_col)
    dates = F.regexp_extract_all(line, F.lit(DATE_PATTERN), 0)
    lists = F.regexp_extract_all(line, F.lit(QUOTED_PATTERN), 1)
    bare = F.nullif(F.regexp_extract(line, DATE_PATTERN + r",([^\"\r\n]+)", 1), F.lit(""))
    lists = F.when((F.size(lists) == 0) & bare.isNotNull(), F.array(bare)).otherwise(lists)
    pairs = F.arrays_zip(dates.alias("d"), lists.alias("l"))
    x = lines.select(*keep, F.explode(pairs).alias("p"))
    x = x.filter(F.col("p.d").isNotNull() & F.col("p.l").isNotNull())
    return x.select(*keep, F.col("p.d").try_cast("date").alias("date"),
                    F.explode(F.split(F.col("p.l"), ",")).alias("ticker"))


RECORD, HEAD, TAIL = 0, 1, 2


def _odd(line: str) -> bool:
    return line.count('"') % 2 == 1


class _Split:
    """Joins the lines of one split; ``out`` gets (kind, text, whether the split has a date)."""

    def __init__(self, out: list) -> None:
        self.out, self.dated = out, False
        self.head: list[str] = []
        self.open: list[str] = []

    def add(self, line: str) -> None:
        if re.match(DATE_PATTERN, line):
            if self.open:                        # never closed
                self.out.append((RECORD, "\n".join(self.open), None))
            self.dated, self.open = True, []
            if _odd(line):
                self.open = [line]
            else:
                self.out.append((RECORD, line, None))
        elif not self.dated:
            self.head.append(line)
        elif self.open:
            self.open.append(line)
            if _odd(line):
                self.out.append((RECORD, "\n".join(self.open), None))
                self.open = []
        else:
            self.out.append((RECORD, line, None))

    def end(self) -> None:
        # a row even without lines: a date in this split ends what an earlier one left open
        self.out.append((HEAD, "\n".join(self.head) if self.head else None, self.dated))
        if self.open:
            self.out.append((TAIL, "\n".join(self.open), None))


def _join_splits(file_type: pa.DataType, split_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, split, found = None, None, []
        rows: list[tuple] = []

        def taken() -> None:
            rows.extend((*key, *f) for f in found)
            found.clear()

        def batch() -> pa.RecordBatch:
            types = [file_type, split_type, pa.int32(), pa.string(), pa.bool_()]
            made = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            rows.clear()
            return pa.RecordBatch.from_arrays(made, names=["file", "split", "kind", "value", "dated"])

        for b in batches:
            for file, at, line in zip(*(c.to_pylist() for c in b.columns)):
                if split is None or (file, at) != key:
                    if split is not None:
                        split.end()
                        taken()
                    key, split = (file, at), _Split(found)
                split.add(line or "")
            if split is not None:
                taken()
            if rows:
                yield batch()
        if split is not None:
            split.end()
            taken()
            yield batch()
    return run


def _join_fragments(file_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, carry, started = None, [], False
        for b in batches:
            done: list[tuple] = []
            for name, kind, value, dated in zip(*(c.to_pylist() for c in b.columns)):
                if not started or name != file:
                    if carry:
                        done.append((file, "\n".join(carry)))
                    file, carry, started = name, [], True
                if kind == TAIL:
                    carry = [value]
                    continue
                for line in value.split("\n") if value is not None else ():
                    if not carry:
                        done.append((file, line))
                        continue
                    carry.append(line)
                    if _odd(line):
                        done.append((file, "\n".join(carry)))
                        carry = []
                if dated and carry:
                    done.append((file, "\n".join(carry)))
                    carry = []
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*done), (file_type, pa.string()))],
                    names=["file", "value"])
        if carry:
            yield pa.RecordBatch.from_arrays(
                [pa.array([file], file_type), pa.array(["\n".join(carry)], pa.string())],
                names=["file", "value"])
    return run


def join_records(lines: DataFrame, file: str = "file", split: str = "split",
                 value: str = "value") -> DataFrame:
    """(file, value): the records of lines, their line ends kept.

    ``lines`` must come as Spark's text source gives them: a split's lines in order, one after
    another in one partition; the splits of a file are ordered by ``split``. No line is shuffled
    but those at the edges of splits; the lines are read twice, once for what splits decide
    alone and once for their edges. One record, and the undated lines that begin a split, must fit
    in memory.
    """
    src = lines.select(F.col(file).alias("file"), F.col(split).alias("split"), F.col(value).alias("value"))
    kinds = src.schema
    arrow = lines.sparkSession.createDataFrame([], kinds).toArrow().schema
    names = [f"{f.name} {f.dataType.simpleString()}" for f in kinds.fields[:2]]
    parts = src.mapInArrow(_join_splits(arrow.field(0).type, arrow.field(1).type),
                           f"{', '.join(names)}, kind int, value string, dated boolean")
    whole = parts.filter(F.col("kind") == RECORD).select("file", "value")
    edges = parts.filter(F.col("kind") != RECORD) \
        .repartition("file").sortWithinPartitions("file", "split", "kind") \
        .select("file", "kind", "value", "dated") \
        .mapInArrow(_join_fragments(arrow.field(0).type), f"{names[0]}, value string")
    return whole.union(edges)


def parse_membership_records(records: DataFrame, value: str = "value",
                             keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep..., date, ticker) of joined records: a line end within a list, and blanks around
    it, belong to no ticker."""
    flat = records.withColumn(value, F.regexp_replace(value, r"[ \t]*\r?\n[ \t]*", ""))
    return parse_membership_lines(flat, value, keep)


def read_membership_text(spark: SparkSession, path: str) -> DataFrame:
    """Read snapshot text files, join records that run over line ends, and parse them."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"), "value")
    return parse_membership_records(join_records(lines))
