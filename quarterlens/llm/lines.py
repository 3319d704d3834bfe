"""Line dedup: a line that several documents have stays in the one of smallest id only.

Hashes of line keys (the line without ASCII white space at its ends, A-Z lower-cased) are range
partitioned and sorted by hash, document and position. One pass over each partition streams the
runs of equal hashes: the first document of a run keeps its lines, all later ones lose theirs.
What comes back to a document is a compressed bitmap of the lines that it keeps, never text.

A document sends one row a distinct key, with all places of that key. The range covers the document
and the place too, so a line that a third of all documents hold is cut over many partitions. Only
the first document of a partition's first run may then be judged wrongly, as its run may begin in
an earlier partition: those rows (about one a partition) are settled against the last runs of all
partitions. Hashes have 128 bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterlens.llm.common import SLICE_ROWS, as_bytes, checkpointed, fresh

BLANK = b" \t\n\x0b\x0c\r"
LAST = (1 << 63) - 1         # a null id sorts after all others

_SENT = "high long, low long, doc long, row long, line int, lines binary"
_MARKS = "kind int, high long, low long, doc long, row long, lines binary"
DROPPED, OPEN, EDGE = 0, 1, 2


def line_keys(text: bytes, min_chars: int) -> Iterator[tuple[int, bytes]]:
    """(place, key) of the lines whose key has ``min_chars`` code points or more."""
    for i, line in enumerate(text.split(b"\n")):
        key = line.strip(BLANK).lower()
        if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
            yield i, key


def _send(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), SLICE_ROWS):
                b = batch.slice(start, SLICE_ROWS)
                counts, digests, first, places = [], [], [], []
                for text in as_bytes(b.column(2)):
                    found: dict[bytes, list[int]] = {}
                    for i, key in line_keys(text, min_chars):
                        found.setdefault(xxhash.xxh3_128_digest(key), []).append(i)
                    counts.append(len(found))
                    digests.extend(found)
                    first.extend(p[0] for p in found.values())
                    places.extend(np.array(p, "<u4").tobytes() for p in found.values())
                hashes = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                owner = np.repeat(np.arange(len(b)), counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[:, 0]), pa.array(hashes[:, 1]),
                     b.column(0).take(pa.array(owner)), b.column(1).take(pa.array(owner)),
                     pa.array(first, pa.int32()), pa.array(places, pa.binary())],
                    names=["high", "low", "doc", "row", "line", "lines"])
    return run


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks of one sorted partition: lines to drop, rows left open, its last run."""
    lead = run = None                       # (high, low, first document here) of a run
    names = ["kind", "high", "low", "doc", "row", "lines"]
    for b in batches:
        if not len(b):
            continue
        high, low, doc = (b.column(i).to_numpy() for i in range(3))
        new = np.ones(len(b), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        new[0] = run is None or (int(high[0]), int(low[0])) != run[:2]
        heads = np.flatnonzero(new)
        first = doc[heads] if new[0] else np.r_[run[2], doc[heads]]
        least = first[np.cumsum(new) - int(new[0])]
        if lead is None:
            lead = (int(high[0]), int(low[0]), int(doc[0]))
        kind = np.full(len(b), -1, np.int32)
        kind[doc > least] = DROPPED
        kind[(high == lead[0]) & (low == lead[1]) & (doc == lead[2])] = OPEN
        at = pa.array(np.flatnonzero(kind >= 0))
        run = (int(high[-1]), int(low[-1]), int(least[-1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind[kind >= 0]), *(b.column(i).take(at) for i in (0, 1, 2, 3, 5))],
            names=names)
    if run is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([EDGE], pa.int32()), *(pa.array([x], pa.int64()) for x in run),
             pa.array([None], pa.int64()), pa.array([None], pa.binary())], names=names)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        made = []
        for parts in b.column(2).to_pylist():
            gone = np.frombuffer(b"".join(parts), "<u4")
            keep = np.ones(int(gone.max()) // 8 * 8 + 8, bool)      # whole bytes
            keep[gone] = False
            made.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(made, pa.binary())],
                                         names=["doc", "row", "keep"])


def unpack(keep: bytes, n_lines: int) -> np.ndarray:
    """The bits of a bitmap, one a line; lines beyond its end are kept."""
    out = np.ones(n_lines, bool)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[:n_lines]
    out[:len(bits)] = bits
    return out


def _row_key(id_col: str, text: str) -> list[Column]:
    """Document (null last) and row: rows of one id and text have the same bitmap."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)), F.xxhash64(F.col(text))]


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                 min_chars: int = 10) -> DataFrame:
    """(doc, row, keep) for each document that loses lines.

    ``doc`` is its id (2^63 - 1 for null), ``row`` the XXH64 of its text (rows may share an id)
    and ``keep`` a deflated bitmap, first line in the highest bit. Runs the job up to the marks
    and checkpoints them.
    """
    doc, row = _row_key(id_col, text)
    sent = docs.select(doc.alias("doc"), row.alias("row"), F.col(text).alias("text")) \
        .mapInArrow(_send(min_chars), _SENT)
    order = ["high", "low", "doc", "row", "line"]
    marks = checkpointed(sent.repartitionByRange(*order).sortWithinPartitions(*order)
                         .mapInArrow(_stream, _MARKS))
    dropped = marks.filter(F.col("kind") == DROPPED).select("doc", "row", "lines")
    runs = marks.filter(F.col("kind") == EDGE).groupBy("high", "low") \
        .agg(F.min("doc").alias("least"))
    settled = marks.filter(F.col("kind") == OPEN).join(runs, ["high", "low"]) \
        .filter(F.col("least") < F.col("doc")).select("doc", "row", "lines")
    # a set: equal rows send equal marks, of which one is enough
    return dropped.union(settled).groupBy("doc", "row") \
        .agg(F.collect_set("lines").alias("parts")) \
        .mapInArrow(_bitmaps, "doc long, row long, keep binary")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                        min_chars: int = 10, n_lines: str | None = "n_lines",
                        n_dropped: str | None = "n_dropped") -> DataFrame:
    """``docs`` without the lines that a document of smaller id has, plus the number of lines
    before and of those dropped (if names are given).

    A text is split at each line feed. Lines of equal key belong together; a key of fewer than
    ``min_chars`` code points is never dropped, nor is any line of the smallest document that has
    its key, however often it is there. A null or empty text is one empty line and stays empty.
    A null id counts as larger than any other; rows that share an id are one document in this,
    each with its own text. Other columns pass through, whatever their names. An empty table gives
    an empty result. Very long texts and lines are treated whole: one text must fit in memory,
    nothing else must. Runs a job when called (see ``keep_bitmaps``).
    """
    doc, row, keep = fresh(docs, "doc", "row", "keep")
    key = _row_key(id_col, text)
    maps = keep_bitmaps(docs, id_col, text, min_chars) \
        .select(F.col("doc").alias(doc), F.col("row").alias(row), F.col("keep").alias(keep))
    joined = docs.withColumns({doc: key[0], row: key[1]}).join(maps, [doc, row], "left") \
        .select(*docs.columns, keep)
    fields = [T.StructField(f, T.LongType()) for f in (n_lines, n_dropped) if f]
    at, width = docs.columns.index(text), len(docs.columns)
    names = [*docs.columns, *(f.name for f in fields)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), SLICE_ROWS):
                b = batch.slice(start, SLICE_ROWS)
                texts, total, gone = [], [], []
                for t, bits in zip(as_bytes(b.column(at)), b.column(width).to_pylist()):
                    n, lost = t.count(b"\n") + 1, 0
                    if bits is not None:
                        kept = unpack(bits, n)
                        lost = int(n - kept.sum())
                        lines = t.split(b"\n")
                        t = b"\n".join([lines[i] for i in np.flatnonzero(kept)])
                    texts.append(t)
                    total.append(n)
                    gone.append(lost)
                columns = b.columns[:width]
                columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
                counts = [total, gone]
                columns += [pa.array(c, pa.int64())
                            for c, f in zip(counts, (n_lines, n_dropped)) if f]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(cut, T.StructType([*docs.schema.fields, *fields]))


# the same in DuckDB: doc_id, n_lines, n_dropped, kept_sha256 over ``documents``
SQL = r"""
WITH cut AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM cut),
judged AS (
  SELECT *, length(k) >= 10 AND min(doc_id) OVER (PARTITION BY k) < doc_id AS gone FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), ''))
         AS kept_sha256
FROM judged GROUP BY doc_id
"""
