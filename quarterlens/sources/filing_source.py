"""Filings as a Spark data source: ``spark.read.format("filings")``.

The names of filings tell their type and company, so filters on those columns choose files before
any is opened. Files are dealt over partitions by their bytes, largest first, each to the partition
that has least: ten thousand small files make tasks as long as those of a few large ones. The
source lists, reads whole texts or heads only, and streams new files.

Options: ``path`` (folder), ``contents`` (``whole``, ``head`` or ``none``: listing only),
``headChars``, ``partitionBytes``.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamReader, EqualTo,
                                    Filter, In, InputPartition, IsNotNull, StringContains,
                                    StringEndsWith, StringStartsWith)

from quarterlens.functions.text import HEADER_CHARS
from quarterlens.sources.filings import BATCH_BYTES, FILING_NAME_PATTERN

SCHEMA = "path string, filename string, cik string, filing_type string, length long, " \
    "modified timestamp, text string, read_error string"
PARTITION_BYTES = 128 << 20
OPEN_BYTES = 64 << 10        # opening a file costs as much as reading this
LONGEST = (1 << 31) - 64     # bytes that one row can hold
# Where a name holds the company and the type.
CIK_PATTERN, TYPE_PATTERN = r"edgar_data_(\d+)_", r"10-[QK]"
FROM_NAME = ("path", "filename", "cik", "filing_type")     # columns known without opening a file


@dataclass(frozen=True)
class FilingFile:
    path: str
    length: int
    modified: int            # microseconds

    @property
    def named(self) -> dict[str, str | None]:
        name = self.path.rsplit("/", 1)[-1]
        cik, kind = re.search(CIK_PATTERN, name), re.search(TYPE_PATTERN, name)
        return {"path": self.path, "filename": name, "cik": cik and cik[1], "filing_type": kind and kind[0]}


class Files(InputPartition):
    """The files of one task."""

    def __init__(self, files: Sequence[FilingFile]) -> None:
        self.files = list(files)


def list_files(folder: str) -> list[FilingFile]:
    """Every filing below a folder, by path."""
    from pyarrow import fs

    if "://" in folder:
        system, inner = fs.FileSystem.from_uri(folder)
        prefix = folder[:len(folder) - len(inner)] if folder.endswith(inner) else ""
    else:
        system, inner, prefix = fs.LocalFileSystem(), folder.removeprefix("file:"), "file:"
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted((FilingFile(prefix + f.path, f.size, (f.mtime_ns or 0) // 1000) for f in found
                   if f.type == fs.FileType.File and f.base_name.endswith(".txt")
                   and re.search(FILING_NAME_PATTERN, f.base_name)), key=lambda f: f.path)


def deal(files: Sequence[FilingFile], partition_bytes: int, most_read: int | None = None
         ) -> list[Files]:
    """Files over as many partitions as their bytes fill, the largest first, each to the partition
    with the fewest bytes so far. ``most_read``: what is read of a file at most."""
    cost = {f: OPEN_BYTES + (f.length if most_read is None else min(f.length, most_read))
            for f in files}
    n = max(1, -(-sum(cost.values()) // partition_bytes))
    heap = [(0, i) for i in range(min(n, len(files)))]
    held: list[list[FilingFile]] = [[] for _ in heap]
    for f in sorted(files, key=lambda f: (-cost[f], f.path)):
        size, i = heapq.heappop(heap)
        held[i].append(f)
        heapq.heappush(heap, (size + cost[f], i))
    return [Files(sorted(h, key=lambda f: f.path)) for h in held]


def _holds(filter_: Filter, named: dict[str, str | None]) -> bool:
    """Whether a pushed filter is true of a file's name (null: not true)."""
    value = named[filter_.attribute[0]]
    if value is None:
        return False
    if isinstance(filter_, EqualTo):
        return value == filter_.value
    if isinstance(filter_, In):
        return value in filter_.value
    if isinstance(filter_, StringStartsWith):
        return value.startswith(filter_.value)
    if isinstance(filter_, StringEndsWith):
        return value.endswith(filter_.value)
    return not isinstance(filter_, StringContains) or filter_.value in value


class _Read:
    """What batch and stream reading share."""

    def __init__(self, options: dict[str, str]) -> None:
        self.folder = options["path"]
        self.contents = options.get("contents", "whole")
        if self.contents not in ("whole", "head", "none"):
            raise ValueError(f"contents: {self.contents}")
        self.head_chars = int(options.get("headChars", HEADER_CHARS))
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.pushed: list[Filter] = []

    @property
    def most_read(self) -> int | None:
        """Bytes read of a file at most (UTF-8 has up to four a character, CRLF shrinks to one)."""
        return {"whole": None, "head": 8 * self.head_chars, "none": 0}[self.contents]

    def wanted(self) -> list[FilingFile]:
        return [f for f in list_files(self.folder) if all(_holds(p, f.named) for p in self.pushed)]

    def dealt(self, files: Sequence[FilingFile]) -> list[Files]:
        return deal(files, self.partition_bytes, self.most_read) if files else [Files([])]

    def _text(self, f: FilingFile) -> tuple[str | None, str | None, int]:
        """(text, error, bytes read): an unreadable file has no text, and the reason."""
        from pyarrow import fs

        if self.contents == "none":
            return None, None, 0
        if self.contents == "whole" and f.length > LONGEST:
            return None, f"ValueError: {f.length} bytes are too many for one row", 0
        system, inner = fs.FileSystem.from_uri(f.path) if "://" in f.path else \
            (fs.LocalFileSystem(), f.path.removeprefix("file:"))
        try:
            with system.open_input_stream(inner) as s:
                raw = s.read() if self.most_read is None else s.read(self.most_read)
        except OSError as e:
            return None, f"{type(e).__name__}: {e}"[:500], 0
        text = raw.decode("utf-8", errors="ignore").replace("\r\n", "\n").replace("\r", "\n")
        return (text[:self.head_chars] if self.contents == "head" else text), None, len(raw)

    def batches(self, files: Sequence[FilingFile]) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("path", pa.string()), ("filename", pa.string()), ("cik", pa.string()),
                            ("filing_type", pa.string()), ("length", pa.int64()),
                            ("modified", pa.timestamp("us", tz="UTC")), ("text", pa.string()),
                            ("read_error", pa.string())])
        rows, size = [], 0
        for f in files:
            text, error, n = self._text(f)
            rows.append((*f.named.values(), f.length, f.modified, text, error))
            size += n + 200
            if size > BATCH_BYTES:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


class FilingReader(_Read, DataSourceReader):
    def pushFilters(self, filters: list[Filter]):
        """Filters on what the name holds choose files; all others are left to Spark."""
        known = (EqualTo, In, StringStartsWith, StringEndsWith, StringContains, IsNotNull)
        for f in filters:
            if isinstance(f, known) and f.attribute[0] in FROM_NAME:
                self.pushed.append(f)
            else:
                yield f

    def partitions(self) -> list[Files]:
        return self.dealt(self.wanted())

    def read(self, partition: Files) -> Iterator:
        return self.batches(partition.files)


class FilingStreamReader(_Read, DataSourceStreamReader):
    """New files in the order of (time of change, path); a micro-batch has all that are new.

    A file that changes is delivered again. One that arrives with an older time of change than
    those delivered is not: the batch job over the folder finds it.
    """

    def initialOffset(self) -> dict:
        return {"modified": -1, "path": ""}

    def latestOffset(self) -> dict:
        last = max(((f.modified, f.path) for f in self.wanted()), default=(-1, ""))
        return {"modified": last[0], "path": last[1]}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        low, high = ((o["modified"], o["path"]) for o in (start, end))
        return self.dealt([f for f in self.wanted() if low < (f.modified, f.path) <= high])

    def read(self, partition: Files) -> Iterator:
        return self.batches(partition.files)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class FilingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "filings"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FilingReader:
        return FilingReader(self.options)

    def streamReader(self, schema) -> FilingStreamReader:
        return FilingStreamReader(self.options)


def _registered(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FilingSource)
    return spark


def scan_filings(spark: SparkSession, folder: str, contents: str = "whole",
                 head_chars: int = HEADER_CHARS, partition_bytes: int = PARTITION_BYTES
                 ) -> DataFrame:
    """A1-A3: one row a filing (columns :data:`SCHEMA`), whole texts, heads, or names only.

    Conjunctive filters on path, filename, cik and filing_type (equality, ``in``, starts / ends
    with, contains, not null) decide which files are opened. A file that cannot be read, or is too
    long for one row, has null text and the reason in ``read_error``. The folder is listed once,
    on the driver, which holds a path, a length and a time for every file.
    """
    return _registered(spark).read.format("filings").option("contents", contents) \
        .option("headChars", head_chars).option("partitionBytes", partition_bytes).load(folder)


def stream_filings(spark: SparkSession, folder: str, contents: str = "whole",
                   partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """A1 as a stream: see :class:`FilingStreamReader`."""
    return _registered(spark).readStream.format("filings").option("contents", contents) \
        .option("partitionBytes", partition_bytes).load(folder)
