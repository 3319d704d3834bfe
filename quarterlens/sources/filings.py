"""Filing documents stored as one text file each.

File names look like ``20150102_10-K_edgar_data_1022097_0001477932-15-000006.txt``:
identity (cik, type) comes from the name, the report period from the header.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlens.functions import ids
from quarterlens.functions.quarters import quarter_label
from quarterlens.functions.text import HEADER_CHARS, header_period, normalise_newlines
from quarterlens.functions.util import col_of

# Which names count as filings.
FILING_NAME_GLOB = "*.txt"
FILING_NAME_PATTERN = r"10-[QK]"
# Columns of a ``binaryFile`` listing; ``content`` is never selected.
LISTING_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
BATCH_BYTES = 16 << 20  # text that a reading task holds before it passes it on


def plain_path(path) -> Column:
    """A ``_metadata.file_path`` (URL-escaped) in the plain form that listings use."""
    return F.url_decode(F.replace(col_of(path), F.lit("+"), F.lit("%2B")))


def _listing(spark: SparkSession, folder: str, recursive: bool, glob: str | None) -> DataFrame:
    """Plain path of every object (``binaryFile``: the content column is pruned, nothing is read)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder).select("path")


def _open_files(max_bytes: int | None):
    """path rows -> (path, text, read_error): the head of each file, or the whole of it.

    A file that cannot be opened or read is a row with null text and the reason. A file system
    that is not known here is an error of the job (use ``through_spark``).
    """
    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        schema = pa.schema([("path", pa.string()), ("text", pa.string()),
                            ("read_error", pa.string())])
        for batch in batches:
            rows, size = [], 0
            for path in batch.column(0).to_pylist():
                system, inner = (fs.FileSystem.from_uri(path) if "://" in path else
                                 (fs.LocalFileSystem(), path.removeprefix("file:")))
                try:
                    with system.open_input_stream(inner) as f:
                        raw = f.read(max_bytes) if max_bytes else f.read()
                    rows.append((path, raw.decode("utf-8", errors="ignore"), None))
                    size += len(raw)
                except OSError as e:
                    rows.append((path, None, f"{type(e).__name__}: {e}"[:500]))
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.string()) for c in zip(*rows)], schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string()) for c in zip(*rows)], schema=schema)

    return run


def read_filings(spark: SparkSession, folder: str, recursive: bool = True,
                 normalise: bool = True, head_chars: int | None = None,
                 through_spark: bool = False) -> DataFrame:
    """A1 / A2: (path, filename, text, read_error) for every ``*.txt`` file whose name contains
    10-Q or 10-K, one row per file.

    The files are listed by Spark and opened by the tasks that get their paths, so a file that
    cannot be read stays as a row (null text, the reason in ``read_error``; see
    :func:`unreadable_filings`) and ``head_chars`` reads no more than the head of each file,
    however long the filings are. Text keeps LF newlines (L18).
    ``through_spark`` reads whole files with Spark's own text source instead, for stores only
    Spark can open; an unreadable file then fails the job.
    """
    if through_spark:
        df = (spark.read.option("pathGlobFilter", FILING_NAME_GLOB)
              .option("recursiveFileLookup", str(recursive).lower())
              .text(folder, wholetext=True)
              .select(plain_path("_metadata.file_path").alias("path"), F.col("value").alias("text"),
                      F.lit(None).cast("string").alias("read_error")))
        df = df.filter(ids.base_name("path").rlike(FILING_NAME_PATTERN))
    else:
        # UTF-8 takes at most four bytes a character, and CRLF shrinks to one
        paths = _listing(spark, folder, recursive, FILING_NAME_GLOB) \
            .filter(ids.base_name("path").rlike(FILING_NAME_PATTERN))
        df = paths.mapInArrow(_open_files(8 * head_chars if head_chars else None),
                              "path string, text string, read_error string")
    text = normalise_newlines("text") if normalise else F.col("text")
    if head_chars:
        text = F.substring(text, 1, head_chars)
    return df.select("path", ids.base_name("path").alias("filename"), text.alias("text"),
                     "read_error")


def read_paths(paths: DataFrame, normalise: bool = True) -> DataFrame:
    """The files of given plain paths in the form of :func:`read_filings`; a path without a file
    is an unreadable one."""
    df = paths.select("path").mapInArrow(_open_files(None),
                                         "path string, text string, read_error string")
    text = normalise_newlines("text") if normalise else F.col("text")
    return df.select("path", ids.base_name("path").alias("filename"), text.alias("text"),
                     "read_error")


def read_headers(spark: SparkSession, folder: str, recursive: bool = True,
                 header_chars: int = HEADER_CHARS) -> DataFrame:
    """A2: as :func:`read_filings`, but only the first ``header_chars`` characters of each file
    are read; enough for :func:`filings_metadata`."""
    return read_filings(spark, folder, recursive, head_chars=header_chars)


def unreadable_filings(filings: DataFrame) -> DataFrame:
    """One row: files, and how many of them could not be read."""
    return filings.agg(F.count(F.lit(1)).alias("files"),
                       F.count("read_error").alias("unreadable"))


def filings_metadata(filings: DataFrame, header_chars: int = HEADER_CHARS) -> DataFrame:
    """Cik, filing type, file name, report period (first ``header_chars``
    characters only) and its quarter label; unparsable period -> null (L21)."""
    period = header_period("text", header_chars)
    return filings.select(
        ids.cik_from_name("filename").alias("cik"),
        ids.filing_type_from_name("filename").alias("filing_type"),
        "filename", "path",
        period.alias("conformed_period_of_report"),
        quarter_label(period).alias("quarter"))


def list_objects(spark: SparkSession, prefix: str) -> DataFrame:
    """A3: every object path under ``prefix`` with its cik and file name."""
    return _listing(spark, prefix, True, None).select(
        ids.cik_from_name("path", strict=True).alias("cik"), "path",
        ids.base_name("path").alias("filename"))


def fetch_texts(paths: DataFrame, filings: DataFrame, path_col: str = "path") -> DataFrame:
    """A4: text for each wanted path; a missing object gives null text, never a failed job.

    ``filings`` is the result of :func:`read_filings` (same path form as :func:`list_objects`).
    The texts are first reduced to the wanted paths by a semi join (broadcast where the
    paths are small), so texts that nobody asked for are not shuffled.
    """
    wanted = paths.select(F.col(path_col).alias("_w")).distinct()
    texts = filings.select(F.col("path").alias("_p"), "text")
    texts = texts.join(wanted, texts["_p"] == wanted["_w"], "left_semi")
    return paths.join(texts, paths[path_col] == texts["_p"], "left").drop("_p")
