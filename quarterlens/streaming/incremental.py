"""Incremental, idempotent appends.

Only keys not yet present in the target are processed, then appended once. Re-runs
add nothing. The same function serves a batch job and a Structured Streaming
``foreachBatch`` sink (``trigger(availableNow=True)`` drains a folder of new
filings and stops; the checkpoint location makes progress survive restarts).
"""

from __future__ import annotations

import hashlib
import uuid
from typing import Callable, NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException


def pending(candidates: DataFrame, done_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``candidates`` whose key is not in ``done_keys`` (left anti join).

    Keys compare null-safely, so a row with a missing key part is processed once,
    not again on every run.
    """
    from pyspark.sql import functions as F

    done = done_keys.select(*[F.col(k).alias(f"_done_{k}") for k in keys]).distinct()
    cond = [F.col(k).eqNullSafe(F.col(f"_done_{k}")) for k in keys]
    return candidates.join(done, cond, "left_anti")


def union_incremental(existing: DataFrame, candidates: DataFrame, keys: Sequence[str],
                      process: Callable[[DataFrame], DataFrame],
                      done_keys: DataFrame | None = None) -> DataFrame:
    """Lazy form: existing results plus ``process`` over the pending rows only.

    ``done_keys``: rows with the keys of ``existing``, where these are cheaper to get
    than from ``existing`` itself (a lazy result would be computed a second time).
    """
    new = process(pending(candidates, existing if done_keys is None else done_keys, keys))
    return existing.unionByName(new)


def one_per_key(candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of each key (null-safe), the same one in every run: the smallest hash of
    the whole row. Equal rows are interchangeable. The limit of one row is applied in
    each task before the shuffle, so a key that repeats without end sends few rows."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    first = Window.partitionBy(*keys).orderBy("_order")
    return (candidates.withColumn("_order", F.xxhash64(*candidates.columns))
            .withColumn("_nth", F.row_number().over(first)).filter(F.col("_nth") == 1)
            .drop("_order", "_nth"))


# A target that was never written: nothing there, or a folder without files.
_NO_TARGET = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def _read_existing(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in _NO_TARGET:
            return None
        raise


class AppendReport(NamedTuple):
    appended: int
    rejected: int


def append_new_checked(spark: SparkSession, candidates: DataFrame, target_path: str,
                       keys: Sequence[str], process: Callable[[DataFrame], DataFrame],
                       partition_by: Sequence[str] = (), reject: Column | None = None,
                       drop: Sequence[str] = ()) -> AppendReport:
    """Process rows whose key is absent from ``target_path`` and append them.

    Several candidates of one key count as one (:func:`one_per_key`), so a key is appended
    once even if a run delivers it twice. Processed rows matching ``reject`` (e.g. a document the model could not fully
    score) are not appended but counted; their keys stay pending, so the next run
    tries them again. ``drop`` removes helper columns before writing. Both counts
    are observed during the single write (``Observation``), no second pass.
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    existing = _read_existing(spark, target_path)
    todo = candidates if existing is None else pending(candidates, existing, keys)
    out = process(one_per_key(todo, keys))
    bad = F.coalesce(reject, F.lit(False)) if reject is not None else F.lit(False)
    obs = Observation("appended")
    out = out.observe(obs, F.count_if(~bad).alias("appended"), F.count_if(bad).alias("rejected"))
    if reject is not None:
        out = out.filter(~bad)
    writer = out.drop(*drop).write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target_path)
    got = obs.get
    return AppendReport(int(got.get("appended") or 0), int(got.get("rejected") or 0))


def append_new(spark: SparkSession, candidates: DataFrame, target_path: str,
               keys: Sequence[str], process: Callable[[DataFrame], DataFrame],
               partition_by: Sequence[str] = ()) -> int:
    """M1: process rows whose key is absent from ``target_path`` and append them.

    Returns the number of appended rows (counted with an ``Observation`` during
    the write, no second pass).
    """
    return append_new_checked(spark, candidates, target_path, keys, process, partition_by).appended


def append_sentiment(spark: SparkSession, docs: DataFrame, target_path: str, scorer,
                     keys: Sequence[str] = ("doc_id",), text_col: str = "text") -> AppendReport:
    """N7 + M1 + B5: statistics of documents not yet in ``target_path``, appended once.

    With a skipping scorer, documents that have an unscored paragraph are left out
    and reported (``rejected``) instead of failing the job or being stored with
    incomplete numbers; a later run retries them.
    """
    from pyspark.sql import functions as F

    from quarterlens.operators.sentiment import sentiment_stats, skips_failures

    keys = list(keys)
    if not skips_failures(scorer):
        return append_new_checked(spark, docs, target_path, keys,
                                  lambda d: sentiment_stats(d, scorer, keys, text_col))
    return append_new_checked(spark, docs, target_path, keys,
                              lambda d: sentiment_stats(d, scorer, keys, text_col, failures=True),
                              reject=F.col("failed_chunks") > 0, drop=["failed_chunks"])


# Files per micro-batch: ``availableNow`` splits a backlog into batches of this size,
# each committed to the stream checkpoint on its own (B5: chunked progress).
MAX_FILES_PER_TRIGGER = 10_000


def stream_new_files(spark: SparkSession, source_dir: str, schema, target_path: str,
                     checkpoint_path: str, keys: Sequence[str],
                     process: Callable[[DataFrame], DataFrame], file_format: str = "parquet",
                     max_files_per_trigger: int = MAX_FILES_PER_TRIGGER):
    """M1 as a stream: new files in ``source_dir`` are processed once each.

    Uses ``availableNow`` so a scheduled run drains the backlog and stops; the
    backlog is cut into micro-batches of at most ``max_files_per_trigger`` files,
    so a failure late in a large backfill keeps the batches already committed.
    """
    stream = (spark.readStream.schema(schema).format(file_format)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(source_dir))

    def each_batch(batch: DataFrame, _epoch: int) -> None:
        append_new(batch.sparkSession, batch, target_path, keys, process)

    return (stream.writeStream.foreachBatch(each_batch)
            .option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True).start())


FILING_KEYS = ["cik", "filename"]


def failures_path(target_path: str) -> str:
    """Where the ledger of a filing target lies unless a caller names another place."""
    return target_path.rstrip("/") + ".failures"


def _append_filings(spark: SparkSession, files: DataFrame, target_path: str, scorer, run: str,
                    ledger_path: str | None = None, max_attempts: int | None = None
                    ) -> AppendReport:
    """(path, filename, text, read_error) filings -> MD&A -> statistics of the ones not yet in
    ``target_path``, appended once per (cik, filename). A filing that could not be read, or that
    a skipping scorer could not score, is not appended but recorded with the reason."""
    from pyspark.sql import functions as F

    from quarterlens.functions.ids import cik_from_name
    from quarterlens.operators.sentiment import sentiment_stats, skips_failures
    from quarterlens.plans.filings import extract_mda
    from quarterlens.streaming.ledger import append_with_ledger

    skip = skips_failures(scorer)
    helpers = ["path", "read_error", *(["failed_chunks"] if skip else [])]

    def process(batch: DataFrame) -> DataFrame:
        mda = extract_mda(batch.drop("cik"), keep=["read_error"])
        return sentiment_stats(mda, scorer, keys=[*FILING_KEYS, "path", "read_error"],
                               text_col="management_discussion", failures=skip)

    reason = F.when(F.col("read_error").isNotNull(), F.concat(F.lit("unreadable: "), "read_error"))
    if skip:
        reason = reason.when(F.col("failed_chunks") > 0, F.concat(
            F.col("failed_chunks").cast("string"), F.lit(" paragraphs not scored")))
    keyed = files.withColumn("cik", cik_from_name("filename"))
    return append_with_ledger(spark, keyed, target_path, ledger_path or failures_path(target_path),
                              FILING_KEYS, process, reason, run, helpers, max_attempts)


def append_filing_sentiment(spark: SparkSession, folder: str, target_path: str, scorer,
                            ledger_path: str | None = None, max_attempts: int | None = None
                            ) -> AppendReport:
    """M1 / B5 as a batch job over the whole filings folder: every filing missing from
    ``target_path`` is scored and appended once. Unreadable and unscored filings are counted in
    ``rejected``, recorded in the ledger with their reason, and tried again by every run (a stream
    run included) until they are done or were tried ``max_attempts`` times."""
    from quarterlens.sources.filings import read_filings

    return _append_filings(spark, read_filings(spark, folder), target_path, scorer,
                           f"batch-{uuid.uuid4()}", ledger_path, max_attempts)


def retry_filing_sentiment(spark: SparkSession, target_path: str, scorer,
                           ledger_path: str | None = None, max_attempts: int | None = None,
                           retry_after: int = 0, run: str | None = None,
                           also: DataFrame | None = None) -> AppendReport:
    """Opens and scores again the filings that are open in the ledger and due, without listing
    any folder. ``also``: paths of further filings, appended in the same step."""
    from quarterlens.sources.filings import read_paths
    from quarterlens.streaming.ledger import due, open_failures

    open_ = open_failures(spark, ledger_path or failures_path(target_path), FILING_KEYS)
    paths = also
    if open_ is not None:
        again = due(open_, max_attempts, retry_after).select("path")
        paths = again if also is None else also.select("path").union(again).distinct()
    if paths is None:
        return AppendReport(0, 0)
    return _append_filings(spark, read_paths(paths), target_path, scorer,
                           run or f"retry-{uuid.uuid4()}", ledger_path, max_attempts)


def stream_filing_sentiment(spark: SparkSession, folder: str, target_path: str,
                            checkpoint_path: str, scorer,
                            max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
                            ledger_path: str | None = None, max_attempts: int | None = None,
                            retry_after: int = 3600) -> "object":
    """M1 end to end: filing text files arriving in ``folder`` -> MD&A section ->
    per-filing sentiment statistics appended once per (cik, filename).

    The stream delivers paths (``binaryFile``, contents pruned) and the tasks open the files, so a
    file that cannot be read fails neither the micro-batch nor the run: it goes to the ledger, as
    does a filing that a skipping scorer rejects. What the ledger holds open is delivered again:
    by a pass before the stream starts, and with every micro-batch if its last try is
    ``retry_after`` seconds old. ``availableNow`` drains what is there and stops; the stream
    checkpoint plus the keyed append make re-runs and re-delivered files add nothing.
    """
    from quarterlens.functions import ids
    from quarterlens.sources.filings import (FILING_NAME_GLOB, FILING_NAME_PATTERN,
                                             LISTING_SCHEMA)

    paths = (spark.readStream.format("binaryFile").schema(LISTING_SCHEMA)
             .option("pathGlobFilter", FILING_NAME_GLOB)
             .option("maxFilesPerTrigger", max_files_per_trigger)
             .option("recursiveFileLookup", "true").load(folder).select("path"))
    paths = paths.filter(ids.base_name("path").rlike(FILING_NAME_PATTERN))
    # the same name for a micro-batch that runs again after a crash
    stream = hashlib.sha256(checkpoint_path.encode()).hexdigest()[:16]

    def each_batch(batch: DataFrame, epoch: int) -> None:
        retry_filing_sentiment(batch.sparkSession, target_path, scorer, ledger_path, max_attempts,
                               retry_after, f"stream-{stream}-{epoch}", also=batch)

    retry_filing_sentiment(spark, target_path, scorer, ledger_path, max_attempts)
    return (paths.writeStream.foreachBatch(each_batch)
            .option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True).start())
