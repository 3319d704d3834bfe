"""Keyed state of failed documents over runs.

The ledger is an append-only Parquet table next to the target: one row for each key and run that
failed (with the reason), and one when a key that had failed is done. Its fold is the state: what
is still open, since when, how often it was tried and why it failed last. A key of the target is
never scored again, a failed key never enters the target, so the two together tell of every
document whether it is done, open or given up - whichever step a crash interrupts:

* before the target is written: nothing happened, the keys are pending;
* between target and ledger: done keys are in the target, failed ones are tried again (a batch
  lists its folder again, a stream runs the micro-batch again);
* after a stream wrote its ledger but did not commit: the micro-batch runs again under the same
  run name, and attempts count distinct runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlens.session import cut_lineage
from quarterlens.streaming.incremental import AppendReport, _read_existing, one_per_key, pending

FAILED, DONE = "failed", "done"
EVENT_COLUMNS = ["path", "run", "at", "outcome", "reason"]


def state(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., path, reason, attempts, first_at, last_at, is_open) of every key of a ledger.

    ``attempts`` counts distinct runs that failed, so a run that was written twice counts once.
    A key is open if its last event is a failure (of events of one moment the failure is last, of
    several of those the one whose run's name is greatest). Path and reason are of the last failure.
    """
    failed = F.col("outcome") == FAILED
    once = events.groupBy(*keys, "run", "outcome").agg(
        F.max("at").alias("at"), F.max_by("path", "at").alias("path"),
        F.max_by("reason", "at").alias("reason"))
    order = F.struct("at", failed, "run")
    return once.groupBy(*keys).agg(
        F.max_by("path", F.when(failed, order)).alias("path"),
        F.max_by("reason", F.when(failed, order)).alias("reason"),
        F.count_if(failed).alias("attempts"),
        F.min(F.when(failed, F.col("at"))).alias("first_at"),
        F.max(F.when(failed, F.col("at"))).alias("last_at"),
        F.max_by(failed, order).alias("is_open")) \
        .filter(F.col("attempts") > 0)


def open_failures(spark: SparkSession, ledger_path: str, keys: Sequence[str]) -> DataFrame | None:
    """The open keys of a ledger (see :func:`state`); None before the first failure."""
    events = _read_existing(spark, ledger_path)
    return None if events is None else state(events, keys).filter("is_open").drop("is_open")


def due(open_: DataFrame, max_attempts: int | None, retry_after: int = 0) -> DataFrame:
    """Open keys that are to be tried again: not given up, last tried ``retry_after`` seconds ago
    or longer."""
    out = open_.filter(F.col("last_at") <= F.current_timestamp()
                       - F.make_dt_interval(secs=F.lit(retry_after)))
    return out if max_attempts is None else out.filter(F.col("attempts") < max_attempts)


def append_with_ledger(spark: SparkSession, candidates: DataFrame, target_path: str,
                       ledger_path: str, keys: Sequence[str],
                       process: Callable[[DataFrame], DataFrame], failure: Column, run: str,
                       helpers: Sequence[str] = (), max_attempts: int | None = None
                       ) -> AppendReport:
    """Process the candidates whose key is in neither the target nor given up, once each; append
    those without ``failure`` (a text column of the processed rows, null: good) to the target and
    record the others in the ledger.

    ``process`` must keep one row a key, with ``path``. ``helpers`` are its columns that the
    target does not get. The processed rows are checkpointed first: both tables are written
    from the same scores, and no document is opened or scored twice.
    """
    keys = list(keys)
    existing = _read_existing(spark, target_path)
    open_ = open_failures(spark, ledger_path, keys)
    todo = candidates if existing is None else pending(candidates, existing, keys)
    if open_ is not None and max_attempts is not None:
        todo = pending(todo, open_.filter(F.col("attempts") >= max_attempts), keys)
    out = cut_lineage(process(one_per_key(todo, keys)).withColumn("_failure", failure))
    good = out.filter(F.col("_failure").isNull())
    good.drop("_failure", *helpers).write.mode("append").parquet(target_path)

    now = F.current_timestamp().alias("at")
    bad = out.filter(F.col("_failure").isNotNull()).select(
        *keys, "path", F.lit(run).alias("run"), now, F.lit(FAILED).alias("outcome"),
        F.col("_failure").alias("reason"))
    if open_ is not None:
        # open keys that are done now, or were before a crash kept them from being noted
        done = _read_existing(spark, target_path)
        if done is not None:
            cond = [F.col(k).eqNullSafe(F.col(f"_done_{k}")) for k in keys]
            now_done = open_.join(done.select(*[F.col(k).alias(f"_done_{k}") for k in keys]),
                                  cond, "left_semi")
            bad = bad.unionByName(now_done.select(
                *keys, "path", F.lit(run).alias("run"), now, F.lit(DONE).alias("outcome"),
                F.lit(None).cast("string").alias("reason")))
    # read before the ledger is written: the open keys come from its files
    events = cut_lineage(bad)
    if not events.isEmpty():
        events.write.mode("append").parquet(ledger_path)
    n = out.agg(F.count_if(F.col("_failure").isNull()).alias("good"),
                F.count("_failure").alias("bad")).first()
    return AppendReport(n.good, n.bad)
