"""Session construction and cluster-safe lineage cutting."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package relies on: adaptive execution re-plans joins
# from runtime sizes, splits skewed shuffle partitions and coalesces small ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # small Arrow batches keep model-scoring memory flat
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    # Python call sites in error messages cost a JVM round trip per column operation
    # while a plan is built (Spark documents the overhead); plans here are long.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # checkpoint files of frames that are no longer used are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "quarterlens", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster ``master`` stays None so spark-submit decides; tests pass
    ``local[*]``. The shuffle partition count should be sized so one partition
    stays well below executor memory at the target scale (about 128-256 MB of
    shuffle data each); AQE coalesces it down for small inputs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster setting always wins. Only when it is unset and the master is local (tests, a
    laptop) do we set one ourselves, from ``fallback`` or a folder under the working directory;
    on a cluster that would be a folder of the driver alone, so it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    target = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not target:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        target = fallback or os.path.join(os.getcwd(), "checkpoints")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that a job of ours wrote, on whichever file system it lies."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
