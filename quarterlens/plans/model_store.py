"""Fitted models by what they were fitted on.

A model's name is a fingerprint of its training rows and parameters: other rows or parameters are
another model, the same ones are loaded instead of fitted. A model is written to a folder of its
own; what publishes it is a small pointer file that comes last, put in place by one rename. Without
a whole pointer a model does not exist, however much of its folder was written.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlens.plans.training import load_model, save_model
from quarterlens.session import delete_folder, ensure_checkpoint_dir


def fingerprint(rows: DataFrame, params: dict[str, Any]) -> str:
    """A hash of the rows as a bag (their order and partitions do not matter, their number does),
    of column names and types, and of the parameters. One aggregate."""
    columns = sorted(rows.columns)
    names = [f"`{c}`" for c in columns]
    # two independent 64-bit hashes; sums, as equal rows would cancel out of an exclusive or
    sums = [F.sum(F.xxhash64(F.lit(seed), *names).cast("decimal(38,0)")).alias(f"h{seed}")
            for seed in (0, 1)]
    found = rows.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    said = json.dumps([[c, rows.schema[c].dataType.simpleString()] for c in columns]) + \
        json.dumps(params, sort_keys=True, default=str) + str([str(x) for x in found])
    return hashlib.sha256(said.encode()).hexdigest()


def save_text(model: Any, path: str, spark: SparkSession) -> None:
    """For models with ``to_json``."""
    spark.createDataFrame([(model.to_json(),)], "model string").coalesce(1).write.text(path)


def load_text(path: str, spark: SparkSession) -> str:
    return spark.read.text(path, wholetext=True).first()[0].rstrip("\n")


@dataclass
class ModelStore:
    """Models below ``root`` (a folder that driver and executors share)."""
    spark: SparkSession
    root: str

    @staticmethod
    def of_session(spark: SparkSession) -> "ModelStore":
        return ModelStore(spark, f"{ensure_checkpoint_dir(spark)}/models")

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _pointer(self, name: str, key: str) -> str:
        return f"{self.root}/{name}-{key}.json"

    def folder(self, name: str, key: str) -> str | None:
        """The folder of a published model; None if there is none."""
        fs, at = self._fs(self._pointer(name, key))
        if not fs.exists(at):
            return None
        source = fs.open(at)
        try:
            raw = bytes(source.readAllBytes())
        finally:
            source.close()
        try:
            said = json.loads(raw)
        except ValueError:           # not whole: not published
            return None
        return said["folder"] if said.get("key") == key else None

    def publish(self, name: str, key: str, folder: str) -> None:
        """Point to a folder that is written; one rename makes it the model."""
        fs, at = self._fs(self._pointer(name, key))
        _, draft = self._fs(f"{self.root}/.{name}-{uuid.uuid4()}")
        out = fs.create(draft)
        out.write(bytearray(json.dumps({"key": key, "folder": folder}).encode()))
        out.close()
        if fs.exists(at) and self.folder(name, key) is None:
            fs.delete(at, False)                 # a pointer that is not whole
        if fs.exists(at) or not fs.rename(draft, at):
            fs.delete(draft, False)              # another run was first: its model is the same

    def get_or_fit(self, name: str, rows: DataFrame, params: dict[str, Any],
                   fit: Callable[[], Any], save: Callable[[Any, str], None] = save_model,
                   load: Callable[[str], Any] = load_model) -> Any:
        """The model of these rows and parameters: loaded if it is published, else fitted, saved,
        published and loaded. A run that dies before it publishes leaves a folder that no one
        reads; one that fails deletes it."""
        key = fingerprint(rows, params)
        folder = self.folder(name, key)
        if folder is None:
            folder = f"{self.root}/{name}-{key[:16]}-{uuid.uuid4()}"
            try:
                save(fit(), folder)
            except BaseException:
                delete_folder(self.spark, folder)
                raise
            self.publish(name, key, folder)
            folder = self.folder(name, key) or folder
        return load(folder)
