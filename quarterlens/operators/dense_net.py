"""Dense network for binary labels: ReLU layers, a logistic output, Adam.

Rows are dealt over mini-batches by a hash of their key and checkpointed once. Steps follow one
another, so what a step costs besides its sums decides how long a fit takes:

* Small mini-batches lie in partitions of a bounded number of consecutive ones. The network and the
  optimiser's state visit the partitions in turn, one job each, and make the steps there.
* A large mini-batch lies in partitions of its own. Each sums the gradients of its rows into one
  vector; the driver adds the vectors up and makes the Adam update.

Numpy works on blocks of rows. As many numbers as the network has parameters come to the driver (from
each partition of a large mini-batch); the data never do.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterlens.session import delete_folder, ensure_checkpoint_dir

# The optimiser's defaults in the reference's library.
RATE, BETA1, BETA2, EPSILON = 0.001, 0.9, 0.999, 1e-7
ROWS_PER_PARTITION = 1_000_000      # of a large mini-batch
ROWS_PER_TURN = 16_384              # of the small mini-batches of one partition


def initial_weights(layers: Sequence[int], seed: int) -> list[list]:
    """(weights, biases) of each layer: uniform within sqrt(6 / (in + out)), biases zero."""
    rng = np.random.default_rng(seed)
    out = []
    for n_in, n_out in zip(layers, layers[1:]):
        limit = math.sqrt(6 / (n_in + n_out))
        out.append([rng.uniform(-limit, limit, (n_in, n_out)), np.zeros(n_out)])
    return out


def forward(weights, x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The input of each layer, and the probability of label 1."""
    held = [x]
    for w, b in weights[:-1]:
        held.append(np.maximum(held[-1] @ w + b, 0.0))
    z = (held[-1] @ weights[-1][0] + weights[-1][1])[:, 0]
    return held, 1 / (1 + np.exp(-z))


def gradient_sums(weights, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sums over rows of the cross-entropy's gradient, flattened layer by layer, then the loss and
    the number of rows."""
    held, p = forward(weights, x)
    delta = (p - y)[:, None]
    parts = []
    for (w, _), a in zip(reversed(weights), reversed(held)):
        parts.append(np.concatenate([(a.T @ delta).ravel(), delta.sum(0)]))
        delta = (delta @ w.T) * (a > 0)
    safe = np.clip(p, 1e-15, 1 - 1e-15)
    loss = -(y * np.log(safe) + (1 - y) * np.log(1 - safe)).sum()
    return np.concatenate([*reversed(parts), [loss, len(y)]])


class Adam:
    """First and second moments of a flat gradient; :meth:`step` returns the update."""

    def __init__(self, size: int, rate: float = RATE) -> None:
        self.rate, self.t = rate, 0
        self.m, self.v = np.zeros(size), np.zeros(size)

    def step(self, g: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = BETA1 * self.m + (1 - BETA1) * g
        self.v = BETA2 * self.v + (1 - BETA2) * g * g
        size = self.rate * math.sqrt(1 - BETA2 ** self.t) / (1 - BETA1 ** self.t)
        return -size * self.m / (np.sqrt(self.v) + EPSILON)


def flat(weights) -> np.ndarray:
    return np.concatenate([np.concatenate([w.ravel(), b]) for w, b in weights])


def shaped(values: np.ndarray, layers: Sequence[int]) -> list[list]:
    out, at = [], 0
    for n_in, n_out in zip(layers, layers[1:]):
        w = values[at:at + n_in * n_out].reshape(n_in, n_out)
        at += n_in * n_out
        out.append([w, values[at:at + n_out]])
        at += n_out
    return out


def batch_of(keys: Sequence[str], batches: int, epoch_seed: int = 0) -> Column:
    """The mini-batch of a row: a hash of its key."""
    return F.pmod(F.xxhash64(F.lit(epoch_seed), *keys), F.lit(batches)).cast("int")


@dataclass
class DenseNet:
    """A fitted network on standardised features (a missing value counts as the mean)."""
    features: list[str]
    mean: list[float]
    deviation: list[float]
    layers: list[int]
    values: list[float]
    losses: list[float]          # mean loss of each step, before its update

    @property
    def weights(self) -> list[list]:
        return shaped(np.array(self.values), self.layers)

    def transform(self, df: DataFrame, out: str = "probability_up") -> DataFrame:
        weights = self.weights

        @F.pandas_udf("double")
        def score(rows: pd.Series) -> pd.Series:
            x = np.stack(rows.to_numpy()) if len(rows) else np.zeros((0, len(weights[0][0])))
            return pd.Series(forward(weights, x)[1])

        return df.withColumn(out, score(_inputs(self.features, self.mean, self.deviation)))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "DenseNet":
        return DenseNet(**json.loads(text))


def _present(name: str) -> Column:
    """The feature as a number, NaN as null."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def _inputs(features: Sequence[str], mean: Sequence[float], deviation: Sequence[float]) -> Column:
    return F.array(*[F.coalesce((_present(f) - F.lit(m)) / F.lit(d), F.lit(0.0))
                     for f, m, d in zip(features, mean, deviation)])


def _scaling(df: DataFrame, features: Sequence[str]) -> tuple[list[float], list[float], int]:
    """Mean and population deviation of each feature (0 and 1 where there is none), and the rows."""
    aggs = [f(_present(c)).alias(f"{n}{i}") for i, c in enumerate(features)
            for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = df.agg(F.count(F.lit(1)).alias("n"), *aggs).first()
    mean = [row[f"m{i}"] or 0.0 for i in range(len(features))]
    return mean, [row[f"s{i}"] or 1.0 for i in range(len(features))], row["n"]


def held_batches(rows: DataFrame, partitions: int) -> RDD:
    """(x, y, batch, at) rows as blocks of a batch's rows, (batch, x, y) with x and y as bytes of
    doubles, checkpointed: the rows of each ``at`` (0 to ``partitions`` - 1) are the partition of
    that number, its batches in order."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            x, y = b.column(0).flatten().to_numpy().reshape(len(b), -1), b.column(1).to_numpy()
            found, first = np.unique(b.column(2).to_numpy(), return_index=True)
            cut = lambda a: pa.array([p.tobytes() for p in np.split(a, first[1:])])
            yield pa.RecordBatch.from_arrays([pa.array(found), cut(x), cut(y)],
                                             names=["batch", "x", "y"])

    ensure_checkpoint_dir(rows.sparkSession)
    held = rows.repartitionById(partitions, "at").select("x", "y", "batch") \
        .sortWithinPartitions("batch").mapInArrow(blocks, "batch int, x binary, y binary") \
        .rdd.map(tuple)
    held.checkpoint()
    held.count()                     # the checkpoint is written after the first job
    return held


def block_sums(weights, blocks: Iterator[tuple[int, bytes, bytes]]) -> np.ndarray:
    """:func:`gradient_sums` over all blocks."""
    total = np.zeros(sum(w.size + b.size for w, b in weights) + 2)
    for _, x, y in blocks:
        y = np.frombuffer(y)
        total += gradient_sums(weights, np.frombuffer(x).reshape(len(y), -1), y)
    return total


@dataclass
class Training:
    """What a step needs and changes: the parameters, the optimiser and the losses so far."""
    layers: list[int]
    values: np.ndarray
    adam: Adam
    losses: list[float]

    def update(self, sums: np.ndarray) -> None:
        """A step with the sums of one mini-batch; none if it has no row."""
        if sums[-1]:
            self.losses.append(float(sums[-2] / sums[-1]))
            self.values = self.values + self.adam.step(sums[:-2] / sums[-1])

    def large_step(self, held: RDD, partitions: Sequence[int]) -> None:
        """The step of the one mini-batch that lies in these partitions."""
        weights = shaped(self.values, self.layers)
        sums = held.context.runJob(held, lambda blocks: [block_sums(weights, blocks)],
                                   list(partitions))
        self.update(np.sum(sums, axis=0))

    def turn(self, held: RDD, partition: int) -> None:
        """A step with each mini-batch of a partition, made where the partition is."""
        now = Training(self.layers, self.values, self.adam, [])

        def steps(blocks: Iterator[tuple[int, bytes, bytes]]) -> list[Training]:
            for _, batch in groupby(blocks, lambda block: block[0]):
                now.update(block_sums(shaped(now.values, now.layers), batch))
            return [now]

        done = held.context.runJob(held, steps, [partition])[0]
        self.values, self.adam = done.values, done.adam
        self.losses.extend(done.losses)


def fit_dense_net(df: DataFrame, features: Sequence[str], keys: Sequence[str],
                  label: str = "label", hidden: Sequence[int] = (20, 40, 20), epochs: int = 1,
                  batch_rows: int = 16, rate: float = RATE, seed: int = 42) -> DenseNet:
    """The network of ``hidden`` ReLU layers, trained by Adam on the mean cross-entropy of
    mini-batches of about ``batch_rows`` rows (rows without a label are not used).

    ``keys`` name a row; they alone decide its batch, so a fit on other partitions has the same
    batches, and weights that differ by the rounding of sums only. An epoch takes the batches in
    order. No row with a label: the initial weights.
    """
    features = list(features)
    spark = df.sparkSession
    rows = df.filter(F.col(label).isNotNull())
    mean, deviation, n = _scaling(rows, features)
    layers = [len(features), *hidden, 1]
    batches = max(1, math.ceil(n / batch_rows))
    parts = max(1, math.ceil(n / batches / ROWS_PER_PARTITION))      # of a mini-batch
    turn = max(1, ROWS_PER_TURN // batch_rows)                       # mini-batches of a partition
    values = flat(initial_weights(layers, seed))
    now = Training(layers, values, Adam(len(values), rate), [])
    if n:
        batch = batch_of(keys, batches)
        part = F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(parts)).cast("int")
        at = (batch / turn).cast("int") if parts == 1 else batch * parts + part
        turns = math.ceil(batches / turn) if parts == 1 else batches
        held = held_batches(rows.select(
            _inputs(features, mean, deviation).alias("x"), F.col(label).cast("double").alias("y"),
            batch.alias("batch"), at.alias("at")), turns * parts)
        try:
            for k in range(epochs * turns):
                first = k % turns * parts
                if parts == 1:
                    now.turn(held, first)
                else:
                    now.large_step(held, range(first, first + parts))
        finally:
            delete_folder(spark, held.getCheckpointFile())
    return DenseNet(features, mean, deviation, layers, now.values.tolist(), now.losses)
