"""Second-order boosted trees for binary labels, as Spark jobs.

Features are cut at quantiles (a sketch, one pass for all of them); after that a row is its bins and
its label, so equal rows are counted once and the loop works on distinct binned rows. A level of a
tree is one job: gradient and hessian sums per (node, feature, bin), their running sums per (node,
feature), the regularised gain of each cut with missing values on either side, and the best cut of
each node. Only that - one row a node - comes to the driver.

Gradients and hessians are summed as fixed-point integers, so sums do not depend on the order of
rows or partitions and a fit gives the same trees on any cluster.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarterlens.session import cut_lineage

FIXED = 1 << 26              # steps per unit of gradient; sums hold 1e11 rows
MISSING_BIN = -1
SKETCH = 10_000              # accuracy of the quantile sketch (rank error 1 / SKETCH)


def quantile_cuts(df: DataFrame, features: Sequence[str], max_bins: int) -> list[list[float]]:
    """For each feature the values at which a new bin begins: its distinct ``max_bins``-quantiles
    without the least. Nulls and NaNs are missing. One aggregate over all features."""
    at = [i / max_bins for i in range(max_bins + 1)]
    present = [F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features]
    row = df.agg(*[F.percentile_approx(c, at, SKETCH).alias(f"_{i}")
                   for i, c in enumerate(present)]).first()
    return [sorted(set(q or []))[1:] for q in row]


def binned(df: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]],
           out: str = "bins") -> DataFrame:
    """``df`` plus an array with the bin of each feature: how many of its cuts are not above the
    value (:data:`MISSING_BIN` if there is none)."""
    from pyspark.ml.feature import Bucketizer

    names = [f"_bin{i}" for i in range(len(features))]
    present = [F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features]
    cut = [n for n, c in zip(names, cuts) if c]
    work = df.withColumns(dict(zip(names, present)))
    if cut:
        work = Bucketizer(splitsArray=[[-math.inf, *c, math.inf] for c in cuts if c],
                          inputCols=cut, outputCols=[f"{n}_" for n in cut],
                          handleInvalid="keep").transform(work)
    found = [F.when(F.col(n).isNull(), MISSING_BIN).otherwise(
        F.col(f"{n}_").cast("int") if c else 0) for n, c in zip(names, cuts)]
    return work.select(*df.columns, F.array(*found).alias(out))


def _constants(values: Sequence[int | float | bool | None]) -> Column:
    """An array of the values, made by one call."""
    said = {float: "{!r}D", int: "{}", bool: "{}", type(None): "NULL"}
    return F.expr(f"array({', '.join(said[type(v)].format(v) for v in values)})")


@dataclass
class Tree:
    """Nodes by number (children of n: 2n + 1, 2n + 2). ``splits``: (feature, bin, missing goes
    left); rows whose bin is below go left. ``leaves``: weights."""
    splits: dict[int, tuple[int, int, bool]] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)

    def place(self, bins: str) -> Column:
        """The node that a row has come to: a walk down from the root by its bins. Splits are looked
        up by node, so the expression does not grow with the levels."""
        if not self.splits:
            return F.lit(0)
        last = max(self.splits)
        feature, at, left = (_constants(c) for c in zip(
            *[self.splits.get(n, (-1, 0, False)) for n in range(2 * last + 3)]))

        def down(n: Column, _: Column) -> Column:
            b = F.get(bins, feature[n])
            goes = F.when(b == MISSING_BIN, left[n]).otherwise(b < at[n])
            return F.when(feature[n] < 0, n).when(goes, 2 * n + 1).otherwise(2 * n + 2)

        return F.aggregate(F.sequence(F.lit(1), F.lit((last + 1).bit_length())), F.lit(0), down)

    def weight(self, node: Column) -> Column:
        return _constants([self.leaves.get(n) for n in range(max(self.leaves) + 1)])[node]


@dataclass
class BoostedTrees:
    """A fitted model: margin = base + rate * sum of leaf weights; probability = logistic."""
    features: list[str]
    cuts: list[list[float]]
    base: float
    rate: float
    trees: list[Tree]

    def transform(self, df: DataFrame, out: str = "probability_up") -> DataFrame:
        """``df`` plus the probability of label 1. All trees are evaluated on Arrow batches."""
        splits = [{n: s for n, s in t.splits.items()} for t in self.trees]
        leaves = [t.leaves for t in self.trees]
        base, rate = self.base, self.rate
        bins = "_bins"
        ready = binned(df, self.features, self.cuts, bins)

        @F.pandas_udf("double")
        def score(rows: pd.Series) -> pd.Series:
            import numpy as np
            x = np.stack(rows.to_numpy()) if len(rows) else np.zeros((0, 1), int)
            margin = np.full(len(x), base)
            for split, leaf in zip(splits, leaves):
                node = np.zeros(len(x), np.int64)
                for n in sorted(split):              # parents come before children
                    feature, at, left = split[n]
                    here = np.flatnonzero(node == n)
                    b = x[here, feature]
                    goes = np.where(b == MISSING_BIN, left, b < at)
                    node[here] = np.where(goes, 2 * n + 1, 2 * n + 2)
                margin += rate * np.array([leaf[n] for n in node.tolist()])
            return pd.Series(1 / (1 + np.exp(-margin)))

        return ready.withColumn(out, score(bins)).drop(bins)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "BoostedTrees":
        d = json.loads(text)
        trees = [Tree({int(n): tuple(s) for n, s in t["splits"].items()},
                      {int(n): w for n, w in t["leaves"].items()}) for t in d.pop("trees")]
        return BoostedTrees(trees=trees, **d)


def with_gradients(rows: DataFrame) -> DataFrame:
    """(w, label, margin) rows plus ``g`` and ``h``: fixed-point sums of the logistic loss's
    gradient and hessian over the ``w`` equal rows that each stands for."""
    p = 1 / (1 + F.exp(-F.col("margin")))
    fixed = lambda c: F.rint(c * FIXED).cast("long") * F.col("w")
    return rows.withColumns({"g": fixed(p - F.col("label")), "h": fixed(p * (1 - p))})


def best_splits(rows: DataFrame, reg_lambda: float, gamma: float, min_child_weight: float
                ) -> DataFrame:
    """The best split of each node of (node, bins, g, h) rows: node, g and h of the node, gain,
    feature, bin, default_left, g_left, h_left. Gain is null where no cut has a gain above
    ``gamma``.

    A cut lies below each bin that the node holds, but for the first. Missing values go to the
    side that gains more (a tie: right). Of equal gains the smallest feature, then the smallest
    bin counts.
    """
    sums = rows.select("node", "g", "h", F.posexplode("bins").alias("feature", "bin")) \
        .groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    per = Window.partitionBy("node", "feature")
    below = per.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    here = F.col("bin") != MISSING_BIN
    unit = lambda c: c / F.lit(float(FIXED))
    cut = sums.select(
        "node", "feature", "bin",
        *[F.sum(c).over(per).alias(f"{c}_all") for c in "gh"],
        *[F.coalesce(F.sum(F.when(here, F.col(c))).over(below), F.lit(0)).alias(f"{c}_low")
          for c in "gh"],
        *[F.coalesce(F.sum(F.when(~here, F.col(c))).over(per), F.lit(0)).alias(f"{c}_gone")
          for c in "gh"],
        F.max(F.when(here, F.lit(True))).over(below).alias("inner"))

    def gain(left: bool) -> Column:
        g, h = ((F.col(f"{c}_low") + F.col(f"{c}_gone") if left else F.col(f"{c}_low"))
                for c in "gh")
        term = lambda a, b: unit(a) * unit(a) / (unit(b) + reg_lambda)
        rest = [F.col("g_all") - g, F.col("h_all") - h]
        value = (term(g, h) + term(*rest) - term(F.col("g_all"), F.col("h_all"))) / 2
        enough = (unit(h) >= min_child_weight) & (unit(rest[1]) >= min_child_weight)
        return F.when(enough & (value > gamma) & here & F.col("inner"), value)

    both = cut.withColumns({"right": gain(False), "left": gain(True)})
    both = both.withColumns({
        "gain": F.greatest("left", "right"),
        "default_left": F.coalesce(F.col("left") > F.coalesce("right", F.lit(-1.0)),
                                   F.lit(False))})
    both = both.withColumns({f"{c}_left": unit(F.col(f"{c}_low") + F.when(
        F.col("default_left"), F.col(f"{c}_gone")).otherwise(0)) for c in "gh"})
    first = F.struct("gain", -F.col("feature"), -F.col("bin"))
    found = ["gain", "feature", "bin", "default_left", "g_left", "h_left"]
    return both.groupBy("node").agg(
        F.max("g_all").alias("g"), F.max("h_all").alias("h"),
        F.max_by(F.struct(*found), F.when(F.col("gain").isNotNull(), first)).alias("b")) \
        .select("node", unit(F.col("g")).alias("g"), unit(F.col("h")).alias("h"),
                *[F.col("b")[c].alias(c) for c in found])


def grow_tree(rows: DataFrame, depth: int, reg_lambda: float, gamma: float,
              min_child_weight: float) -> tuple[Tree, DataFrame]:
    """One tree over rows with ``bins``, ``g``, ``h``, and the rows with their leaf ``node``."""
    tree = Tree()
    live = [0]
    for level in range(depth + 1):
        at = rows.withColumn("node", tree.place("bins"))
        at = at.filter(F.col("node").isin(live)) if level else at
        if level == depth:           # no further cut: only the sums of the last nodes
            found = at.groupBy("node").agg(*[(F.sum(c) / F.lit(float(FIXED))).alias(c)
                                             for c in "gh"]).collect()
            found = [(r.node, r.g, r.h, None) for r in found]
        else:
            found = [(r.node, r.g, r.h, r) for r in
                     best_splits(at, reg_lambda, gamma, min_child_weight).collect()]
        split = []
        for n, g, h, r in found:
            if r is not None and r.gain is not None:
                tree.splits[n] = (r.feature, r.bin, r.default_left)
                split.append(n)
            else:
                tree.leaves[n] = -g / (h + reg_lambda)
        if not split:
            break
        live = [c for n in split for c in (2 * n + 1, 2 * n + 2)]
    return tree, rows.withColumn("node", tree.place("bins"))


def binned_rows(df: DataFrame, features: Sequence[str], label: str,
                cuts: Sequence[Sequence[float]]) -> DataFrame:
    """(bins, label, w): the distinct binned rows with a label, and how many rows each is."""
    named = df.filter(F.col(label).isNotNull()).withColumn("_label", F.col(label).cast("double"))
    return binned(named, features, cuts).groupBy("bins", F.col("_label").alias("label")) \
        .agg(F.count(F.lit(1)).alias("w"))


def fit_boosted_trees(df: DataFrame, features: Sequence[str], label: str = "label",
                      rounds: int = 100, rate: float = 0.02, depth: int = 6, max_bins: int = 256,
                      reg_lambda: float = 1.0, gamma: float = 0.0, min_child_weight: float = 1.0,
                      base_score: float = 0.5) -> BoostedTrees:
    """K5: ``rounds`` trees for a 0 / 1 ``label`` (rows without one are not used).

    The binned rows are checkpointed, and after each round their margins, so a lost executor
    goes back one round at most. No row, or none with a label: a model without trees, which
    gives ``base_score`` to every row.
    """
    features = list(features)
    cuts = quantile_cuts(df.filter(F.col(label).isNotNull()), features, max_bins)
    base = math.log(base_score / (1 - base_score))
    rows = cut_lineage(binned_rows(df, features, label, cuts).withColumn("margin", F.lit(base)))
    model = BoostedTrees(features, cuts, base, rate, [])
    if rows.isEmpty():
        return model
    for k in range(rounds):
        tree, grown = grow_tree(with_gradients(rows), depth, reg_lambda, gamma, min_child_weight)
        model.trees.append(tree)
        if not tree.splits and abs(next(iter(tree.leaves.values()))) < 1e-12:
            break                    # nothing left to learn
        if k + 1 < rounds:
            rows = cut_lineage(grown.select(
                "bins", "label", "w",
                (F.col("margin") + F.lit(rate) * tree.weight(F.col("node"))).alias("margin")))
    return model
