"""The network against a single-process version on the same batches."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterlens.operators import dense_net as D
from quarterlens.plans.registry import QUERIES, load_all
from quarterlens.session import ensure_checkpoint_dir
from tests.conftest import SF_SMALL, rows


def plain_fit(data, labels, batch, n_batches, layers, epochs, rate, seed):
    """One process, one row at a time, every derivative written out."""
    x = np.array([[math.nan if v is None else v for v in r] for r in data], float)
    mean = np.nan_to_num(np.nanmean(x, 0))
    dev = np.nanstd(x, 0)
    dev = np.where((dev == 0) | np.isnan(dev), 1.0, dev)
    x = np.nan_to_num((x - mean) / dev, nan=0.0)
    net = D.initial_weights(layers, seed)
    m = [[np.zeros_like(w), np.zeros_like(b)] for w, b in net]
    v = [[np.zeros_like(w), np.zeros_like(b)] for w, b in net]
    t = 0
    for step in range(epochs * n_batches):
        at = [i for i in range(len(labels)) if batch[i] == step % n_batches]
        if not at:
            continue
        t += 1
        grad = [[np.zeros_like(w), np.zeros_like(b)] for w, b in net]
        for i in at:
            a, before = [x[i]], []
            for k, (w, b) in enumerate(net):
                z = a[-1] @ w + b
                before.append(z)
                a.append(np.maximum(z, 0) if k < len(net) - 1 else 1 / (1 + np.exp(-z)))
            back = a[-1] - labels[i]
            for k in range(len(net) - 1, -1, -1):
                grad[k][0] += np.outer(a[k], back)
                grad[k][1] += back
                if k:
                    back = (net[k][0] @ back) * (before[k - 1] > 0)
        for k in range(len(net)):
            for j in (0, 1):
                g = grad[k][j] / len(at)
                m[k][j] = 0.9 * m[k][j] + 0.1 * g
                v[k][j] = 0.999 * v[k][j] + 0.001 * g * g
                net[k][j] = net[k][j] - rate * math.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t) * \
                    m[k][j] / (np.sqrt(v[k][j]) + 1e-7)
    return mean, dev, net


def plain_score(net, mean, dev, row):
    a = np.nan_to_num((np.array([math.nan if v is None else v for v in row], float) - mean) / dev, nan=0.0)
    for w, b in net[:-1]:
        a = np.maximum(a @ w + b, 0)
    return float(1 / (1 + np.exp(-(a @ net[-1][0] + net[-1][1])[0])))


def _frame(spark, n=240):
    rng = np.random.default_rng(1)
    made = []
    for i in range(n):
        x, y = rng.normal(), rng.normal()
        made.append((i, None if i % 11 == 0 else float("nan") if i % 13 == 0 else float(x), float(y), 3.0,
                     None if i % 17 == 0 else int(x + y * y > 0.5)))
    return spark.createDataFrame(made, "id int, x double, y double, c double, label int")


def test_weights_equal_the_single_process_version(spark):
    df = _frame(spark)
    model = D.fit_dense_net(df.repartition(5), ["x", "y", "c"], ["id"], hidden=(6, 5), epochs=3,
                            batch_rows=40, rate=0.01, seed=7)
    n_batches = math.ceil(df.filter("label IS NOT NULL").count() / 40)
    used = df.filter("label IS NOT NULL").withColumn("b", D.batch_of(["id"], n_batches)).collect()
    data = [[None if v is None or v != v else v for v in (r.x, r.y, r.c)] for r in used]
    mean, dev, net = plain_fit(data, [r.label for r in used], [r.b for r in used], n_batches,
                               [3, 6, 5, 1], 3, 0.01, 7)
    assert model.mean == pytest.approx(mean.tolist()) and model.deviation == pytest.approx(dev.tolist())
    assert np.allclose(model.values, D.flat(net), rtol=0, atol=1e-9)
    assert len(model.losses) == 3 * n_batches and model.losses[-1] < model.losses[0]
    got = {r.id: r.probability_up for r in model.transform(df).collect()}
    for r in df.collect():
        row = [None if v is None or v != v else v for v in (r.x, r.y, r.c)]
        assert got[r.id] == pytest.approx(plain_score(net, mean, dev, row), abs=1e-9)
    again = D.DenseNet.from_json(model.to_json())
    assert again == model
    other = D.fit_dense_net(df.repartition(1), ["x", "y", "c"], ["id"], hidden=(6, 5), epochs=3,
                            batch_rows=40, rate=0.01, seed=7)
    assert np.allclose(model.values, other.values, rtol=0, atol=1e-9)


@pytest.mark.parametrize("per_partition,per_turn", [(1_000_000, 16_384), (1_000_000, 100), (9, 1)])
def test_steps_in_turns_and_large_batches_are_the_same_steps(spark, monkeypatch, per_partition, per_turn):
    df = _frame(spark).filter("label IS NOT NULL")
    n_batches = math.ceil(df.count() / 40)
    used = df.withColumn("b", D.batch_of(["id"], n_batches)).collect()
    data = [[None if v is None or v != v else v for v in (r.x, r.y, r.c)] for r in used]
    _, _, net = plain_fit(data, [r.label for r in used], [r.b for r in used], n_batches,
                          [3, 6, 5, 1], 2, 0.01, 7)
    monkeypatch.setattr(D, "ROWS_PER_PARTITION", per_partition)
    monkeypatch.setattr(D, "ROWS_PER_TURN", per_turn)
    model = D.fit_dense_net(df, ["x", "y", "c"], ["id"], hidden=(6, 5), epochs=2, batch_rows=40,
                            rate=0.01, seed=7)
    assert np.allclose(model.values, D.flat(net), rtol=0, atol=1e-9)
    assert len(model.losses) == 2 * n_batches
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    assert not [f for f in os.listdir(folder) if f.startswith("batches-")]


def test_small_steps_need_no_job_each(spark):
    sc = spark.sparkContext
    sc.setJobGroup("net-steps", "")
    try:
        model = D.fit_dense_net(_frame(spark), ["x", "y"], ["id"], hidden=(4,), epochs=2, batch_rows=4)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(model.losses) > 90
    assert len(sc.statusTracker().getJobIdsForGroup("net-steps")) < 20


def test_a_step_reads_its_batch_only(spark, tmp_path):
    df = _frame(spark).selectExpr("array(y, c) AS x", "1.0D AS y", "id % 4 AS batch")
    path = str(tmp_path / "b")
    df.write.partitionBy("batch").parquet(path)
    plan = spark.read.schema("x array<double>, y double, batch int").parquet(path) \
        .filter(F.col("batch") == 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan


def test_no_rows_and_nothing_left_behind(spark):
    df = _frame(spark).withColumn("label", F.lit(None).cast("int"))
    model = D.fit_dense_net(df, ["x", "y"], ["id"], hidden=(4,))
    assert model.losses == [] and model.values == D.flat(D.initial_weights([2, 4, 1], 42)).tolist()
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    assert not [f for f in os.listdir(folder) if f.startswith("batches-")]


def test_query_equals_the_single_process_version(spark):
    from quarterlens.operators.features import hash_split
    from quarterlens.plans import q_features as Q

    load_all()
    h = hash_split(Q.training_rows(spark, SF_SMALL), ["ticker", "quarter"])
    featured, names, _ = Q.boost_features(h.filter(F.col("split") == "train"), h)
    keys = ["ticker", "quarter", "net_sentiment", "neutral_dominance"]
    n = featured.filter("split = 'train' AND label IS NOT NULL").count()
    n_batches = math.ceil(n / Q.NET["batch_rows"])
    all_rows = featured.withColumn("b", D.batch_of(keys, n_batches)).collect()
    used = [r for r in all_rows if r.split == "train" and r.label is not None]
    mean, dev, net = plain_fit([[r[c] for c in names] for r in used], [r.label for r in used],
                               [r.b for r in used], n_batches, [len(names), 20, 40, 20, 1],
                               Q.NET["epochs"], Q.NET["rate"], 42)
    want = sorted((r.ticker, r.quarter, r.split, plain_score(net, mean, dev, [r[c] for c in names]))
                  for r in all_rows)
    got = sorted(rows(QUERIES["dense_net"](spark, SF_SMALL), "ticker", "quarter", "split", "probability_up"))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=2e-6)
