"""K5: boosted trees against a plain version, and the first round against SQL."""

import math
import random

import duckdb
import pytest

from quarterlens.operators import boosting as B
from quarterlens.plans.registry import ORACLE, QUERIES, load_all
from tests.conftest import SF_ORACLE, SF_SMALL, rows


def _none(v):
    return v is None or v != v


def plain_cuts(values, max_bins):
    v = sorted(x for x in values if not _none(x))
    if not v:
        return []
    return sorted({v[max(1, math.ceil(i / max_bins * len(v))) - 1] for i in range(max_bins + 1)})[1:]


def plain_fit(data, labels, rounds, rate, depth, max_bins, lam=1.0, gamma=0.0, mcw=1.0, base=0.0):
    """Splits and leaves of each tree, and the margins, by loops over rows."""
    k = len(data[0])
    cuts = [plain_cuts([r[f] for r in data], max_bins) for f in range(k)]
    bins = [[-1 if _none(x) else sum(c <= x for c in cuts[f]) for f, x in enumerate(r)] for r in data]
    margin = [base] * len(data)
    trees = []
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        grad = [round((a - y) * B.FIXED) for a, y in zip(p, labels)]
        hess = [round(a * (1 - a) * B.FIXED) for a in p]
        node = [0] * len(data)
        splits, leaves, live = {}, {}, [0]
        for level in range(depth + 1):
            new = []
            for n in live:
                at = [i for i, x in enumerate(node) if x == n]
                total = (sum(grad[i] for i in at), sum(hess[i] for i in at))
                best = None
                for f in range(k if level < depth else 0):
                    seen = sorted({bins[i][f] for i in at} - {-1})
                    for b in seen[1:]:
                        for left in (False, True):
                            low = [i for i in at if (bins[i][f] == -1 and left)
                                   or (bins[i][f] != -1 and bins[i][f] < b)]
                            g = sum(grad[i] for i in low) / B.FIXED
                            h = sum(hess[i] for i in low) / B.FIXED
                            g2, h2 = (total[0] / B.FIXED - g), (total[1] / B.FIXED - h)
                            if h < mcw or h2 < mcw:
                                continue
                            gain = (g * g / (h + lam) + g2 * g2 / (h2 + lam)
                                    - (total[0] / B.FIXED) ** 2 / (total[1] / B.FIXED + lam)) / 2
                            if gain > gamma and (best is None or gain > best[0] + 1e-12):
                                best = (gain, f, b, left)
                if best:
                    splits[n] = best[1:]
                    for i in at:
                        b = bins[i][best[1]]
                        goes = best[3] if b == -1 else b < best[2]
                        node[i] = 2 * n + 1 if goes else 2 * n + 2
                    new += [2 * n + 1, 2 * n + 2]
                else:
                    leaves[n] = -(total[0] / B.FIXED) / (total[1] / B.FIXED + lam)
            live = new
        trees.append((splits, leaves))
        margin = [m + rate * leaves[n] for m, n in zip(margin, node)]
    return cuts, trees, margin


def _data(n=400, seed=3):
    rng = random.Random(seed)
    data, labels = [], []
    for _ in range(n):
        x = rng.choice([None, float("nan"), round(rng.gauss(0, 1), 2), round(rng.gauss(0, 1), 2)])
        y, z, c = round(rng.random(), 3), rng.choice([0.0, 1.0]), 5.0
        up = (0.9 if _none(x) else x) + 2 * z * y > 0.7
        data.append((x, y, z, c))
        labels.append(int(up) if rng.random() < 0.9 else int(not up))
    return data, labels


@pytest.mark.parametrize("depth,max_bins,parts", [(3, 16, 1), (2, 256, 7)])
def test_equals_the_plain_version(spark, depth, max_bins, parts):
    data, labels = _data()
    df = spark.createDataFrame([(*r, y) for r, y in zip(data, labels)],
                               "x double, y double, z double, c double, label int").repartition(parts)
    model = B.fit_boosted_trees(df, ["x", "y", "z", "c"], rounds=4, rate=0.3, depth=depth,
                                max_bins=max_bins)
    cuts, trees, margin = plain_fit(data, labels, 4, 0.3, depth, max_bins)
    assert model.cuts == cuts
    for got, (splits, leaves) in zip(model.trees, trees, strict=True):
        assert got.splits == splits
        assert got.leaves == pytest.approx(leaves, abs=1e-9)
    want = sorted(1 / (1 + math.exp(-m)) for m in margin)
    assert sorted(r[0] for r in rows(model.transform(df), "probability_up")) == pytest.approx(want, abs=1e-9)
    assert B.BoostedTrees.from_json(model.to_json()) == model


def test_deep_trees_equal_the_plain_version_and_keep_plans_small(spark):
    data, labels = _data(600, 5)
    df = spark.createDataFrame([(*r, y) for r, y in zip(data, labels)],
                               "x double, y double, z double, c double, label int")
    cuts, trees, _ = plain_fit(data, labels, 1, 0.3, 6, 64, mcw=0.1)
    model = B.fit_boosted_trees(df, ["x", "y", "z", "c"], rounds=1, depth=6, max_bins=64,
                                min_child_weight=0.1)
    (splits, leaves), tree = trees[0], model.trees[0]
    assert max(splits) >= 31 and tree.splits == splits       # splits on the last level
    assert tree.leaves == pytest.approx(leaves, abs=1e-9)
    # a row's node is looked up: one read of its bins, tested and compared, whatever the splits
    placed = B.binned(df, model.features, model.cuts).select(tree.place("bins").alias("node"))
    assert placed._jdf.queryExecution().analyzed().expressions().toString().count("bins#") == 2
    assert {r.node for r in placed.collect()} == set(leaves)


def test_fits_do_not_depend_on_partitions(spark):
    data, labels = _data(300, 9)
    df = spark.createDataFrame([(*r, y) for r, y in zip(data, labels)],
                               "x double, y double, z double, c double, label int")
    fit = lambda d: B.fit_boosted_trees(d, ["x", "y", "z"], rounds=3, depth=3).to_json()
    assert fit(df.repartition(1)) == fit(df.repartition(9).orderBy("y"))


def test_missing_goes_where_it_gains(spark):
    df = spark.createDataFrame([(None, 1)] * 40 + [(1.0, 1)] * 40 + [(0.0, 0)] * 80, "x double, label int")
    up = B.fit_boosted_trees(df, ["x"], rounds=1, depth=1)
    assert up.trees[0].splits == {0: (0, 1, False)}
    down = B.fit_boosted_trees(df.selectExpr("-x AS x", "label"), ["x"], rounds=1, depth=1)
    assert down.trees[0].splits == {0: (0, 1, True)}


def test_no_rows_and_one_class(spark):
    empty = spark.createDataFrame([], "x double, label int")
    model = B.fit_boosted_trees(empty, ["x"], rounds=2)
    assert model.trees == []
    some = spark.createDataFrame([(1.0, None), (None, None)], "x double, label int")
    assert rows(model.transform(some), "probability_up") == [(0.5,), (0.5,)]
    ones = spark.createDataFrame([(float(i), 1) for i in range(50)], "x double, label int")
    model = B.fit_boosted_trees(ones, ["x"], rounds=2, depth=2)
    assert all(not t.splits for t in model.trees) and model.trees[0].leaves[0] > 0


@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
def test_first_round_matches_sql(spark, sf):
    import os
    load_all()
    con = duckdb.connect()
    for t in os.listdir(sf):
        con.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{t}'")
    got = QUERIES["boosted_first_round"](spark, sf)
    want = con.execute(ORACLE["boosted_first_round"])
    at = [d[0] for d in want.description]
    assert sorted(at) == sorted(got.columns)
    assert sorted(map(str, rows(got, *at))) == sorted(str(tuple(r)) for r in want.fetchall())


def test_query_equals_the_plain_version(spark):
    from quarterlens.operators.features import hash_split
    from quarterlens.plans import q_features as Q

    load_all()
    all_rows = hash_split(Q.training_rows(spark, SF_SMALL), ["ticker", "quarter"]).collect()
    industries = sorted({r.industry for r in all_rows if r.split == "train"} - {None})
    def feats(r):  # noqa: E306
        one = lambda ok: 1.0 if ok else 0.0
        return [r.net_sentiment, None if r.neutral_dominance is None else one(r.neutral_dominance),
                *[one(r.q_num == str(q)) for q in (1, 2, 3, 4)],
                *[one(r.industry == i) for i in industries]]
    train = [r for r in all_rows if r.split == "train" and r.label is not None]
    cuts, trees, _ = plain_fit([feats(r) for r in train], [r.label for r in train],
                               Q.BOOST["rounds"], Q.BOOST["rate"], Q.BOOST["depth"],
                               Q.BOOST["max_bins"])
    def score(r):  # noqa: E306
        m = 0.0
        x = [-1 if _none(v) else sum(c <= v for c in cuts[f]) for f, v in enumerate(feats(r))]
        for splits, leaves in trees:
            n = 0
            while n in splits:
                f, b, left = splits[n]
                n = 2 * n + (1 if (left if x[f] == -1 else x[f] < b) else 2)
            m += Q.BOOST["rate"] * leaves[n]
        return 1 / (1 + math.exp(-m))
    want = sorted((r.ticker, r.quarter, r.split, round(score(r), 6)) for r in all_rows)
    got = sorted(rows(QUERIES["boosted_trees"](spark, SF_SMALL), "ticker", "quarter", "split", "probability_up"))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=2e-6)
