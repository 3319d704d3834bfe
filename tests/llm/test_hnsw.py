import math

import numpy as np
import pytest

from quarterlens.llm import hnsw
from tests.llm.helpers import SMALL, nearest, read


def _search(spark, rows, cond="vec_id % 100 = 0", k=10):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, shard string")
    out = {}
    for r in hnsw.nearest(df, F.expr(cond), k).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def test_query_recall_and_scores(spark):
    from quarterlens.llm.queries import QUERIES

    e = read(SMALL, "embeddings", "vec_id")
    ids, x = list(e.vec_id), np.vstack(e.embedding).astype("f8")
    want = nearest(ids, x, [i for i in ids if i % 100 == 0])
    got = {}
    for r in QUERIES["op2_hnsw_nearest"](spark, SMALL).orderBy("query_id", "rank").collect():
        d = math.sqrt(((x[ids.index(r.vec_id)] - x[ids.index(r.query_id)]) ** 2).sum())
        assert r.score == pytest.approx(d, rel=1e-12)
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in want[q]} & set(got[q])) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))


def test_large_graph_recall():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 32))
    x[:600] = x[0] + 0.01 * rng.normal(size=(600, 32))      # a dense clump
    order, graph = hnsw.build(x.astype("f4"), 5)
    v = x[order]
    q = np.r_[x[:20], x[-60:]]
    found = hnsw.search(v, graph, q)
    hits = 0
    for i in range(len(q)):
        d = ((v - q[i]) ** 2).sum(1)
        mine = found[i][found[i] >= 0]
        mine = mine[np.argsort(d[mine])[:11]]
        hits += len(set(mine) & set(np.argsort(d)[:11]))
    assert hits >= 0.95 * 11 * len(q)


def _graph_recall(x, q, k=10):
    order, graph = hnsw.build((x / np.abs(x).max()).astype("f4"), 3)
    v = x[order]
    found, hits = hnsw.search(v, graph, q), 0
    for i in range(len(q)):
        d = ((v - q[i]) ** 2).sum(1)
        mine = found[i][found[i] >= 0]
        hits += len(set(mine[np.argsort(d[mine])[:k]]) & set(np.argsort(d)[:k]))
    return hits / (k * len(q))


@pytest.mark.parametrize("times", [5, 20, 1e9])
def test_recall_of_queries_far_from_all(times):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 32))
    assert _graph_recall(x, times * rng.normal(size=(60, 32))) >= 0.9


def _recall(spark, x):
    ids = list(range(len(x)))
    with np.errstate(over="ignore"):
        want = nearest(ids, x, [i for i in ids if i % 100 == 0])
    got = _search(spark, [(i, v.tolist(), "") for i, v in zip(ids, x)])
    hits = {q: len({i for i, _ in want[q]} & {i for _, i, _ in got[q]}) for q in want}
    return sum(hits.values()) / (10 * len(hits)), hits


def test_recall_with_one_huge_row(spark):
    x = np.random.default_rng(1).normal(size=(4000, 64))
    x[1234] *= 1e24
    assert _recall(spark, x)[0] >= 0.9


def test_recall_of_spread_lengths_and_long_queries(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 64)) * rng.lognormal(0, 3, (4000, 1))
    assert _recall(spark, x)[0] >= 0.9
    y = rng.normal(size=(4000, 64))
    y[::100] *= 20
    # to these all other rows are equally far in double precision: ties, which no search finds
    y[::500] *= 1e30
    hits = _recall(spark, y)[1]
    others = [n for q, n in hits.items() if q % 500]
    assert sum(others) >= 0.9 * 10 * len(others)


def test_repeats_ties_and_unusable_vectors(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same, "s") for i in range(0, 300, 3)]
    rows += [(500, [1.0, 2.0, 4.0], "s"), (501, [9.0, 9.0, 9.0], "s"), (501, [9.0, 9.0, 9.0], "s")]
    rows += [(600, None, None), (700, [0.0, 0.0, 0.0], None), (800, [1.0, None, 1.0], None),
             (900, [1.0, float("nan"), 1.0], None), (1000, [], None), (None, same, None),
             (1100, [1.0, 2.0], "d"), (1101, [1.0, 2.5], "d"),
             (1200, [1.0, float("inf"), 2.0], None)]
    got = _search(spark, rows)
    assert set(got) == {0, 500, 1100}
    assert got[0] == [(r, 3 * r, 0.0) for r in range(1, 11)]
    assert got[500] == [(r, 3 * (r - 1), 1.0) for r in range(1, 11)]
    assert got[1100] == [(1, 1101, 0.5)]


def test_fewer_candidates_than_k_and_empty(spark):
    got = _search(spark, [(0, [1.0], ""), (7, [3.0], ""), (9, [2.0], "")])
    assert got == {0: [(1, 9, 1.0), (2, 7, 2.0)]}
    assert _search(spark, [(0, [1.0], "")]) == {}
    assert _search(spark, []) == {}
