import numpy as np
import pytest

from quarterlens.llm import pq
from tests.llm.helpers import SMALL, components, read

SCHEMA = "vec_id long, embedding array<double>, label int, node string, list int"


def _brute(rows, cosine=0.98):
    usable = [i for i, (_, v, lab) in enumerate(rows)
              if lab is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    pairs = []
    for a in usable:
        for b in usable:
            u, v = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if a < b and rows[a][2] == rows[b][2] and len(u) == len(v) and \
                    u @ v / np.sqrt((u @ u) * (v @ v)) >= cosine:
                pairs.append((a, b))
    label = components(len(rows), pairs)
    least = {}
    for lab, (i, _, _) in zip(label, rows):
        if i is not None:
            least[lab] = min(i, least.get(lab, i))
    degree = [sum(i in p for p in pairs) for i in range(len(rows))]
    return sorted(((i, d, least.get(lab), i == least.get(lab))
                   for (i, _, _), d, lab in zip(rows, degree, label)), key=repr)


def _rows():
    rng = np.random.default_rng(3)
    rows = []
    for c in range(12):
        centre = rng.normal(size=16)
        for _ in range(8):
            rows.append((centre + 0.06 * rng.normal(size=16), c % 3))
    rows += [(rows[0][0], 0)] * 5 + [(rows[0][0], 1)] * 2 + [(rows[0][0] * 3, 0)]
    rows += [(rng.normal(size=16), int(rng.integers(3))) for _ in range(150)]
    out = [(1000 - i, [float(x) for x in v], lab) for i, (v, lab) in enumerate(rows)]
    out += [(1, None, 0), (2, [0.0] * 16, 0), (3, [0.0] * 16, 0), (4, [1.0, None], 0),
            (5, [float("nan")] * 16, 0), (6, out[0][1], None), (7, out[0][1], None),
            (8, [1.0, 1.0], 0), (9, [1.0, 1.01], 0), (10, [], 0), (None, out[0][1], 0),
            (12, [1e200] * 16, 2), (13, [1e-200] * 16, 2), (1000, out[0][1], 0)]
    return out


@pytest.mark.parametrize("block,sample", [(4096, 16384), (3, 40)])
def test_matches_all_pairs(spark, monkeypatch, block, sample):
    monkeypatch.setattr(pq, "BLOCK", block)
    monkeypatch.setattr(pq, "SAMPLE", sample)
    monkeypatch.setattr(pq, "PROBES", 16)
    rows = _rows()
    df = spark.createDataFrame([(*r, "n", 1) for r in rows], SCHEMA)
    got = pq.near_duplicates(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = sorted(map(tuple, got.collect()), key=repr)
    # both versions must see 1e200 and 1e-200 vectors, whose squares leave the range of doubles
    scaled = [(i, [x / max(map(abs, v)) for x in v] if v and None not in v and any(v) else v, lab)
              for i, v, lab in rows]
    assert got == _brute(scaled)


def test_probes_of_a_hot_list_are_cut_too(spark, monkeypatch):
    """No task compares more probes at a time than a block has; all pairs are found, each once."""
    monkeypatch.setattr(pq, "BLOCK", 64)
    monkeypatch.setattr(pq, "PROBE_BLOCK", 64, raising=False)
    monkeypatch.setattr(pq, "BUCKET", 128)
    match = pq._match

    def bounded(*model):
        run = match(*model)

        def one_bucket(refs, probes):
            keys = [c for c in probes.column_names if c not in ("bucket", "node", "vec")]
            for side in (refs, probes):
                sizes = side.group_by(keys).aggregate([("node", "count")])["node_count"]
                assert max(sizes.to_pylist(), default=0) <= 2 * 64, "block too large"
            return run(refs, probes)

        return one_bucket

    monkeypatch.setattr(pq, "_match", bounded)
    rng = np.random.default_rng(4)
    x = np.r_[rng.normal(size=8) + 0.02 * rng.normal(size=(400, 8)), rng.normal(size=(100, 8))]
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    df = spark.createDataFrame([(*r, "n", 1) for r in rows], SCHEMA)
    got = sorted(map(tuple, pq.near_duplicates(df).collect()), key=repr)
    assert got == _brute(rows)


def test_empty(spark):
    assert pq.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_matches_all_pairs(spark):
    from quarterlens.llm.queries import QUERIES

    e = read(SMALL, "embeddings", "vec_id")
    x = np.vstack(e.embedding).astype("f8")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.98) & (e.label.values[:, None] == e.label.values[None])
    np.fill_diagonal(near, False)
    label = components(len(x), zip(*map(list, np.nonzero(near))))
    want = [(int(i), int(n), int(e.vec_id[lab]), bool(e.vec_id[lab] == i))
            for i, n, lab in zip(e.vec_id, near.sum(1), label)]
    assert sorted(map(tuple, QUERIES["op8_pq_near_dedup"](spark, SMALL).collect())) == want


def test_probes_and_codes_are_sufficient():
    """Whatever lies within t of a query is in a probed list and within t + error of the table."""
    rng = np.random.default_rng(8)
    x = pq._unit(rng.normal(size=(800, 12)))
    near = pq._unit(x[:400] + 0.04 * rng.normal(size=(400, 12)))
    coarse, books = pq.fit(x, 3000)
    t = 0.2
    ok = np.sqrt(((near - x[:400]) ** 2).sum(1)) <= t
    home_x, home_n = pq._nearest(x[:400], coarse), pq._nearest(near, coarse)
    probed = set(zip(*map(list, pq._probes(near, home_n, coarse, t))))
    assert ok.sum() > 100 and all((i, home_x[i]) in probed for i in np.flatnonzero(ok))
