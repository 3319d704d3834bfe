import pytest

from quarterlens.llm import mixing
from tests.llm.helpers import SMALL, oracle


def _water(sizes, weights, cap=3.0):
    """Targets by repeated resharing of what lies above the caps."""
    target, free, left = {}, dict(zip(sizes, weights)), float(sum(sizes.values()))
    while free:
        level = left / sum(free.values())
        over = [s for s in free if level * free[s] >= cap * sizes[s]]
        if not over:
            target.update({s: level * w for s, w in free.items()})
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            del free[s]
    return target


@pytest.mark.parametrize("sizes", [
    [100, 100, 100], [1, 1000, 5, 3000, 10, 10, 0], [0, 0, 7], [10, 20, 30, 40, 500, 1, 2, 3]])
def test_targets_match_resharing(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
    df = spark.createDataFrame(list(zip(names, sizes)), "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = _water(dict(zip(names, sizes)), [(5, 2, 1)[i % 3] for i in range(len(sizes))])
    assert got == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(sum(sizes))


def test_query_matches_sql(spark):
    from quarterlens.llm.queries import QUERIES

    got = sorted(map(tuple, QUERIES["op5_source_mix"](spark, SMALL).collect()))
    want = sorted(oracle(mixing.SQL, SMALL, "documents"))
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])


def test_copies_nulls_repeats_and_clashing_columns(spark):
    rows = [(i, "w " * (1 + i % 9), "abc"[i % 3] if i % 7 else None) for i in range(3000)]
    rows += [(None, None, None), (1, "", "a"), (2, None, "b"), (7, "x y", None), (7, "x y", None)]
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows],
                               "doc_id long, text string, source string, size int, rate double")
    plan = mixing.plan(df.drop("size")).collect()
    share, size = {}, {}
    for r in plan:
        assert 0 <= r["copies"] <= 3 and r["size"] == len((r["text"] or "").split())
        share.setdefault(r["source"], r["target"])
        size[r["source"]] = size.get(r["source"], 0) + r["size"] * r["copies"]
    assert len(plan) == len(rows)
    for s in share:
        assert size[s] == pytest.approx(share[s], rel=0.1)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    # as many copies of each row as planned, in any run
    assert mixed.count() == sum(r["copies"] for r in plan) == mixing.mix(df).count()
    assert len({r["copies"] for r in plan if r["doc_id"] == 7 and r["text"] == "x y"}) == 1


def test_empty_and_wordless(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(1, "", "a"), (2, None, "b")], schema)
    assert [r.target for r in mixing.plan(df).collect()] == [0.0, 0.0]
    assert mixing.mix(df).count() == 0


def test_large_rates_are_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", 0)
    df = spark.createDataFrame([(i, "a b", str(i % 5)) for i in range(50)],
                               "doc_id long, text string, source string")
    assert mixing.plan(df).count() == 50
