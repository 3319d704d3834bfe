import datetime as dt
import random

import pytest

from quarterlens.operators.asof import asof_join
from tests.conftest import rows

BASE = dt.datetime(2024, 1, 1)


def _brute(L, R, direction, exact, tol):
    out = {}
    for (i, k, t) in L:
        c = [(rt, rid) for (rid, rk, rt, _v) in R if rk is not None and rk == k and (
            (rt < t or (exact and rt == t)) if direction == "backward" else (rt > t or (exact and rt == t)))]
        if tol is not None:
            c = [x for x in c if abs(x[0] - t) <= tol]
        if not c:
            out[i] = None
        elif direction == "backward":
            out[i] = max(c)[1]
        else:
            out[i] = min(c, key=lambda x: (x[0], -x[1]))[1]
    return out


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(11)
    L = [(i, rnd.randint(0, 3), BASE + dt.timedelta(hours=rnd.randint(0, 24 * 50))) for i in range(250)]
    L += [(1000 + i, L[i][1], L[i][2]) for i in range(10)]                     # duplicated left rows
    R = [(j, rnd.randint(0, 3), BASE + dt.timedelta(hours=rnd.randint(0, 24 * 50)),
          None if j % 5 == 0 else float(j)) for j in range(200)]
    R += [(5000 + j, R[j][1], R[j][2], 1.0) for j in range(10)]               # equal right times
    R += [(9000, None, BASE, 1.0)]                                             # null key never matches
    return (L, R, spark.createDataFrame(L, "id long, k int, lt timestamp"),
            spark.createDataFrame(R, "rid long, k int, rt timestamp, v double"))


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("tol", [None, dt.timedelta(days=2)])
@pytest.mark.parametrize("width", [None, dt.timedelta(hours=9), dt.timedelta(days=3)])
def test_matches_brute_force(data, direction, exact, tol, width):
    L, R, ldf, rdf = data
    res = asof_join(ldf, rdf, ["k"], "lt", "rt", direction, exact, tol, "rid", width)
    got = dict(rows(res, "id", "rid"))
    assert len(got) == len(L) and res.count() == len(L)
    assert got == _brute(L, R, direction, exact, tol)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("tol", [None, dt.timedelta(days=2)])
def test_split_groups_match_brute_force(data, direction, exact, tol):
    """A small target splits nearly every bucket; results stay exact."""
    L, R, ldf, rdf = data
    res = asof_join(ldf, rdf, ["k"], "lt", "rt", direction, exact, tol, "rid", max_group_rows=5)
    got = dict(rows(res, "id", "rid"))
    assert len(got) == len(L) and res.count() == len(L)
    assert got == _brute(L, R, direction, exact, tol)


def _burst(spark, n=3000):
    """A third of all rows is one key within one day, a part of that at one instant."""
    rnd = random.Random(5)
    L, R = [], []
    for i in range(n):
        day = dt.timedelta(days=rnd.randint(0, 50), seconds=rnd.randint(0, 86000))
        t = BASE + (dt.timedelta(days=20, seconds=rnd.randint(0, 40000)) if i % 3 == 0 else day)
        if i % 15 == 0:
            t = BASE + dt.timedelta(days=20, seconds=777)
        L.append((i, 7 if i % 3 == 0 else i % 11 + 100, t))
    for j in range(n):
        t = BASE + (dt.timedelta(days=20, seconds=rnd.randint(0, 40000)) if j % 3 == 0 else
                    dt.timedelta(days=rnd.randint(0, 50)))
        if j % 15 == 0:
            t = BASE + dt.timedelta(days=20, seconds=777)
        R.append((j, 7 if j % 3 == 0 else j % 11 + 100, t, float(j)))
    return (L, R, spark.createDataFrame(L, "id long, k int, lt timestamp"),
            spark.createDataFrame(R, "rid long, k int, rt timestamp, v double"))


@pytest.mark.parametrize("direction, exact, tol", [
    ("backward", True, None), ("backward", False, dt.timedelta(hours=3)), ("forward", True, None),
    ("forward", False, dt.timedelta(days=1))])
def test_burst_at_one_instant_matches_brute_force(spark, direction, exact, tol):
    L, R, ldf, rdf = _burst(spark, 900)
    res = asof_join(ldf, rdf, ["k"], "lt", "rt", direction, exact, tol, "rid", max_group_rows=20)
    assert dict(rows(res, "id", "rid")) == _brute(L, R, direction, exact, tol)


def test_no_window_partition_exceeds_the_target(spark):
    """The left rows of every window partition stay within the target, bursts included."""
    from pyspark.sql import functions as F

    from quarterlens.operators import asof

    _L, _R, ldf, rdf = _burst(spark)
    target = 150
    units = lambda df, t: df.select("k", asof.time_units(df, t).alias("_n"),
                                    F.struct(*df.columns).alias("_l"))
    l, r = units(ldf, "lt"), units(rdf, "rt")
    bucket = lambda x: F.floor(x / F.lit(30 * asof.MICROS_PER_DAY)).cast("long")
    assert l.select("k", "_n").union(r.select("k", "_n")).groupBy("k", bucket(F.col("_n"))).count().agg(F.max("count")).first()[0] > 1900
    cuts, deals = asof._splits(l, r, ["k"], bucket, target)
    left = asof._placed(l, ["k"], bucket, cuts)
    left = asof._dealt(left, ["k"], deals, F.pmod(F.xxhash64("_l"), F.coalesce("_m", F.lit(1))).cast("int"))
    assert left.groupBy("k", "_b", "_deal").count().agg(F.max("count")).first()[0] <= 1.4 * target
    best = asof._placed(r, ["k"], bucket, cuts).select("k", "_b", "_n").distinct()
    assert best.groupBy("k", "_b").count().agg(F.max("count")).first()[0] <= target


def test_unbounded_join_scans_each_side_once(spark, tmp_path):
    import contextlib
    import io

    _L, _R, ldf, rdf = _burst(spark, 300)
    ldf.write.parquet(str(tmp_path / "l"))
    rdf.write.parquet(str(tmp_path / "r"))
    out = asof_join(spark.read.parquet(str(tmp_path / "l")), spark.read.parquet(str(tmp_path / "r")),
                    ["k"], "lt", "rt")
    out.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    final = buf.getvalue().split("Initial Plan")[0]
    assert final.count("FileScan parquet") == 2


def test_boundaries_and_null_payload(spark):
    t0 = dt.datetime(2024, 3, 31, 16, 0)
    left = spark.createDataFrame([(1, "A", t0), (2, "A", t0 + dt.timedelta(microseconds=1)), (3, "Z", t0)],
                                 "id int, k string, lt timestamp")
    right = spark.createDataFrame([("A", t0 - dt.timedelta(days=7), 10.0),
                                   ("A", t0 - dt.timedelta(days=8), 20.0)], "k string, rt timestamp, v double")
    got = {r["id"]: (r["rt"], r["v"]) for r in asof_join(left, right, ["k"], "lt", "rt", tolerance=dt.timedelta(days=7)).collect()}
    assert got[1] == (t0 - dt.timedelta(days=7), 10.0)      # exactly 7 days: inside
    assert got[2] == (None, None)                            # 7 days + 1 microsecond: outside
    assert got[3] == (None, None)                            # key without right rows
    # A null value in the nearest row stays null (the older row's value does not leak).
    right2 = spark.createDataFrame([("A", t0 - dt.timedelta(days=1), None),
                                    ("A", t0 - dt.timedelta(days=2), 5.0)], "k string, rt timestamp, v double")
    r = asof_join(left.filter("id = 1"), right2, ["k"], "lt", "rt").first()
    assert r["rt"] == t0 - dt.timedelta(days=1) and r["v"] is None


def test_dates_strict_and_forward(spark):
    d = dt.date(2024, 1, 10)
    left = spark.createDataFrame([(1, "A", d)], "id int, k string, ld date")
    right = spark.createDataFrame([("A", d, 1.0), ("A", d - dt.timedelta(days=5), 2.0),
                                   ("A", d + dt.timedelta(days=1), 3.0), ("A", d + dt.timedelta(days=2), 4.0)],
                                  "k string, rd date, v double")
    strict = asof_join(left, right, ["k"], "ld", "rd", "backward", False, dt.timedelta(days=5)).first()
    assert strict["v"] == 2.0
    strict4 = asof_join(left, right, ["k"], "ld", "rd", "backward", False, dt.timedelta(days=4)).first()
    assert strict4["v"] is None
    fwd = asof_join(left, right, ["k"], "ld", "rd", "forward", True, dt.timedelta(days=1)).first()
    assert fwd["v"] == 1.0
    fwd_strict = asof_join(left, right, ["k"], "ld", "rd", "forward", False, dt.timedelta(days=1)).first()
    assert fwd_strict["v"] == 3.0


def test_narrow_buckets_do_not_copy_right_rows(data):
    """A tolerance wider than the bucket uses the carried row, not copies."""
    _L, _R, ldf, rdf = data
    plan = asof_join(ldf, rdf, ["k"], "lt", "rt", tolerance=dt.timedelta(days=2),
                     bucket_width=dt.timedelta(hours=1))._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence" not in plan


def test_plan_has_no_nested_loop_or_cartesian(data):
    _L, _R, ldf, rdf = data
    for tol in (None, dt.timedelta(days=1)):
        plan = asof_join(ldf, rdf, ["k"], "lt", "rt", tolerance=tol)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("tol, width", [(dt.timedelta(days=1), None), (None, dt.timedelta(days=1)),
                                        (dt.timedelta(days=7), dt.timedelta(days=1)),
                                        (dt.timedelta(days=7), None), (None, None)])
def test_hot_key_is_spread_over_tasks(spark, tol, width):
    """One key with half of all rows: its time buckets land in different tasks (copy
    path, and carry path with and without a tolerance)."""
    from pyspark.sql import functions as F

    rnd = random.Random(3)
    L = [(i, "HOT" if i % 2 else f"K{i % 97}", BASE + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 60)))
         for i in range(4000)]
    R = [(j, "HOT" if j % 2 else f"K{j % 97}", BASE + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 60)), 1.0)
         for j in range(4000)]
    ldf = spark.createDataFrame(L, "id long, k string, lt timestamp")
    rdf = spark.createDataFrame(R, "rid long, k string, rt timestamp, v double")
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = asof_join(ldf, rdf, ["k"], "lt", "rt", tolerance=tol, bucket_width=width, max_group_rows=100)
        # read the matched value, or Catalyst prunes the whole join from a plain count
        per_task = (out.groupBy(F.spark_partition_id().alias("p"))
                    .agg(F.count(F.lit(1)).alias("count"), F.count("v").alias("matched")).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
    hot = sum(1 for r in L if r[1] == "HOT")
    assert max(r["count"] for r in per_task) < hot * 0.5        # the hot key is split, not one task
    assert sum(r["count"] for r in per_task) == len(L)
