import datetime as dt
import random

from pyspark.sql import functions as F

from quarterlens.operators.latest import latest_by


def _check(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    got = df.groupBy("k").agg(latest_by(df, "v", "t", "tie").alias("v"))
    want = df.groupBy("k").agg(F.max(F.struct("t", "tie", "v"))["v"].alias("v"))
    assert sorted(got.collect()) == sorted(want.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_latest_matches_struct_max_on_timestamps(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 3, 10, 1, 0)
    rows = [(f"k{rnd.randint(0, 9)}", base + dt.timedelta(minutes=rnd.randint(0, 5)),
             rnd.choice([None, rnd.randint(-3, 3)]), float(i)) for i in range(400)]
    _check(spark, rows, "k string, t timestamp, tie long, v double")
    _check(spark, rows, "k string, t timestamp_ntz, tie long, v double")


def test_latest_on_dates_and_extreme_ties(spark):
    rows = [("a", dt.date(1969, 12, 31), -(2 ** 63), 1.0), ("a", dt.date(1969, 12, 31), 2 ** 63 - 1, 2.0),
            ("a", dt.date(1900, 1, 1), 5, 3.0), ("b", dt.date(2030, 1, 1), 0, None),
            ("b", dt.date(2029, 12, 31), 9, 4.0)]
    _check(spark, rows, "k string, t date, tie long, v double")


def test_wall_clock_units_ignore_the_session_zone(spark):
    from quarterlens.functions.timefns import time_of_day_micros
    from quarterlens.operators.latest import time_units

    prev = spark.conf.get("spark.sql.session.timeZone")
    vals = [dt.datetime(2024, 3, 10, 1, 59, 59, 999999), dt.datetime(2024, 3, 10, 2, 30, 0, 5),
            dt.datetime(2024, 11, 3, 1, 30), dt.datetime(1969, 12, 31, 23, 0, 0, 1)]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(v,) for v in vals], "t timestamp_ntz")
        got = [tuple(r) for r in df.select(time_units(df, "t"), time_of_day_micros("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    epoch = dt.datetime(1970, 1, 1)
    want = [((v - epoch) // dt.timedelta(microseconds=1),
             (v - v.replace(hour=0, minute=0, second=0, microsecond=0)) // dt.timedelta(microseconds=1))
            for v in vals]
    assert got == want
