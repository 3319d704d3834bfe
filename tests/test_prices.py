import datetime as dt

import pytest

from pyspark.sql import functions as F

from quarterlens.functions.timefns import earnings_session
from quarterlens.plans import prices as P
from tests.conftest import rows

D = dt.date
T = dt.datetime


def test_session_rules(spark):
    ts = [T(2024, 1, 2, 12, 0, 0), T(2024, 1, 2, 12, 0, 1), T(2024, 1, 2, 12, 0, 0, 500),
          T(2024, 1, 2, 14, 59, 59), T(2024, 1, 2, 15, 0, 0), None]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp")
    got = rows(df.select(earnings_session("ts"), earnings_session("ts", "12:00:00", inclusive=False)))
    assert got == [("BMO", "BMO"), ("BMO", "AMC"), ("BMO", "AMC"), ("BMO", "AMC"), ("AMC", "AMC"), (None, None)]


def test_change_on_day(spark):
    daily = spark.createDataFrame([("A", D(2024, 1, 4), 100.0), ("A", D(2024, 1, 5), 101.125),
                                   ("A", D(2024, 1, 8), 50.0), ("A", D(2024, 1, 9), 50.0)],
                                  "ticker string, date date, close double")
    ev = spark.createDataFrame([(1, "A", D(2024, 1, 5), "BMO"),    # 1/4 -> 1/5
                                (2, "A", D(2024, 1, 4), "AMC"),    # 1/4 -> 1/5
                                (3, "A", D(2024, 1, 8), "BMO"),    # 1/7 missing (weekend) -> null
                                (4, "A", D(2024, 1, 8), None)],
                               "id int, ticker string, earnings_date date, session string")
    got = dict(rows(P.change_on_day(ev, daily), "id", "cod"))
    import numpy as np
    assert got[1] == float(np.round((101.125 - 100) / 100 * 100, 2)) == got[2]
    assert got[3] is None and got[4] is None


def test_quarter_over_quarter_adjacency(spark):
    q = spark.createDataFrame([("A", "Q1-24", D(2024, 1, 1), 10.0), ("A", "Q2-24", D(2024, 4, 1), 12.0),
                               ("A", "Q4-24", D(2024, 10, 1), 6.0), ("B", "Q1-24", D(2024, 1, 1), 5.0)],
                              "ticker string, quarter string, quarter_start date, q_end_price double")
    got = {(r["ticker"], r["quarter"]): (r["coq_pct"], r["up_or_down"])
           for r in P.quarter_over_quarter(q).collect()}
    assert got[("A", "Q2-24")] == (20.0, "Up")
    assert got[("A", "Q1-24")] == (None, None)
    assert got[("A", "Q4-24")] == (None, None)               # Q3 missing: no adjacent quarter


def test_first_and_all_events_in_quarter_keep_duplicates(spark):
    idx = spark.createDataFrame([("AAPL", "Q1-19", D(2019, 1, 1)), ("AAPL", "Q1-19", D(2019, 1, 1)),
                                 ("AAPL", "Q2-19", D(2019, 4, 1)), ("AAPL", "Q1-19", D(1919, 1, 1))],
                                "ticker string, quarter string, quarter_start date")
    ev = spark.createDataFrame([("AAPL", T(2019, 1, 30, 16, 30)), ("AAPL", T(2019, 3, 31, 20, 0)),
                                ("AAPL", T(2019, 1, 30, 9, 0))], "ticker string, earnings_ts timestamp")
    first = sorted(rows(P.first_event_in_quarter(idx, ev), "quarter_start", "earnings_ts"))
    assert first == [(D(1919, 1, 1), None)] + [(D(2019, 1, 1), T(2019, 1, 30, 9, 0))] * 2 + \
        [(D(2019, 4, 1), None)]                                # another century, the same label
    alld = sorted(rows(P.event_dates_in_quarter(idx, ev), "quarter_start", "earnings_dates"))
    assert alld[1] == (D(2019, 1, 1), "2019-01-30, 2019-03-31")     # whole last day counts (L31)


def test_market_caps_and_latest(spark):
    daily = spark.createDataFrame([(1, D(2024, 1, 2), 10.005), (1, D(2024, 1, 5), 20.0)],
                                  "ticker long, date date, close double")
    ev = spark.createDataFrame([(1, 1, T(2024, 1, 4, 10)), (2, 1, T(2023, 6, 1, 10)), (3, 1, T(2024, 1, 1, 9))],
                               "event_id long, ticker long, earnings_ts timestamp")
    shares = spark.createDataFrame([(1, 1000.0)], "ticker long, shares_outstanding double")
    got = {r["event_id"]: r for r in P.market_caps(ev, daily, shares, 2024, 2024).collect()}
    assert set(got) == {1, 3}
    assert got[1]["close_date"] == D(2024, 1, 2) and got[1]["market_cap"] == round(10.005 * 1000)
    assert got[3]["close_date"] is None


def test_close_matrix_loses_no_series(spark):
    daily = spark.createDataFrame([(D(2024, 1, 2), "A", 1.0), (D(2024, 1, 2), "Z", 2.0)],
                                  "date date, ticker string, close double")
    assert rows(P.close_matrix(daily), "date", "A", "Z") == [(D(2024, 1, 2), 1.0, 2.0)]
    with pytest.raises(Exception, match="series not listed: Z"):
        P.close_matrix(daily, ["A", "B"]).collect()


def test_close_matrix(spark):
    daily = spark.createDataFrame([("A", D(2024, 1, 2), 1.0), ("B", D(2024, 1, 2), 2.0), ("A", D(2024, 1, 3), 3.0)],
                                  "ticker string, date date, close double")
    got = sorted(rows(P.close_matrix(daily, ["A", "B", "C"]), "date", "A", "B", "C"))
    assert got == [(D(2024, 1, 2), 1.0, 2.0, None), (D(2024, 1, 3), 3.0, None, None)]


def test_zero_prices_give_null_not_error(spark):
    q = spark.createDataFrame([("A", "Q1-24", D(2024, 1, 1), 0.0), ("A", "Q2-24", D(2024, 4, 1), 5.0)],
                              "ticker string, quarter string, quarter_start date, q_end_price double")
    got = {r["quarter"]: r["coq_pct"] for r in P.quarter_over_quarter(q).collect()}
    assert got["Q2-24"] is None
    daily = spark.createDataFrame([("A", D(2024, 1, 4), 0.0), ("A", D(2024, 1, 5), 1.0)],
                                  "ticker string, date date, close double")
    ev = spark.createDataFrame([(1, "A", D(2024, 1, 5), "BMO")], "id int, ticker string, earnings_date date, session string")
    assert rows(P.change_on_day(ev, daily), "cod") == [(None,)]


def test_sentiment_train_without_chunks(spark):
    from quarterlens.plans.training import sentiment_train
    stats = spark.createDataFrame([(1, 0, 0, 0, None)], "doc_id long, count_positive_chunks long, "
                                  "count_negative_chunks long, count_neutral_chunks long, net_sentiment double")
    keys = spark.createDataFrame([(1, "A", D(2024, 1, 1))], "doc_id long, ticker string, quarter_start date")
    assert rows(sentiment_train(stats, keys), "count_neut_over_total_count") == [(None,)]


def test_exchange_wall_clock(spark):
    from quarterlens.functions.timefns import day_start, exchange_wall_clock
    df = spark.createDataFrame([(T(2024, 1, 2, 21, 30),), (T(2024, 7, 2, 20, 30),)], "ts timestamp_ntz")
    got = rows(df.select(exchange_wall_clock("ts"), day_start("ts")))
    assert got[0] == (T(2024, 1, 2, 16, 30), T(2024, 1, 2))      # EST, UTC-5
    assert got[1][0] == T(2024, 7, 2, 16, 30)                      # EDT, UTC-4
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:                                                            # wall clock ignores the session zone
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        again = rows(df.select(exchange_wall_clock("ts"), day_start(exchange_wall_clock("ts"))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert again == [(T(2024, 1, 2, 16, 30), T(2024, 1, 2)), (T(2024, 7, 2, 16, 30), T(2024, 7, 2))]


def test_industry_for(spark):
    from quarterlens.plans.training import industry_for
    sec = spark.createDataFrame([("A", "Z-ind"), ("A", "B-ind"), ("C", "x")], "ticker string, industry string")
    assert rows(industry_for(sec, "A")) == [("B-ind",)]
    assert rows(industry_for(sec, "Q")) == [(None,)]
