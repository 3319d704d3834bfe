import datetime as dt

from pyspark.sql import functions as F

from quarterlens.functions import ids, quarters as Q
from quarterlens.functions.numeric import percent_text_to_double, round_half_even, softmax3, up_down_to_label
from tests.conftest import rows


def test_quarter_labels(spark):
    ds = [dt.date(2018, 12, 31), dt.date(2019, 1, 1), dt.date(2024, 12, 31), dt.date(2025, 1, 1),
          dt.date(1999, 5, 5), dt.date(2000, 11, 30), None]
    df = spark.createDataFrame([(d,) for d in ds], "d date")
    got = rows(df.select(Q.quarter_label("d"), Q.quarter_label_bounded("d"), Q.month_label("d")))
    assert got == [("Q4-18", "Unknown", "2018-12"), ("Q1-19", "Q1-19", "2019-01"),
                   ("Q4-24", "Q4-24", "2024-12"), ("Q1-25", "Unknown", "2025-01"),
                   ("Q2-99", "Unknown", "1999-05"), ("Q4-00", "Unknown", "2000-11"),
                   (None, "Unknown", None)]


def test_label_to_dates(spark):
    df = spark.createDataFrame([("Q1-19",), ("Q4-2021",), ("bad",)], "q string")
    got = rows(df.select(Q.label_quarter_start("q"), Q.label_quarter_end("q"), Q.quarter_number("q")))
    assert got[0] == (dt.date(2019, 1, 1), dt.date(2019, 3, 31), "1")
    assert got[1] == (dt.date(2021, 10, 1), dt.date(2021, 12, 31), "4")
    assert got[2] == (None, None, None)


def test_compose_label(spark):
    df = spark.createDataFrame([("Q3", 2021)], "q string, y int")
    assert rows(df.select(Q.compose_label("q", "y"))) == [("Q3-21",)]


def test_pad_cik(spark):
    df = spark.createDataFrame([("1",), ("1234567890",), ("12345678901",), (None,)], "c string")
    assert rows(df.select(ids.pad_cik("c"))) == [("0000000001",), ("1234567890",), ("12345678901",), (None,)]


def test_names_and_paths(spark):
    name = "20150102_10-K_edgar_data_1022097_0001477932-15-000006.txt"
    path = "gs://bucket/2015q1/" + name
    df = spark.createDataFrame([(name, path), ("20150102_10-Q_misc.txt", "x/10-Q/y.txt")], "n string, p string")
    got = rows(df.select(ids.cik_from_name("n"), ids.filing_type_from_name("n"),
                         ids.filing_type_from_path("p"), ids.base_name("p")))
    assert got[0] == ("1022097", "10-K", "10-K", name)
    assert got[1] == (None, "10-Q", "10-Q", "y.txt")


def test_ticker_fixes(spark):
    df = spark.createDataFrame([("BF.B",), ("BRK.B",), ("BF.BX",), ("AAPL",)], "ticker string")
    assert [r[0] for r in rows(ids.fix_tickers(df))] == ["BF-B", "BRK-B", "BF.BX", "AAPL"]
    assert rows(df.select(ids.dots_to_dashes("ticker")))[0] == ("BF-B",)


def test_numeric_helpers(spark):
    df = spark.createDataFrame([("12.5%", "Up", 2.675), ("n/a", "Down", 0.125), (None, "Flat", -1.5)],
                               "p string, u string, x double")
    got = rows(df.select(percent_text_to_double("p"), up_down_to_label("u"), round_half_even("x", 2),
                         round_half_even("x", 0)))
    import numpy as np
    assert got[0][:2] == (12.5, 1) and got[1][:2] == (None, 0) and got[2][:2] == (None, None)
    assert [g[2] for g in got] == [float(np.round(v, 2)) for v in (2.675, 0.125, -1.5)]
    assert [g[3] for g in got] == [float(np.round(v)) for v in (2.675, 0.125, -1.5)]


def test_softmax3(spark):
    import numpy as np
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    s = df.select(softmax3("a", "b", "c").alias("s")).first()["s"]
    e = np.exp([1.0, 2.0, 3.0]); e /= e.sum()
    assert np.allclose([s["positive"], s["negative"], s["neutral"]], e, atol=1e-15)
