"""A5 with quarantine, and the file sizes of B3."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterlens.sources.files import load_csv
from quarterlens.sources.sinks import write_by_quarter
from tests.conftest import rows

SCHEMA = T.StructType([T.StructField("ticker", T.StringType(), False), T.StructField("n", T.IntegerType()),
                       T.StructField("day", T.DateType()), T.StructField("x", T.DoubleType())])


def test_bad_rows_go_to_quarantine(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text("ticker,n,day,x\nA,1,2020-01-31,0.5\nB,one,2020-01-31,0.5\n,2,,\nC,,,\nD,1,2020-02-30,1\n")
    b.write_text('ticker,n,day,x\nE,1\nF,1,2020-01-31,0.5,more\n"G, Inc.", 7 ,2020-01-31,1e3\nH,3000000000,,\n'
                 '"I ""x""",1,31.01.2020,NaN\n')
    got = load_csv(spark, str(tmp_path), SCHEMA)
    day = dt.date(2020, 1, 31)
    assert sorted(map(str, rows(got.good))) == sorted(map(str, [
        ("A", 1, day, 0.5), ("C", None, None, None), ("G, Inc.", 7, day, 1000.0)]))
    bad = sorted((r.file.rsplit("/", 1)[1], r.reason) for r in got.bad.collect())
    assert bad == sorted([("a.csv", "n: not int: one"), ("a.csv", "ticker: missing"),
                          ("a.csv", "day: not date: 2020-02-30"), ("b.csv", "not 4 fields"),
                          ("b.csv", "not 4 fields"), ("b.csv", "n: not int: 3000000000"),
                          ("b.csv", "day: not date: 31.01.2020")])
    assert (got.n_good, got.n_bad) == (3, 7)
    assert got.good.schema["n"].dataType == T.IntegerType()
    assert {r.record for r in got.bad.filter("reason = 'not 4 fields'").collect()} == \
        {"E,1", "F,1,2020-01-31,0.5,more"}


def test_other_date_format_and_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ticker,n,day,x\nA,1,31.01.2020,1\n")
    got = load_csv(spark, str(tmp_path), SCHEMA, date_format="dd.MM.yyyy")
    assert rows(got.good, "day") == [(dt.date(2020, 1, 31),)] and got.n_bad == 0
    (tmp_path / "a.csv").write_text("ticker,n,day,x\n")
    assert load_csv(spark, str(tmp_path), SCHEMA)[2:] == (0, 0)


def test_a_wrong_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ticker,m,day,x\nA,1,2020-01-31,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_csv(spark, str(tmp_path), SCHEMA)


def test_files_of_a_quarter_follow_its_size(spark, tmp_path):
    """One quarter has nearly all rows and comes in many tasks: it gets several files of about the
    advisory size, every other quarter one."""
    df = spark.range(0, 400_000, 1, 16).select(
        F.when(F.col("id") % 100 != 0, 2020).otherwise(2021 + F.col("id") % 300 / 100).cast("int").alias("year"),
        F.lit("Q1").alias("quarter"), F.md5(F.col("id").cast("string")).alias("v"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        out = str(tmp_path / "out")
        write_by_quarter(df, out)
        files = {y: len(glob.glob(f"{out}/year={y}/quarter=Q1/*.parquet")) for y in (2020, 2021, 2022, 2023)}
        assert 3 <= files[2020] <= 12 and all(files[y] == 1 for y in (2021, 2022, 2023)), files
        assert spark.read.parquet(out).count() == 400_000
        write_by_quarter(df.filter("year = 2021").limit(5), out)
        assert spark.read.parquet(out).groupBy("year").count().filter("year = 2021").first()["count"] == 5
        assert spark.read.parquet(out).filter("year = 2020").count() == 396_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
