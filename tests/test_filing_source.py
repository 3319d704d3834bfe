"""A1-A3: the filings data source."""

import os
import time

import pytest
from pyspark.sql import functions as F

from quarterlens.sources import filing_source as S
from quarterlens.sources.filings import filings_metadata, list_objects, read_filings, read_headers
from tests.conftest import rows
from tests.test_ledger import UNREADABLE, needs_unreadable


def _write(folder, n, size=300):
    os.makedirs(folder, exist_ok=True)
    for i in range(n):
        kind = "10-K" if i % 2 else "10-Q"
        name = f"2022{i % 12 + 1:02d}15_{kind}_edgar_data_{1000 + i % 7}_0000-22-{i}.txt"
        with open(os.path.join(folder, name), "w", newline="") as f:
            f.write(f"CONFORMED PERIOD OF REPORT: 202203{i % 28 + 1:02d}\r\n" + "é" * size)
    with open(os.path.join(folder, "notes_8-K.txt"), "w") as f:
        f.write("not a filing")


def _scan(df):
    """The nodes of the physical plan, one line each."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_equals_the_plain_readers(spark, tmp_path):
    folder = str(tmp_path / "in")
    _write(folder, 9)
    _write(folder + "/deeper", 3)
    whole = S.scan_filings(spark, folder)
    at = ["path", "filename", "text", "read_error"]
    assert sorted(rows(whole, *at)) == sorted(rows(read_filings(spark, folder), *at))
    heads = S.scan_filings(spark, folder, "head", head_chars=40)
    assert sorted(rows(heads, *at)) == sorted(rows(read_headers(spark, folder, header_chars=40), *at))
    assert sorted(map(str, filings_metadata(S.scan_filings(spark, folder, "head")).collect())) == \
        sorted(map(str, filings_metadata(read_headers(spark, folder)).collect()))
    listed = S.scan_filings(spark, folder, "none")
    want = {r for r in rows(list_objects(spark, folder), "cik", "path", "filename") if "8-K" not in r[2]}
    assert set(rows(listed, "cik", "path", "filename")) == want
    assert listed.filter("text IS NOT NULL OR read_error IS NOT NULL").count() == 0
    r = listed.first()
    assert r.length == os.path.getsize(r.path.removeprefix("file:"))
    assert abs(r.modified.timestamp() - time.time()) < 3600


def test_filters_choose_files(spark, tmp_path):
    folder = str(tmp_path / "in")
    _write(folder, 28)
    df = S.scan_filings(spark, folder)
    one = df.filter((F.col("filing_type") == "10-K") & F.col("cik").isin("1001", "1003"))
    assert one.count() == 4 and {r.cik for r in one.collect()} == {"1001", "1003"}
    plan = _scan(one)
    assert "BatchScan filings" in plan and "Filter (" not in plan      # nothing is left after the scan
    assert "Filter (" in _scan(df.filter(F.length("cik") == 4))
    # the reader opens none of the others
    reader = S.FilingReader({"path": folder})
    left = list(reader.pushFilters([S.EqualTo(("filing_type",), "10-K"), S.In(("cik",), ("1001",)),
                                    S.EqualTo(("text",), "x"), S.IsNotNull(("cik",))]))
    assert [f.attribute for f in left] == [("text",)]
    assert len([f for p in reader.partitions() for f in p.files]) == 2
    # other filters are Spark's
    other = df.filter((F.col("cik") == "1002") & F.col("text").contains("20220303"))
    assert other.count() == df.filter("cik = '1002'").filter("instr(text, '20220303') > 0").count() == 1
    assert df.filter("cik IS NULL").count() == 0 and df.filter("cik = '1002' OR filing_type = '10-K'").count() == 16


def test_one_huge_and_many_small_files_make_even_tasks(spark, tmp_path):
    folder = str(tmp_path / "in")
    _write(folder, 10_000, size=10)
    huge = os.path.join(folder, "20220115_10-K_edgar_data_77_0000-22-x.txt")
    with open(huge, "w") as f:
        f.write("CONFORMED PERIOD OF REPORT: 20220331\n")
        f.truncate(2 << 30)                                     # sparse: takes no disk
    reader = S.FilingReader({"path": folder, "partitionBytes": str(64 << 20)})
    tasks = reader.partitions()
    assert sum(len(t.files) for t in tasks) == 10_001
    alone, = [t for t in tasks if any(f.path.endswith("-x.txt") for f in t.files)]
    assert len(alone.files) == 1                                # a file is one row: it can not be cut
    load = [sum(f.length + S.OPEN_BYTES for f in t.files) for t in tasks if t is not alone]
    assert max(load) - min(load) <= S.OPEN_BYTES + 200 and max(load) < 64 << 20
    # heads cost the same for all, so the huge one shares a task
    heads = S.FilingReader({"path": folder, "contents": "head", "partitionBytes": str(64 << 20)}).partitions()
    counts = [len(t.files) for t in heads]
    assert max(counts) - min(counts) <= 2 and len(heads) >= 10
    got = S.scan_filings(spark, folder, "head", head_chars=40).filter("cik = '77'").first()
    assert got.text.startswith("CONFORMED PERIOD OF REPORT: 20220331\n") and got.length == 2 << 30
    long = S.scan_filings(spark, folder).filter("cik = '77'").first()
    assert long.text is None and "too many for one row" in long.read_error


@needs_unreadable
def test_unreadable_file_is_a_row(spark, tmp_path):
    folder = str(tmp_path / "in")
    _write(folder, 2)
    os.symlink(UNREADABLE, os.path.join(folder, "x_10-Q_edgar_data_5_1.txt"))
    got = {r.cik: r for r in S.scan_filings(spark, folder).collect()}
    assert len(got) == 3 and got["5"].text is None and got["5"].read_error
    assert got["1000"].text and got["1000"].read_error is None


def test_empty_folder_and_bad_option(spark, tmp_path):
    folder = str(tmp_path / "in")
    os.makedirs(folder)
    assert S.scan_filings(spark, folder).count() == 0
    with pytest.raises(ValueError):
        S.FilingReader({"path": folder, "contents": "some"})


def test_stream_delivers_each_file_once(spark, tmp_path):
    folder, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ck"))
    _write(folder, 4)

    def run():
        q = S.stream_filings(spark, folder).filter("filing_type = '10-Q'") \
            .writeStream.format("parquet").option("path", out) \
            .option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()

    run()
    assert spark.read.parquet(out).count() == 2
    run()
    assert spark.read.parquet(out).count() == 2
    time.sleep(0.05)
    _write(folder + "/later", 6)
    run()
    got = spark.read.parquet(out)
    assert got.count() == 5 == got.select("path").distinct().count()
