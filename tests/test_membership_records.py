"""Quoted lists that run over line ends and over splits."""

import datetime as dt
import random
import re

import duckdb
import pytest

from quarterlens.plans.registry import ORACLE, QUERIES, load_all
from quarterlens.sources.membership_lines import join_records, read_membership_text
from tests.conftest import SF_ORACLE, SF_SMALL, rows

D = dt.date


def plain_records(text):
    """Records of a file, one line at a time."""
    out, now = [], []
    for line in text.split("\n"):
        if re.match(r"\d{4}-\d{2}-\d{2}", line):
            if now:
                out.append("\n".join(now))
            now = [line] if line.count('"') % 2 else []
            if not now:
                out.append(line)
        elif now:
            now.append(line)
            if line.count('"') % 2:
                out.append("\n".join(now))
                now = []
        else:
            out.append(line)
    return out + (["\n".join(now)] if now else [])


def test_lists_over_lines(spark, tmp_path):
    path = tmp_path / "m.txt"
    path.write_text('date,tickers\n2019-03-29,"A,B"\n2019-06-28,"C,\nD,E"\n2019-09-30,"F\n,G,\r\n  H"\n'
                    '2019-10-01,I\n2019-12-31,"never closed,X\n2020-03-31,"J"\n"K"\n2020-06-30,"L,\n\nM')
    got = sorted(rows(read_membership_text(spark, str(path)), "date", "ticker"))
    assert got == [(D(2019, 3, 29), "A"), (D(2019, 3, 29), "B"),
                   (D(2019, 6, 28), "C"), (D(2019, 6, 28), "D"), (D(2019, 6, 28), "E"),
                   (D(2019, 9, 30), "F"), (D(2019, 9, 30), "G"), (D(2019, 9, 30), "H"),
                   (D(2019, 10, 1), "I"), (D(2020, 3, 31), "J")]


@pytest.mark.parametrize("split_bytes", [64, 200, 1 << 20])
def test_records_over_splits(spark, tmp_path, split_bytes):
    """Files cut into splits of a few bytes give the records of a plain reader."""
    rng = random.Random(split_bytes)
    kinds = ['{d},"A,B"', '{d},"A,\nB,\nC"', '{d},"A\n,B,\n\nC,D\n"', "{d},E", "stray", '{d},"open,', '"', "",
             '{d},"a" {d},"b\nc"', "x" * 150]
    want = []
    folder = tmp_path / "in"
    folder.mkdir()
    for f in range(4):
        text = "\n".join(rng.choice(kinds).format(d=f"20{10 + f}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}")
                         for _ in range(150))
        (folder / f"f{f}.txt").write_text(text + "\n")
        want += [(f"f{f}.txt", r) for r in plain_records(text)]
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = spark.read.text(str(folder)).selectExpr(
            "_metadata.file_name AS file", "_metadata.file_block_start AS split", "value")
        if split_bytes < 1000:
            assert lines.rdd.getNumPartitions() > 20
        assert sorted(rows(join_records(lines))) == sorted(want)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_empty_input(spark):
    df = spark.createDataFrame([], "file string, split long, value string")
    assert rows(join_records(df)) == []


@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
def test_query_matches_its_oracle(spark, sf):
    load_all()
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(ORACLE["member_records"])
    at = [d[0] for d in want.description]
    got = sorted(rows(QUERIES["member_records"](spark, sf), *at))
    assert got == sorted(want.fetchall()) and len(got) > 1000
