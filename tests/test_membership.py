import datetime as dt

from quarterlens.operators.enrich import enrich_with_fallback, left_dim_with_default, rows_with_nulls
from quarterlens.plans.membership import core_table, historical_index, wanted_paths
from quarterlens.sources.membership_lines import parse_membership_lines
from tests.conftest import rows

D = dt.date


def test_historical_index_rules(spark):
    snaps = [(D(2019, 1, 15), "A"),                          # Q1-19: no snapshot in March -> quarter gone (L2)
             (D(2019, 6, 3), "A"), (D(2019, 6, 28), "B"),    # two June snapshots: only the latest counts
             (D(2019, 6, 28), "BRK.B"), (D(2019, 6, 28), "B"),
             (D(2018, 12, 31), "OLD"),                        # not after the bound (strict)
             (D(2019, 9, 30), "BF.BX")]
    df = spark.createDataFrame(snaps, "date date, ticker string")
    got = sorted(rows(historical_index(df), "quarter", "ticker"))
    assert got == [("Q2-19", "B"), ("Q2-19", "BRK-B"), ("Q3-19", "BF.BX")]


def test_historical_index_bounded_form(spark):
    df = spark.createDataFrame([(D(2025, 3, 5), "X"), (D(2025, 6, 30), "Y")], "date date, ticker string")
    got = rows(historical_index(df, bounded_years=(2019, 2024)), "quarter", "quarter_start", "ticker")
    assert got == [("Unknown", None, "Y")]                   # both map to Unknown; its latest date wins (L1)


def test_centuries_are_not_mixed(spark):
    """1920 and 2020 share the label Q1-20; both keep their own last snapshot."""
    df = spark.createDataFrame([(D(1920, 3, 31), "OLD"), (D(2020, 3, 31), "NEW"), (D(2020, 3, 2), "GONE")],
                               "date date, ticker string")
    got = sorted(rows(historical_index(df, after=D(1900, 1, 1)), "quarter", "quarter_start", "ticker"))
    assert got == [("Q1-20", D(1920, 1, 1), "OLD"), ("Q1-20", D(2020, 1, 1), "NEW")]


def test_parse_membership_lines(spark):
    lines = spark.createDataFrame([(1, '2019-03-29,"A,B,C"'), (2, "2019-03-30,D"), (3, '2019-04-01,"E"'),
                                   (4, '2019-02-30,"F"'), (5, "2019-06-28 no list"), (6, "no date,G"),
                                   (7, '2019-01-01,"H,I" 2019-01-02,"J"'), (8, None), (9, "2019-07-01,")],
                                  "id int, value string")
    got = rows(parse_membership_lines(lines, keep=("id",)), "id", "date", "ticker")
    assert got == [(1, D(2019, 3, 29), "A"), (1, D(2019, 3, 29), "B"), (1, D(2019, 3, 29), "C"),
                   (2, D(2019, 3, 30), "D"),                 # one ticker needs no quotes
                   (3, D(2019, 4, 1), "E"),
                   (4, None, "F"),                           # impossible date: null, the job goes on
                   (7, D(2019, 1, 1), "H"), (7, D(2019, 1, 1), "I"), (7, D(2019, 1, 2), "J")]


def test_enrich_with_fallback(spark):
    base = spark.createDataFrame([("Q1", "AAA"), ("Q1", "BBB"), ("Q1", "CCC"), ("Q2", "AAA")],
                                 "quarter string, ticker string")
    primary = spark.createDataFrame([("AAA", "0000000001", "Alpha"), ("BBB", "0000000002", None)],
                                    "ticker string, cik string, company_name string")
    patch = spark.createDataFrame([("BBB", "0000000022", "Beta"), ("AAA", "0000000099", "Wrong")],
                                  "ticker string, cik string, company_name string")
    got = sorted(rows(enrich_with_fallback(base, primary, patch, "ticker", ["cik", "company_name"])))
    assert got == [("Q1", "AAA", "0000000001", "Alpha"),     # complete: never takes the patch
                   ("Q1", "BBB", "0000000022", "Beta"),      # name missing: whole row from the patch
                   ("Q1", "CCC", None, None),                # absent from both
                   ("Q2", "AAA", "0000000001", "Alpha")]


def test_left_dim_default_and_missing(spark):
    df = spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string")
    dim = spark.createDataFrame([("A", "Tech", "None"), ("B", None, "Banks")], "ticker string, sector string, industry string")
    got = sorted(rows(left_dim_with_default(df, dim, "ticker", ["sector", "industry"])))
    assert got == [("A", "Tech", "N/A"), ("B", "N/A", "Banks"), ("C", "N/A", "N/A")]
    assert sorted(rows(rows_with_nulls(dim))) == [("B", None, "Banks")]


def test_core_table_one_row_per_filing_and_ticker(spark):
    filings = spark.createDataFrame([("f1", "123", D(2022, 3, 31)), ("f2", "123", D(2022, 5, 2))],
                                    "filename string, cik string, period date")
    conv = spark.createDataFrame([("0000000123", "X", "Co"), ("0000000123", "Y", "Co")],
                                 "cik string, ticker string, company_name string")   # one cik, two tickers (L7)
    members = spark.createDataFrame([(D(2022, 3, 1), "X"), (D(2022, 3, 15), "X"), (D(2022, 3, 2), "Y"),
                                     (D(2022, 4, 1), "X")], "date date, ticker string")
    got = sorted(rows(core_table(members, filings, conv), "filename", "ticker", "first_member_date",
                      "last_member_date", "member_snapshots"))
    # the cik fans out to both tickers; two March snapshots of X give one row, not two;
    # f2 (May) has no member snapshot that month and is dropped by the inner join
    assert got == [("f1", "X", D(2022, 3, 1), D(2022, 3, 15), 2), ("f1", "Y", D(2022, 3, 2), D(2022, 3, 2), 1)]


def test_wanted_paths(spark):
    paths = spark.createDataFrame([("a/20150102_10-K_edgar_data_0001022097_x.txt",), ("a/no_cik.txt",),
                                   ("a/20150102_10-Q_edgar_data_55_y.txt",)], "path string")
    wanted = spark.createDataFrame([(1022097,)], "cik long")
    assert [r[0] for r in rows(wanted_paths(paths, wanted), "path")] == ["a/20150102_10-K_edgar_data_0001022097_x.txt"]


def test_core_table_null_period_never_matches(spark):
    """A filing without a report period has no month label and joins nothing."""
    filings = spark.createDataFrame([("f1", "123", None), ("f2", "123", D(2022, 3, 31))],
                                    "filename string, cik string, period date")
    conv = spark.createDataFrame([("0000000123", "X", "Co")], "cik string, ticker string, company_name string")
    members = spark.createDataFrame([(D(2022, 3, 1), "X"), (None, "X")], "date date, ticker string")
    got = sorted(rows(core_table(members, filings, conv), "filename", "member_snapshots"))
    assert got == [("f2", 1)]


def test_read_membership_text_file(spark, tmp_path):
    """A7 from a file: one record per line, parsed line by line; an unquoted one-ticker
    line counts and shifts nothing after it (L3)."""
    from quarterlens.sources.membership_lines import read_membership_text

    path = tmp_path / "snapshots.txt"
    path.write_text('date,tickers\n2019-03-29,"AAPL,BF.B,MSFT"\n2019-06-28,XOM\n2019-09-30,"GE"\n')
    got = sorted(rows(read_membership_text(spark, str(path)), "date", "ticker"))
    assert got == [(D(2019, 3, 29), "AAPL"), (D(2019, 3, 29), "BF.B"), (D(2019, 3, 29), "MSFT"),
                   (D(2019, 6, 28), "XOM"), (D(2019, 9, 30), "GE")]
