import datetime as dt

from pyspark.sql import functions as F

from quarterlens.functions import text as T
from tests.conftest import rows


def one(spark, value, expr, schema="t string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr.alias("r")).first()["r"]


def test_py_strip_matches_python(spark):
    s = " \t   abc def 　\x1c\n"
    assert one(spark, s, T.py_strip("t")) == s.strip()


def test_paragraph_length_boundary(spark):
    p50, p51 = "a" * 50, "b" * 51
    text = f"{p50}\n\n{p51}\n \t \n {'c' * 60} "
    got = one(spark, text, T.paragraphs("t"))
    assert got == [p51, "c" * 60]
    assert got == [p.strip() for p in __import__("re").split(r"\n+", text) if len(p.strip()) > 50]


def test_text_guard(spark):
    assert one(spark, None, T.paragraphs("t")) == []
    assert one(spark, "   \n  ", T.paragraphs("t")) == []
    assert one(spark, "x" * 19, T.text_is_usable("t")) is False
    assert one(spark, " " + "x" * 20 + " ", T.text_is_usable("t")) is True


def _py_section(text, start, end, skip):
    import re
    if text is None:
        return None
    rest = text[skip:]
    m = re.search(start, rest, re.IGNORECASE)
    if not m:
        return None
    e = re.search(end, rest[m.start():], re.IGNORECASE)
    if not e:
        return None
    out = rest[m.start():m.start() + e.start()].strip()
    return out or None


def test_section_cases_match_python(spark):
    pad = "." * 20000
    cases = [
        pad + "Item 2. Management\nbody text\nItem 3. Quant",          # normal
        pad + "Item 2. body without end",                               # no end
        pad + "Item 3. first then Item 2. start only",                  # end before start
        pad + "item 2: one\nITEM 2 - two\nitem 3. end",                 # two starts
        "Item 2. in prefix" + pad + "item 3. x",                        # start only in skipped prefix
        pad + "Item 2. nbsp marker body Item 3. done",             # Unicode space in marker
        "short text",                                                   # shorter than skip
        None,
    ]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, t string")
    got = dict(rows(df.select("i", T.section_10q("t"))))
    for i, c in enumerate(cases):
        assert got[i] == _py_section(c, T.Q_START, T.Q_END, T.Q_SKIP), i


def test_section_10k_end_inside_start(spark):
    pad = "." * 18000
    cases = [
        pad + "Item 7. Management's Discussion and Analysis\nbody\nItem 7A. market risk",
        pad + "Item 7. Management Item 8. Discussion and Analysis rest",   # end inside start (L20)
        pad + "Item 7. Management\nDiscussion Analysis body Item 8.",      # '.' does not cross \n
        pad + "ITEM 7 MANAGEMENT DISCUSSION ANALYSIS body Item 8. fin",
    ]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, t string")
    got = dict(rows(df.select("i", T.section_10k("t"))))
    for i, c in enumerate(cases):
        assert got[i] == _py_section(c, T.K_START, T.K_END, T.K_SKIP), i
    assert got[1] == "Item 7. Management"


def test_section_by_type(spark):
    q = "." * 20000 + "Item 2. quarterly Item 3. x"
    k = "." * 18000 + "Item 7 Management Discussion Analysis annual Item 8. y"
    df = spark.createDataFrame([("10-Q", q), ("10-K", k), (None, q), ("8-K", q), ("none", None)],
                               "ft string, t string")
    out = T.with_section(df, "t", df.ft, "section")
    assert out.columns == ["ft", "t", "section"]
    got = dict(rows(out.select("ft", "section")))
    assert got["10-Q"] == got[None] == got["8-K"] == "Item 2. quarterly"
    assert got["10-K"] == "Item 7 Management Discussion Analysis annual" and got["none"] is None


def test_section_by_type_searches_each_marker_once(spark):
    df = spark.createDataFrame([("10-Q", "x")], "ft string, t string")
    plan = T.with_section(df, "t", df.ft, "section")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_instr") == 4                   # two markers for each of two types


def test_header_period(spark):
    cases = {
        "ok": ("ACCESSION\nCONFORMED PERIOD OF REPORT:\t20190331\n", dt.date(2019, 3, 31)),
        "absent": ("no header here", None),
        "late": (" " * 5000 + "CONFORMED PERIOD OF REPORT: 20190331", None),
        "bad": ("CONFORMED PERIOD OF REPORT: 20241399", None),
        "crlf": ("A\r\nCONFORMED PERIOD OF REPORT:\r\n20200630\r\n", dt.date(2020, 6, 30)),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in cases.items()], "k string, t string")
    got = dict(rows(df.select("k", T.header_period(T.normalise_newlines("t")))))
    assert got == {k: v[1] for k, v in cases.items()}


def test_first_sentence_with(spark):
    s = "Alpha beta. The Industry is steel . gamma industry."
    assert one(spark, s, T.first_sentence_with("t", "industry")) == "The Industry is steel"
    assert one(spark, "nothing here", T.first_sentence_with("t", "industry")) is None


def test_normalise_newlines_drops_replacement_char(spark):
    assert one(spark, "a\r\nb\rc�d", T.normalise_newlines("t")) == "a\nb\ncd"
