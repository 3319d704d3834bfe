"""Randomised equivalence with Python's own string / regex semantics."""

import random
import re

from quarterlens.functions import text as T

ALPHABET = ["a", "b", "I", "t", "e", "m", " ", " ", "\n", "\n", "\r", "\t", "\x0b", "\x1c", "\x1f", "\x85",
            "\xa0", " ", "　", ".", ":", "-", "2", "3", "7", "8", "A", "é", "ſ"]
TOKENS = ["item 2.", "ITEM 3:", "Item\x1c2 ", "item  3 -", "Item 7. Management", "Discussion", "Analysis",
          "Item 7A.", "Item 8.", "\n", "management\ndiscussion"]


def _random_text(rnd, n):
    parts = []
    for _ in range(n):
        parts.append(rnd.choice(TOKENS) if rnd.random() < 0.15 else "".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(1, 30))))
    return "".join(parts)


def _py_paragraphs(text):
    if not isinstance(text, str) or len(text.strip()) < 20:
        return []
    return [p.strip() for p in re.split(r"\n+", text) if len(p.strip()) > 50]


def _py_section(text, start, end, skip):
    rest = text[skip:]
    m = re.search(start, rest, re.IGNORECASE)
    if not m:
        return None
    e = re.search(end, rest[m.start():], re.IGNORECASE)
    if not e:
        return None
    return rest[m.start():m.start() + e.start()].strip() or None


def test_paragraphs_and_strip_match_python(spark):
    rnd = random.Random(5)
    texts = [_random_text(rnd, rnd.randint(0, 40)) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: (r["p"], r["s"]) for r in df.select("i", T.paragraphs("t").alias("p"),
                                                       T.py_strip("t").alias("s")).collect()}
    for i, t in enumerate(texts):
        assert got[i][0] == _py_paragraphs(t), i
        assert got[i][1] == t.strip(), i


def test_sections_match_python(spark):
    rnd = random.Random(9)
    texts = [_random_text(rnd, rnd.randint(5, 60)) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: (r["q"], r["k"]) for r in df.select(
        "i", T.section_10q("t", skip=10).alias("q"), T.section_10k("t", skip=10).alias("k")).collect()}
    hits = 0
    for i, t in enumerate(texts):
        assert got[i][0] == _py_section(t, T.Q_START, T.Q_END, 10), (i, t)
        assert got[i][1] == _py_section(t, T.K_START, T.K_END, 10), (i, t)
        hits += got[i][0] is not None
    assert hits > 20


def _py_period(text, n=5000):
    m = re.search(r"CONFORMED PERIOD OF REPORT:\s*(\d{8})", text[:n])
    return m.group(1) if m else None


def test_header_period_matches_python(spark):
    """Case-sensitive key, Python's \\s and Unicode \\d, first 5,000 characters only."""
    import datetime as dt

    rnd = random.Random(13)
    keys = ["CONFORMED PERIOD OF REPORT:", "conformed period of report:", "CONFORMED PERIOD OF REPORT"]
    gaps = ["", " ", "\t", "\x1c", "\xa0", "\n \n", "  x"]
    digits = ["20240331", "2024033", "20241399", "２０２４０３３１", "19991231"]
    texts = []
    for _ in range(300):
        pad = " " * rnd.choice([0, 10, 4970, 4990, 6000])
        texts.append(pad + rnd.choice(keys) + rnd.choice(gaps) + rnd.choice(digits) + "\nTAIL")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["p"] for r in df.select("i", T.header_period("t").alias("p")).collect()}
    for i, t in enumerate(texts):
        want = _py_period(t)
        if want is not None:
            try:
                want = dt.datetime.strptime(want, "%Y%m%d").date()
            except ValueError:
                want = None
        assert got[i] == want, (i, t[-60:])


def test_normalise_newlines_matches_universal_newlines(spark):
    rnd = random.Random(17)
    pieces = ["a", "\r", "\n", "\r\n", "\r\r\n", "�", " ", "é"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["n"] for r in df.select("i", T.normalise_newlines("t").alias("n")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == re.sub(r"\r\n?", "\n", t).replace("�", ""), repr(t)
