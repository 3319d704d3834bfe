import hashlib
import random

import pytest

from quarterlens.llm import lines
from quarterlens.llm.queries import ORACLE, QUERIES
from tests.llm.helpers import SMALL, oracle, read


def brute(rows, min_chars=10):
    """{(id, text): (n_lines, n_dropped, kept)}"""
    big = float("inf")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(
        {c: c + 32 for c in range(65, 91)})
    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            first[k] = min(first.get(k, big), big if i is None else i)
    out = {}
    for i, t in rows:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if len(key(x)) < min_chars
                or first[key(x)] == (big if i is None else i)]
        out[i, t] = (len(all_lines), len(all_lines) - len(kept), "\n".join(kept))
    return out


def _rows():
    rng = random.Random(3)
    pool = ["a line that many documents hold", "A Line that many DOCUMENTS hold  ", "short",
            "nine char", "ten chars!", "é" * 9, "é" * 10, "É" * 10, "\ttabs at both ends\x0b",
            "tabs at both ends", "\x1cno ascii space, stays apart", "no ascii space, stays apart",
            "x" * 5000, "", "  "]
    rows = []
    for i in range(150):
        own = [f"only in {i}, line {j}" for j in range(rng.randint(0, 3))]
        some = rng.choices(pool, k=rng.randint(0, 8)) + own
        rng.shuffle(some)
        rows.append((rng.choice([1, -1]) * i, "\n".join(some) + rng.choice(["", "\n", "\r\n"])))
    many = "\n".join(f"line number {j % 700} of many" for j in range(3000))
    return rows + [(900, None), (901, ""), (902, "\n\n\n"), (903, many), (904, many + "\nthe last"),
                   (None, pool[0]), (None, pool[0] + "\nand its own"), (905, pool[0]),
                   (905, pool[0]), (-500, "ten chars!"), (-500, "ten chars!\nten chars!")]


@pytest.mark.parametrize("partitions", ["1", "8", "64"])
def test_matches_brute_force(spark, partitions):
    rows = _rows()
    df = spark.createDataFrame([(7, t, i, b"k") for i, t in rows],
                               "row int, text string, doc_id long, keep binary").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", "false")      # no merged partitions
    try:
        got = lines.drop_repeated_lines(df)
        assert got.columns == ["row", "text", "doc_id", "keep", "n_lines", "n_dropped"]
        want = brute(rows)
        left = sorted((repr(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in got.collect())
        assert left == sorted((repr(i), *want[i, t]) for i, t in rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_one_key_and_equal_rows_over_many_partitions(spark):
    """One line in every row; a third of the rows are equal, id included."""
    df = spark.range(30000).selectExpr(
        "if(id % 3 = 0, 5, id) AS doc_id", "'the very same line' AS text")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = lines.drop_repeated_lines(df).filter("n_dropped = 0").select("doc_id").distinct()
        assert [r.doc_id for r in got.collect()] == [1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_bitmaps(spark):
    df = spark.createDataFrame([(1, "the first line\nb"), (2, "a\nThe First Line \nc\nthe first line")],
                               "doc_id long, text string")
    r, = lines.keep_bitmaps(df).collect()
    assert r.doc == 2 and list(lines.unpack(r.keep, 4)) == [True, False, True, False]
    assert list(lines.unpack(r.keep, 6))[4:] == [True, True]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert lines.drop_repeated_lines(df, n_lines=None, n_dropped="gone").collect() == []


def test_query_matches_brute_force_and_sql(spark):
    docs = read(SMALL, "documents", "doc_id")
    want = {i: (n, k, hashlib.sha256(t.encode()).hexdigest())
            for (i, _), (n, k, t) in brute(list(zip(docs.doc_id, docs.text))).items()}
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256)
           for r in QUERIES["op13_line_dedup"](spark, SMALL).collect()}
    assert got == want
    assert {r[0]: r[1:] for r in oracle(ORACLE["op13_line_dedup"], SMALL, "documents")} == want
