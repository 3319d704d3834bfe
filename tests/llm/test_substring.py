import random

import pytest
from pyspark.sql import functions as F

from quarterlens.llm import substring
from tests.llm.helpers import SMALL, read, remove_repeats


def _rows():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 7)))
    passages = [" ".join(word() for _ in range(n)) for n in (12, 13, 14, 40, 90)]
    rows = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30)))
                 for _ in range(rng.randint(1, 3))]
        parts += rng.sample(passages, rng.randint(0, 3))
        rng.shuffle(parts)
        rows.append((100 - i if i % 2 else i, rng.choice([" ", "\n", " \t "]).join(parts)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "a " * 12), (204, "a " * 13),
             (205, "a " * 500), (206, " ".join(str(i % 3000) for i in range(20000))),
             (207, " ".join(str(i % 3000) for i in range(40, 9000))),
             (208, "naïve   x\x1cy " * 20), (-5, passages[4]), (None, passages[3])]
    return rows


@pytest.mark.parametrize("batch,spread", [(8 << 20, 16 << 20), (3000, 5000)])
def test_matches_brute_force(spark, monkeypatch, batch, spread):
    monkeypatch.setattr(substring, "BATCH_BYTES", batch)
    monkeypatch.setattr(substring, "RANGE_BYTES", spread)
    monkeypatch.setattr(substring, "CHUNK", 700)
    rows = _rows()
    df = spark.createDataFrame([(7, i, t, "k") for i, t in rows],
                               "range int, doc_id long, text string, keys string")
    got = substring.remove_repeats(df)
    assert got.columns == ["range", "doc_id", "text", "keys", "n_words", "n_removed"]
    assert {r.doc_id: (r.n_words, r.n_removed, r.text) for r in got.collect()} == \
        remove_repeats(rows)


def test_rows_that_share_an_id(spark):
    passage = " ".join(map(str, range(30)))
    df = spark.createDataFrame([(4, passage), (4, passage), (4, passage + " x"), (9, passage)],
                               "doc_id long, text string")
    got = [(r.doc_id, r.n_removed) for r in substring.remove_repeats(df).collect()]
    assert sorted(got) == [(4, 0), (4, 0), (4, 0), (9, 30)]


def test_equal_rows_beyond_a_batch_are_treated_once(spark, monkeypatch):
    """100,000 equal rows, more than a batch holds together: no batch gets more than one."""
    passage = " ".join(f"w{i}" for i in range(20))
    monkeypatch.setattr(substring, "BATCH_BYTES", 1 << 20)
    held, core = [], substring._remove

    def seen(docs, *rest):
        held.append(docs.count())
        return core(docs, *rest)

    monkeypatch.setattr(substring, "_remove", seen)
    df = spark.range(100_003).selectExpr(
        "id AS place", f"if(id < 100000, '{passage}', concat('{passage}', ' ', id)) AS text",
        "if(id < 99990, 7, if(id < 100000, null, 8)) AS doc_id")
    got = substring.remove_repeats(df)
    assert got.columns == ["place", "text", "doc_id", "n_words", "n_removed"]
    want = {(7, passage, 20, 0): 99_990, (None, "", 20, 20): 10}
    want |= {(8, str(i), 21, 20): 1 for i in (100_000, 100_001, 100_002)}
    assert {tuple(r)[:4]: r.n for r in got.groupBy("doc_id", "text", "n_words", "n_removed")
            .agg(F.count("*").alias("n")).collect()} == want
    assert held == [5] and got.select("place").distinct().count() == 100_003


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substring.remove_repeats(df).count() == 0


def test_query_matches_brute_force(spark):
    import hashlib

    from quarterlens.llm.queries import QUERIES

    docs = read(SMALL, "documents", "doc_id")
    want = remove_repeats(list(zip(docs.doc_id, docs.text)))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in QUERIES["op3_substring_dedup"](spark, SMALL).collect()}
    assert got == {i: (n, k, hashlib.sha256(t.encode()).hexdigest())
                   for i, (n, k, t) in want.items()}
