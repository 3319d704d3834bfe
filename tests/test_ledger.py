"""Unreadable and unscored filings are rejected, recorded and tried again."""

import datetime as dt
import os
import pytest

from quarterlens.operators.scoring import PandasModelScorer, demo_model, demo_scorer
from quarterlens.plans.registry import ORACLE, QUERIES, load_all
from quarterlens.streaming.incremental import (append_filing_sentiment, failures_path,
                                               retry_filing_sentiment, stream_filing_sentiment)
from quarterlens.streaming.ledger import due, open_failures, state
from tests.conftest import SF_SMALL, rows
from tests.test_sources_incremental import _flaky, _write_filings

KEYS = ["cik", "filename"]
UNREADABLE = "/sys/bus/cpu/uevent"              # has a size, and can not be opened to read
needs_unreadable = pytest.mark.skipif(not os.path.exists(UNREADABLE), reason="needs " + UNREADABLE)


def _texts(spark, n):
    return [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet")
            .select("doc_id", "text").orderBy("doc_id").limit(n).collect()]


def _break(folder, name):
    """Replaces a filing by one that can be listed but not read; returns its content."""
    path = os.path.join(folder, "2022q1", name)
    with open(path, "rb") as f:
        content = f.read()
    os.remove(path)
    os.symlink(UNREADABLE, path)
    return path, content


def _mend(path, content):
    os.remove(path)
    with open(path, "wb") as f:
        f.write(content)


def _stored(spark, target):
    return {r.filename: r.n_chunks for r in spark.read.parquet(target).collect()}


@needs_unreadable
def test_unreadable_filing_is_retried_by_the_batch_job(spark, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    names = _write_filings(folder, _texts(spark, 3))
    path, content = _break(folder, names[1])
    assert tuple(append_filing_sentiment(spark, folder, target, demo_scorer())) == (2, 1)
    assert set(_stored(spark, target)) == {names[0], names[2]}
    r, = open_failures(spark, failures_path(target), KEYS).collect()
    assert r.filename == names[1] and r.reason.startswith("unreadable: ") and r.attempts == 1
    # still unreadable: counted again, nothing appended
    assert tuple(append_filing_sentiment(spark, folder, target, demo_scorer())) == (0, 1)
    assert rows(open_failures(spark, failures_path(target), KEYS), "attempts") == [(2,)]
    # given up after two attempts
    assert tuple(append_filing_sentiment(spark, folder, target, demo_scorer(), max_attempts=2)) == (0, 0)
    _mend(path, content)
    assert tuple(append_filing_sentiment(spark, folder, target, demo_scorer())) == (1, 0)
    got = _stored(spark, target)
    assert set(got) == set(names) and got[names[1]] > 0
    assert open_failures(spark, failures_path(target), KEYS).count() == 0
    assert tuple(append_filing_sentiment(spark, folder, target, demo_scorer())) == (0, 0)


@needs_unreadable
def test_the_stream_delivers_what_it_rejected_again(spark, tmp_path):
    folder, target, ckpt = (str(tmp_path / x) for x in ("in", "out", "ck"))
    names = _write_filings(folder, _texts(spark, 3))
    path, content = _break(folder, names[2])

    def run(**kw):
        stream_filing_sentiment(spark, folder, target, ckpt, demo_scorer(), **kw).awaitTermination()

    run(max_files_per_trigger=1)
    assert set(_stored(spark, target)) == set(names[:2])
    run()
    r, = open_failures(spark, failures_path(target), KEYS).collect()
    assert r.filename == names[2] and r.attempts == 2
    _mend(path, content)
    run()                                       # no new file: the pass before the stream
    got = _stored(spark, target)
    assert set(got) == set(names) and got[names[2]] > 0
    assert spark.read.parquet(target).count() == 3
    assert open_failures(spark, failures_path(target), KEYS).count() == 0


@needs_unreadable
def test_an_old_failure_comes_with_the_next_micro_batch(spark, tmp_path):
    folder, target, ckpt = (str(tmp_path / x) for x in ("in", "out", "ck"))
    names = _write_filings(folder, _texts(spark, 2))
    path, content = _break(folder, names[0])
    append_filing_sentiment(spark, folder, target, demo_scorer())
    _mend(path, content)
    new = spark.createDataFrame([], "path string")
    assert tuple(retry_filing_sentiment(spark, target, demo_scorer(), retry_after=3600, also=new)) == (0, 0)
    assert tuple(retry_filing_sentiment(spark, target, demo_scorer(), also=new)) == (1, 0)
    assert set(_stored(spark, target)) == set(names)


def test_unscored_filing_is_retried_by_the_stream(spark, tmp_path):
    from pyspark import cloudpickle

    import tests.test_sources_incremental as helpers

    cloudpickle.register_pickle_by_value(helpers)
    docs = _texts(spark, 2)
    docs[0] = (docs[0][0], docs[0][1] + "\n" + "BOOM " * 15)
    folder, target, ckpt = (str(tmp_path / x) for x in ("in", "out", "ck"))
    names = _write_filings(folder, docs)
    bad = PandasModelScorer(_flaky, on_error="skip")
    stream_filing_sentiment(spark, folder, target, ckpt, bad).awaitTermination()
    assert set(_stored(spark, target)) == {names[1]}
    r, = open_failures(spark, failures_path(target), KEYS).collect()
    assert r.reason.endswith("paragraphs not scored")
    stream_filing_sentiment(spark, folder, target, ckpt,
                            PandasModelScorer(demo_model)).awaitTermination()
    assert set(_stored(spark, target)) == set(names)


def test_state_of_a_ledger(spark):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    events = spark.createDataFrame([
        ("a", "p1", "r1", at(1), "failed", "x"), ("a", "p1", "r1", at(2), "failed", "x"),
        ("a", "p2", "r2", at(3), "failed", "y"),
        ("b", "p", "r1", at(1), "failed", "x"), ("b", "p", "r2", at(4), "done", None),
        (None, "p", "r1", at(1), "done", None), (None, "p", "r2", at(1), "failed", "z"),
        ("c", "p", "r1", at(1), "done", None)],
        "k string, path string, run string, at timestamp, outcome string, reason string")
    got = {r.k: (r.path, r.reason, r.attempts, r.first_at, r.last_at, r.is_open)
           for r in state(events, ["k"]).collect()}
    assert got == {"a": ("p2", "y", 2, at(2), at(3), True), "b": ("p", "x", 1, at(1), at(1), False),
                   None: ("p", "z", 1, at(1), at(1), True)}
    assert sorted(map(str, rows(due(state(events, ["k"]).filter("is_open"), 2), "k"))) == ["(None,)"]


def test_registered_state_matches_its_oracle(spark):
    import duckdb
    load_all()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_SMALL}/events.parquet'")
    got = QUERIES["failure_ledger"](spark, SF_SMALL)
    want = con.execute(ORACLE["failure_ledger"])
    at = [d[0] for d in want.description]
    assert sorted(map(str, rows(got, *at))) == sorted(str(tuple(r)) for r in want.fetchall())
