import math

import pytest
from pyspark.sql import functions as F

from quarterlens.operators.scoring import PandasModelScorer, demo_model, demo_scorer
from quarterlens.operators.sentiment import aggregate_stats, sentiment_stats
from tests.conftest import SF_SMALL, rows

CHUNK_SCHEMA = "doc string, paragraph string, positive double, negative double, neutral double"

# FIXTURES §2: golden statistics recorded for three documents (n, sums, counts, derived).
GOLDEN = {
    "A": (3, 0.32444705069065094, 0.17370122112333775, 2.501851737499237, (0, 0, 3),
          0.8339505791664124, 0.050248609855771065, True, 0.803494105414829),
    "B": (2, 0.6104723066091537, 0.0803988422267139, 1.309128999710083, (0, 0, 2),
          0.6545644998550415, 0.2650367321912199, True, 1.1091528697961655),
    "C": (2, 0.9808148592710495, 0.9741430841386318, 0.04504207335412502, (1, 1, 0),
          0.02252103667706251, 0.0033358875662088394, False, 1.1328413336876446),
}
CASE_C_CHUNKS = [(0.9533109068870544, 0.02219676598906517, 0.02449231967329979),
                 (0.027503952383995056, 0.9519463181495667, 0.020549753680825233)]


def _chunks():
    out = []
    for k, (n, sp, sn, su, *_rest) in GOLDEN.items():
        if k == "C":
            out += [(k, "p", *c) for c in CASE_C_CHUNKS]
        else:  # equal chunks with the recorded sums give the same averages and counts
            out += [(k, "p", sp / n, sn / n, su / n)] * n
    return out


def test_golden_statistics(spark):
    df = spark.createDataFrame(_chunks(), CHUNK_SCHEMA)
    got = {r["doc"]: r for r in aggregate_stats(df, ["doc"]).collect()}
    for k, (n, sp, sn, su, counts, avg_u, net, dom, ent) in GOLDEN.items():
        r = got[k]
        assert r["n_chunks"] == n
        assert (r["count_positive_chunks"], r["count_negative_chunks"], r["count_neutral_chunks"]) == counts
        for col, want in (("sum_positive", sp), ("sum_negative", sn), ("sum_neutral", su),
                          ("avg_neutral", avg_u), ("net_sentiment", net), ("sentiment_entropy", ent)):
            assert math.isclose(r[col], want, rel_tol=0, abs_tol=1e-12), (k, col)
        assert r["neutral_dominance_score"] is dom
    c = got["C"]
    assert math.isclose(c["max_positive_score"], 0.9533109068870544, abs_tol=1e-15)
    assert math.isclose(c["max_neutral_score"], 0.02449231967329979, abs_tol=1e-15)


def test_ties_and_dominance_boundary(spark):
    third = 1 / 3
    data = [("tie3", "p", third, third, third),          # all equal -> positive
            ("tie_nu", "p", 0.2, 0.4, 0.4),              # negative = neutral > positive -> negative
            ("tie_pu", "p", 0.4, 0.2, 0.4),              # positive = neutral -> positive
            ("dom", "p", 0.2, 0.2, 0.6)]                 # exactly 0.6 is not dominance
    data += [("dom_count", "p", 0.1, 0.1, 0.8)] * 3 + [("dom_count", "p", 0.8, 0.1, 0.1)] * 2
    got = {r["doc"]: r for r in aggregate_stats(spark.createDataFrame(data, CHUNK_SCHEMA), ["doc"]).collect()}
    assert got["tie3"]["count_positive_chunks"] == 1
    assert got["tie_nu"]["count_negative_chunks"] == 1
    assert got["tie_pu"]["count_positive_chunks"] == 1
    assert got["dom"]["neutral_dominance_score"] is False
    assert got["dom_count"]["neutral_dominance_count"] is False      # 3 of 5 = 0.6, strict
    assert got["dom_count"]["neutral_dominance_score"] is False      # mean neutral 0.52


def test_zero_share_in_entropy(spark):
    df = spark.createDataFrame([("z", "p", 1.0, 0.0, 0.0)], CHUNK_SCHEMA)
    assert aggregate_stats(df, ["doc"]).first()["sentiment_entropy"] == 0.0


def test_sentinel_and_null_modes(spark):
    docs = spark.createDataFrame([(1, None), (2, "   "), (3, "short text only"), (4, "x" * 30 + "\n" + "y" * 40),
                                  (5, "the the and of " * 10)], "doc_id long, text string")
    s = {r["doc_id"]: r for r in sentiment_stats(docs, demo_scorer()).collect()}
    for d in (1, 2, 3, 4):
        r = s[d]
        assert (r["n_chunks"], r["count_positive_chunks"], r["count_neutral_chunks"]) == (0, 0, 0)
        assert r["max_positive_score"] == -1.0 and r["avg_neutral"] == -1.0 and r["sum_negative"] == -1.0
        assert r["net_sentiment"] is None and r["sentiment_entropy"] is None
    assert s[5]["n_chunks"] == 1 and s[5]["count_positive_chunks"] == 1
    n = {r["doc_id"]: r for r in sentiment_stats(docs, demo_scorer(), empty="null").collect()}
    assert n[1]["avg_positive"] is None and n[1]["count_negative_chunks"] == 0
    assert n[5]["avg_positive"] == pytest.approx((4 * 10 + 1) / (80 + 3) * 0 + s[5]["avg_positive"])


def test_scores_sum_to_one_and_counts_add_up(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    st = sentiment_stats(docs, demo_scorer())
    bad = st.filter((F.col("n_chunks") > 0) & (
        (F.abs(F.col("sum_positive") + F.col("sum_negative") + F.col("sum_neutral") - F.col("n_chunks")) > 1e-9)
        | (F.col("count_positive_chunks") + F.col("count_negative_chunks") + F.col("count_neutral_chunks")
           != F.col("n_chunks"))))
    assert bad.count() == 0
    assert st.count() == docs.count()


def test_pandas_scorer_matches_native(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    native = sentiment_stats(docs, demo_scorer("softmax"))
    pandas_path = sentiment_stats(docs, PandasModelScorer(demo_model), balance_partitions=4)
    cols = ["doc_id", "n_chunks", "count_positive_chunks", "sum_positive", "avg_neutral", "sentiment_entropy"]
    a = sorted(rows(native, *cols))
    b = sorted(rows(pandas_path, *cols))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[:3] == y[:3]
        for u, v in zip(x[3:], y[3:]):
            assert (u is None and v is None) or math.isclose(u, v, abs_tol=1e-9)


def test_python_scorer_is_not_in_native_plan(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    plan = sentiment_stats(docs, demo_scorer())._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


class _FlakyModel:
    """Demo model that raises on any batch holding a paragraph with the word BOOM."""

    def __init__(self):
        self.base = demo_model()

    def logits(self, texts):
        if any("BOOM" in t for t in texts):
            raise RuntimeError("model failure")
        return self.base.logits(texts)


def _flaky():
    return _FlakyModel()


def test_failed_documents_are_skipped_reported_and_retried(spark, tmp_path):
    """A document the model cannot fully score is not appended, is counted, and is
    picked up by the next run; the others are stored once."""
    import sys

    from pyspark import cloudpickle

    from quarterlens.streaming.incremental import append_sentiment

    cloudpickle.register_pickle_by_value(sys.modules[__name__])   # workers need _flaky by value
    ok = "the market grew and the outlook is positive with strong demand in every region"
    docs = spark.createDataFrame([(1, ok), (2, ok + "\n" + "BOOM " * 15), (3, ok + "\n\n" + ok)],
                                 "doc_id long, text string")
    target = str(tmp_path / "sentiment")
    first = append_sentiment(spark, docs, target, PandasModelScorer(_flaky, on_error="skip"))
    assert tuple(first) == (2, 1)
    assert sorted(r[0] for r in rows(spark.read.parquet(target), "doc_id")) == [1, 3]
    assert "failed_chunks" not in spark.read.parquet(target).columns
    second = append_sentiment(spark, docs, target, PandasModelScorer(demo_model))
    assert tuple(second) == (1, 0)
    stored = spark.read.parquet(target)
    assert sorted(r[0] for r in rows(stored, "doc_id")) == [1, 2, 3]
    native = sentiment_stats(docs, demo_scorer("softmax"))
    cols = ["doc_id", "n_chunks", "count_positive_chunks", "sum_positive"]
    a, b = sorted(rows(native, *cols)), sorted(rows(stored, *cols))
    for x, y in zip(a, b):
        assert x[:3] == y[:3] and math.isclose(x[3], y[3], abs_tol=1e-9)


def test_raising_scorer_fails_the_job(spark):
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    docs = spark.createDataFrame([(1, "BOOM " * 15)], "doc_id long, text string")
    with pytest.raises(Exception):
        sentiment_stats(docs, PandasModelScorer(_flaky)).collect()


def test_unscored_paragraph_is_in_no_class(spark):
    chunks = spark.createDataFrame([("d", "p1", 0.2, 0.2, 0.6), ("d", "p2", None, None, None)], CHUNK_SCHEMA)
    r = aggregate_stats(chunks, ["doc"], failures=True).first()
    assert (r["n_chunks"], r["failed_chunks"]) == (2, 1)
    assert (r["count_positive_chunks"], r["count_negative_chunks"], r["count_neutral_chunks"]) == (0, 0, 1)
