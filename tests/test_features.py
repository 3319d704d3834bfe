import pytest
from pyspark.sql import functions as F

from quarterlens.operators.features import (MinMaxScaling, OneHotEncoding, StandardScaling, hash_bucket,
                                            hash_split)
from quarterlens.operators.profile import column_profile
from quarterlens.operators.rowindex import global_row_index, positional_split
from tests.conftest import rows


def test_scalers_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (2.0, 5.0)], "x double, c double")
    mm = MinMaxScaling(["x", "c"]).fit(df).transform(df)
    assert sorted(rows(mm, "x_scaled", "c_scaled")) == [(0.0, 0.0), (0.5, 0.0), (1.0, 0.0)]
    lazy = MinMaxScaling(["x", "c"]).fit_lazy(df).transform(df)
    assert sorted(rows(lazy, "x_scaled", "c_scaled")) == [(0.0, 0.0), (0.5, 0.0), (1.0, 0.0)]
    lazy = StandardScaling(["x", "c"]).fit_lazy(df).transform(df)
    st = StandardScaling(["x", "c"]).fit(df).transform(df)
    assert sorted(rows(lazy)) == sorted(rows(st))
    import numpy as np
    xs = np.array([1.0, 3.0, 2.0])
    want = sorted((xs - xs.mean()) / xs.std())
    got = sorted(r[0] for r in rows(st, "x_std"))
    assert np.allclose(got, want) and {r[0] for r in rows(st, "c_std")} == {0.0}


def test_onehot_rules(spark):
    df = spark.createDataFrame([("b", "y", "1"), ("a", "x", "2"), ("c", "y", None)], "three string, two string, n string")
    enc = OneHotEncoding(["three", "two", "n"]).fit(df)
    assert enc.categories == {"three": ["a", "b", "c"], "two": ["x", "y"], "n": ["1", "2", None]}
    assert enc.kept("two") == ["y"]                                        # binary: first dropped
    got = {r["three"]: r["onehot"] for r in enc.transform(df).collect()}
    assert got["b"] == [0.0, 1.0, 0.0, 1.0, 1.0, 0.0, 0.0]
    assert got["c"] == [0.0, 0.0, 1.0, 1.0, 0.0, 0.0, 1.0]                 # null category last
    unseen = spark.createDataFrame([("z", "x", "1")], "three string, two string, n string")
    with pytest.raises(Exception):
        enc.transform(unseen).collect()


def test_hash_split_is_deterministic_and_sized(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    a = hash_split(df, ["k"]).groupBy("split").count()
    b = hash_split(df.repartition(7), ["k"])
    counts = dict(rows(a))
    assert abs(counts["test"] / 20000 - 0.15) < 0.02 and abs(counts["val"] / 20000 - 0.085) < 0.02
    j = hash_split(df, ["k"]).join(b.withColumnRenamed("split", "s2"), "k")
    assert j.filter("split <> s2").count() == 0
    h = df.select(hash_bucket("k").alias("h")).agg(F.min("h"), F.max("h")).first()
    assert h[0] >= 0 and h[1] < 10000


def test_global_row_index_and_positional_split(spark):
    df = spark.range(1003).select((F.col("id") * 7 % 1003).alias("v"))
    idx, n = global_row_index(df, ["v"], num_partitions=5)
    assert n == 1003
    assert rows(idx.filter("row_index <> v"), "v") == []
    sp = dict(rows(positional_split(df, ["v"]).groupBy("split").count()))
    assert sp == {"train": int(1003 * 0.6), "val": int(1003 * 0.8) - int(1003 * 0.6),
                  "test": 1003 - int(1003 * 0.8)}


def test_column_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "a int, b string")
    assert sorted(rows(column_profile(df))) == [("a", "int", 2, 2), ("b", "string", 1, 2)]


def test_model_save_load_and_mlp(spark, tmp_path):
    from quarterlens.plans import training as TR

    data = [("T%d" % i, "Q%d-24" % (i % 4 + 1), str(i % 4 + 1), "ind%d" % (i % 3), (i % 7) / 7.0 - 0.5,
             bool(i % 2), i % 2) for i in range(60)]
    df = spark.createDataFrame(data, "ticker string, quarter string, q_num string, industry string, "
                                     "net_sentiment double, neutral_dominance boolean, label int")
    model = TR.fit_model(df, num_trees=5)
    path = str(tmp_path / "model")
    TR.save_model(model, path)
    again = TR.load_model(path)
    a = sorted(rows(TR.predict(model, df), "ticker", "prediction", "probability_up"))
    b = sorted(rows(TR.predict(again, df), "ticker", "prediction", "probability_up"))
    assert a == b
    m = TR.fit_mlp(df, max_iter=20)
    assert TR.predict(m, df).count() == 60
    ev = TR.evaluate(model, df, df).first()
    assert ev["n_test"] == 60 and 0 <= ev["accuracy"] <= 1 and ev["baseline"] == 0.5
    # One row per request with the single-document response fields; a ticker with
    # two industry rows takes one of them (A9), a document without statistics still scores
    req = spark.createDataFrame([(1, "T1", "2"), (2, "T2", "2"), (3, "T9", "1")],
                                "doc_id long, ticker string, q_num string")
    stats = spark.createDataFrame([(1, 0.1, 1.2, True), (2, -0.3, 0.9, False)],
                                  "doc_id long, net_sentiment double, sentiment_entropy double, "
                                  "neutral_dominance_count boolean")
    sector = spark.createDataFrame([("T1", "ind1"), ("T1", "ind0"), ("T2", "ind2")], "ticker string, industry string")
    out = TR.score_documents(req, stats, sector, model)
    assert out.columns == ["doc_id", "ticker", "prediction", "probability_up", "neutral_dominance",
                           "net_sentiment", "industry", "sentiment_entropy"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert sorted(got) == [1, 2, 3] and got[1]["industry"] == "ind0" and got[3]["industry"] is None
    assert all(0 <= got[i]["probability_up"] <= 1 and got[i]["prediction"] in (0, 1) for i in (1, 2))
    assert got[3]["prediction"] is None and got[3]["probability_up"] is None   # industry never seen
    unseen = df.limit(1).withColumn("industry", F.lit("other"))
    with pytest.raises(Exception, match="unknown category"):
        TR.predict(again, unseen).collect()


def test_pipeline_features_equal_scaling_and_encoding(spark):
    """The fitted pipeline's features are K1 next to K3, binary columns dropped to one."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    from quarterlens.plans import training as TR

    data = [("T%d" % i, str(i % 4 + 1) if i % 9 else None, "ind%d" % (i % 3), (i % 7) / 7.0 - 0.5,
             bool(i % 2), i % 2) for i in range(60)]
    df = TR.model_input(spark.createDataFrame(
        data, "ticker string, q_num string, industry string, net_sentiment double, "
              "neutral_dominance boolean, label int"))
    got = Pipeline(stages=TR.preprocessing(df)).fit(df).transform(df)
    scaled = MinMaxScaling(["net_sentiment"]).fit(df).transform(df)
    # one column (the binary one) first, then the encoded ones, as the assembler puts them
    want = OneHotEncoding(["industry_s", "q_num_s", "neutral_dominance_s"]).fit(df).transform(scaled)
    enc = {r["ticker"]: r for r in want.collect()}
    order = [c for c in TR.FEATURES_CATEGORICAL]
    width = {"industry": 3, "q_num": 5, "neutral_dominance": 1}
    at = {"industry": 0, "q_num": 3, "neutral_dominance": 8}
    for r in got.withColumn("f", vector_to_array("features")).collect():
        e = enc[r["ticker"]]
        expect = [e["net_sentiment_scaled"]]
        for c in order:
            expect += e["onehot"][at[c]:at[c] + width[c]]
        assert r["f"] == pytest.approx(expect)


def test_reshape(spark):
    import datetime as dt
    from quarterlens.operators.reshape import map_to_rows, wide_to_long

    w = spark.createDataFrame([(dt.date(2024, 1, 2), 1.0, None)], "date date, A double, B double")
    assert rows(wide_to_long(w, ["date"], ["A", "B"])) == [(dt.date(2024, 1, 2), "A", 1.0)]
    m = spark.createDataFrame([({"AAPL": ("Tech", "Hardware")},)],
                              "m map<string, struct<sector: string, industry: string>>")
    assert rows(map_to_rows(m, "m", "ticker", "info")) == [("AAPL", "Tech", "Hardware")]
