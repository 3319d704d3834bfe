"""Models are stored under what they were fitted on, and published whole or not at all."""

import os

import pytest
from pyspark.sql import functions as F

from quarterlens.operators.boosting import BoostedTrees, fit_boosted_trees
from quarterlens.plans.model_store import ModelStore, fingerprint, load_text, save_text


def _rows(spark, n=60):
    return spark.range(n).selectExpr("id * 1.0 AS x", "IF(id % 3 = 0, null, id) AS z",
                                     "CAST(id % 2 AS int) AS label")


def test_fingerprint_is_of_the_bag_of_rows(spark):
    df = _rows(spark)
    key = fingerprint(df, {"a": 1})
    assert key == fingerprint(df.repartition(7).orderBy(F.desc("x")).select("label", "z", "x"), {"a": 1})
    others = [df.union(df.limit(1)), df.union(df), df.filter("x > 0"), df.withColumn("x", F.col("x") + 1),
              df.withColumnRenamed("z", "y"), df.withColumn("z", F.col("z").cast("int")),
              df.withColumn("z", F.coalesce("z", F.lit(0)))]
    keys = {fingerprint(o, {"a": 1}) for o in others} | {fingerprint(df, {"a": 2}), key}
    assert len(keys) == len(others) + 2


class _Fits:
    """Counts its fits."""

    def __init__(self, df):
        self.df, self.n = df, 0

    def __call__(self):
        self.n += 1
        return fit_boosted_trees(self.df, ["x", "z"], rounds=1, depth=1)


def _get(store, df, fit, **params):
    spark = store.spark
    return store.get_or_fit("trees", df, params, fit, lambda m, p: save_text(m, p, spark),
                            lambda p: BoostedTrees.from_json(load_text(p, spark)))


def test_same_input_loads_and_changed_input_fits_again(spark, tmp_path):
    store, df = ModelStore(spark, str(tmp_path / "m")), _rows(spark)
    fit = _Fits(df)
    first = _get(store, df, fit, depth=1)
    assert _get(store, df.repartition(3), fit, depth=1) == first and fit.n == 1
    _get(store, df, fit, depth=2)
    assert fit.n == 2
    more = _rows(spark, 61)
    other = _Fits(more)
    _get(store, more, other, depth=1)
    assert other.n == 1


def test_half_written_models_are_never_loaded(spark, tmp_path):
    store, df = ModelStore(spark, str(tmp_path / "m")), _rows(spark)
    fit = _Fits(df)

    def dies(model, path):
        save_text(model, path, spark)
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        store.get_or_fit("trees", df, {}, fit, dies, str)
    assert store.folder("trees", fingerprint(df, {})) is None
    assert not [f for f in os.listdir(tmp_path / "m") if not f.startswith(".")] \
        if os.path.exists(tmp_path / "m") else True
    # a folder without a pointer, and a pointer that is not whole
    key = fingerprint(df, {})
    os.makedirs(tmp_path / "m" / f"trees-{key[:16]}-dead")
    (tmp_path / "m" / f"trees-{key}.json").write_text('{"key": "')
    assert store.folder("trees", key) is None
    assert _get(store, df, fit) == _get(store, df, fit) and fit.n == 2


def test_the_second_of_two_runs_uses_what_is_published(spark, tmp_path):
    store, df = ModelStore(spark, str(tmp_path / "m")), _rows(spark)
    fit = _Fits(df)
    key = fingerprint(df, {})

    def meanwhile(model, path):
        save_text(model, path, spark)
        save_text(model, path + "-other", spark)
        store.publish("trees", key, path + "-other")

    got = store.get_or_fit("trees", df, {}, fit, meanwhile, str)
    assert got == store.folder("trees", key)


def test_pipeline_models(spark, tmp_path):
    from quarterlens.plans import training as TR

    rows = [("t", "Q1-20", "1" if i % 2 else "2", "ab"[i % 2], 0.1 * i, i % 3 == 0, i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, "ticker string, quarter string, q_num string, industry string, "
                                     "net_sentiment double, neutral_dominance boolean, label int")
    store, fits = ModelStore(spark, str(tmp_path / "m")), []

    def fit():
        fits.append(1)
        return TR.fit_model(df, num_trees=2, depth=2)

    one = store.get_or_fit("up_down", df, {"n": 2}, fit)
    two = store.get_or_fit("up_down", df, {"n": 2}, fit)
    show = lambda m: [r.probability_up for r in TR.predict(m, df).collect()]
    assert show(one) == show(two) and len(fits) == 1
