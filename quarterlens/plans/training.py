"""Training table, model fit / evaluation and batch scoring."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterlens.functions.numeric import up_down_to_label
from quarterlens.functions.quarters import quarter_number
from quarterlens.operators.features import MinMaxScaling, OneHotEncoding
from quarterlens.session import cut_lineage

DOMINANCE_THRESHOLD = 0.6
FEATURES_NUMERIC = ["net_sentiment"]
FEATURES_CATEGORICAL = ["industry", "q_num", "neutral_dominance"]


def sentiment_train(stats: DataFrame, doc_keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per-filing statistics labelled with (ticker, quarter_start) and the neutral share."""
    s = stats.join(doc_keys, key, "inner")
    total = F.col("count_positive_chunks") + F.col("count_negative_chunks") + F.col("count_neutral_chunks")
    return s.select("ticker", "quarter_start", "count_positive_chunks", "count_negative_chunks",
                    "count_neutral_chunks", "net_sentiment",
                    F.try_divide(F.col("count_neutral_chunks"), total).alias("count_neut_over_total_count"))


def training_table(stock_prices: DataFrame, sector: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Price labels + industry + quarter number + sentiment features.

    Sentiment rows with no chunk at all are dropped (C6; a null total is kept, as
    pandas keeps NaN != 0), dominance is the neutral-count share > 0.6 (E8b, the
    training definition), duplicates are removed (E2), and the left join followed by
    dropping rows without sentiment is planned as an inner join (C9).
    """
    p = stock_prices.select("ticker", "quarter", "quarter_start", "up_or_down")
    p = p.join(sector.select("ticker", "sector", "industry"), "ticker", "left")
    p = p.withColumn("q_num", quarter_number("quarter"))
    total = F.col("count_positive_chunks") + F.col("count_negative_chunks") + F.col("count_neutral_chunks")
    s = sentiment.filter(F.coalesce(total != 0, F.lit(True)))
    s = s.select("ticker", "quarter_start",
                 (F.col("count_neut_over_total_count") > DOMINANCE_THRESHOLD).alias("neutral_dominance"),
                 "net_sentiment").distinct()
    j = p.join(s, ["quarter_start", "ticker"], "left").dropna(subset=["net_sentiment"])
    return j.select("ticker", "quarter", "quarter_start", "q_num", "industry", "net_sentiment",
                    "neutral_dominance", up_down_to_label("up_or_down").alias("label"))


MISSING = "\uffffmissing"      # stands for a null category; sorts after any other


def model_input(df: DataFrame) -> DataFrame:
    """Explicit feature list; categories as strings with a null sentinel."""
    out = df
    for c in FEATURES_CATEGORICAL:
        out = out.withColumn(f"{c}_s", F.coalesce(F.col(c).cast("string"), F.lit(MISSING)))
    return out.withColumn("net_sentiment", F.col("net_sentiment").cast("double"))


def preprocessing(data: DataFrame) -> list:
    """The feature stages, fitted on ``data`` (:func:`model_input` of the training rows).

    The numeric feature is scaled by K1 and the categories are encoded by K3: the same numbers
    as :class:`MinMaxScaling` and :class:`OneHotEncoding` give, as Spark ML stages that
    are saved with the model. An index beyond the fitted categories marks an unseen one
    (see :func:`predict`); a two-category column is its index, which is K3 without its first
    category.
    """
    from pyspark.ml.feature import (OneHotEncoder, SQLTransformer, StringIndexerModel,
                                    VectorAssembler)

    scaling = MinMaxScaling(FEATURES_NUMERIC).fit(data)
    encoding = OneHotEncoding([f"{c}_s" for c in FEATURES_CATEGORICAL]).fit(data)
    scaled = []
    for c, (lo, hi) in scaling.stats.items():
        if lo is None:
            scaled.append(f"CAST(NULL AS DOUBLE) AS {c}_scaled")
        else:
            span = repr(hi - lo) if hi != lo else "1.0D"
            scaled.append(f"({c} - CAST({lo!r} AS DOUBLE)) / CAST({span.rstrip('D')} AS DOUBLE) "
                          f"AS {c}_scaled")
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__")]
    inputs, many = [f"{c}_scaled" for c in FEATURES_NUMERIC], []
    for c in FEATURES_CATEGORICAL:
        labels = encoding.categories[f"{c}_s"]
        stages.append(StringIndexerModel.from_labels(labels, f"{c}_s", f"{c}_i",
                                                     handleInvalid="keep"))
        if len(labels) == 2:
            inputs.append(f"{c}_i")
        else:
            many.append(c)
            inputs.append(f"{c}_v")
    if many:
        # the category after the last one is "unseen"; dropping it leaves one column a category
        stages.append(OneHotEncoder(inputCols=[f"{c}_i" for c in many],
                                    outputCols=[f"{c}_v" for c in many], dropLast=True))
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return stages


def _training_input(train: DataFrame) -> DataFrame:
    """The labelled rows, checkpointed: training reads them once per tree or epoch, and a lost
    executor then re-reads the checkpoint, not the lineage."""
    return cut_lineage(model_input(train).filter(F.col("label").isNotNull()))


FIT = dict(num_trees=100, step=0.02, depth=6, seed=42)


def fit_model(train: DataFrame, num_trees: int = 100, step: float = 0.02, depth: int = 6, seed: int = 42):
    """Scaling, encoding and boosted trees (logistic) as one fitted pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier

    data = _training_input(train)
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxIter=num_trees, stepSize=step,
                        maxDepth=depth, seed=seed)
    return Pipeline(stages=[*preprocessing(data), gbt]).fit(data)


def fit_mlp(train: DataFrame, hidden: Sequence[int] = (20, 40, 20), max_iter: int = 100, seed: int = 42):
    """Small dense network (hidden layers 20-40-20, two outputs) on the same
    features as the boosted trees."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import MultilayerPerceptronClassifier

    data = _training_input(train)
    prep = Pipeline(stages=preprocessing(data)).fit(data)
    width = len(prep.transform(data.limit(1)).first()["features"])
    mlp = MultilayerPerceptronClassifier(featuresCol="features", labelCol="label",
                                         layers=[width, *hidden, 2], maxIter=max_iter, seed=seed)
    return Pipeline(stages=[prep, mlp]).fit(data)


def save_model(model, path: str) -> None:
    """Persist a fitted pipeline (Spark ML format, readable from any executor)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """Load a pipeline saved by :func:`save_model`."""
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)


def _stages(model) -> list:
    """The stages of a fitted pipeline, nested ones included, in order."""
    from pyspark.ml import PipelineModel

    return [x for st in model.stages
            for x in (_stages(st) if isinstance(st, PipelineModel) else [st])]


def unseen_category(model) -> Column:
    """Whether a transformed row has a category that the fit did not see."""
    from pyspark.ml.feature import StringIndexerModel

    beyond = [F.col(st.getOutputCol()) >= len(st.labels) for st in _stages(model)
              if isinstance(st, StringIndexerModel)]
    return reduce(lambda a, b: a | b, beyond, F.lit(False))


def predict(model, df: DataFrame, unseen: str = "error") -> DataFrame:
    """K8: class and probability of Up.

    A category that the fit did not see (null included, unless training had nulls) is an
    error, as in K3; with ``unseen='null'`` such a row gets a null prediction instead, so one
    request of a batch does not fail the others.
    """
    from pyspark.ml.functions import vector_to_array

    if unseen not in ("error", "null"):
        raise ValueError(unseen)
    bad = unseen_category(model)
    scored = model.transform(model_input(df))
    p = vector_to_array("probability")[1]
    if unseen == "error":
        out = F.when(bad, F.raise_error(F.lit("unknown category in model input"))).otherwise(p)
    else:
        out = F.when(~bad, p)
    # decided before "prediction" is replaced: both columns read the guarded value
    return scored.withColumn("probability_up", out) \
        .withColumn("prediction", F.when(F.col("probability_up").isNotNull(),
                                         F.col("prediction").cast("int")))


def label_baseline(rows: DataFrame) -> DataFrame:
    """K9: labelled rows and the share of the larger class."""
    up = F.avg(F.col("label").cast("double"))
    return rows.filter(F.col("label").isNotNull()).agg(
        F.count(F.lit(1)).alias("n_rows"), F.greatest(up, 1 - up).alias("baseline"))


def accuracy(predicted: DataFrame) -> DataFrame:
    """Labelled rows and the share of them whose prediction is the label."""
    return predicted.filter(F.col("label").isNotNull()).agg(
        F.count(F.lit(1)).alias("n_test"),
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))


def predict_fixed(df: DataFrame, coefficients: dict[str, float], intercept: float = 0.0) -> DataFrame:
    """K8 with given coefficients: logistic probability and class of a linear score over the
    numeric columns and indicators (``column=value``) named in ``coefficients``."""
    def term(name: str) -> Column:
        column, eq, value = name.partition("=")
        if not eq:
            return F.col(column).cast("double")
        return F.coalesce(F.col(column).cast("string") == value, F.lit(False)).cast("double")

    z = reduce(lambda a, b: a + b, [term(n) * w for n, w in coefficients.items()], F.lit(intercept))
    out = df.withColumn("probability_up", 1 / (1 + F.exp(-z)))
    return out.withColumn("prediction", (F.col("probability_up") > 0.5).cast("int"))


def evaluate(model, test: DataFrame, all_rows: DataFrame) -> DataFrame:
    """Accuracy on ``test`` and the majority-class share of ``all_rows``."""
    a = accuracy(predict(model, test))
    return a.select("n_test", "accuracy",
                    label_baseline(all_rows).select("baseline").scalar().alias("baseline"))


def industry_for(sector: DataFrame, ticker: str) -> DataFrame:
    """The industry of one ticker; the equality filter reaches the scan, and of
    several rows the smallest industry is returned (deterministic "first row")."""
    return sector.filter(F.col("ticker") == F.lit(ticker)).agg(F.min("industry").alias("industry"))


def score_features(requests: DataFrame, stats: DataFrame, sector: DataFrame,
                   keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """A9 + K4: the model's inputs of every request, the part of N17 before the model."""
    ind = sector.groupBy("ticker").agg(F.min("industry").alias("industry"))
    return (requests.join(stats, list(keys), "left").join(ind, "ticker", "left")
            .select(*keys, "ticker", "q_num", "industry", "net_sentiment", "sentiment_entropy",
                    F.col("neutral_dominance_count").alias("neutral_dominance")))


def score_documents(requests: DataFrame, stats: DataFrame, sector: DataFrame, model,
                    keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Requests (doc_id, ticker, q_num) + their sentiment statistics + the
    ticker's industry (one per ticker, A9) -> prediction and probability of Up, with
    the fields the single-document response reports (dominance as fed to the
    model, net sentiment, industry, entropy). Every request comes out; one with a category the
    model does not know has a null prediction."""
    return predict(model, score_features(requests, stats, sector, keys), unseen="null").select(*keys, "ticker", "prediction", "probability_up",
                                        "neutral_dominance", "net_sentiment", "industry",
                                        "sentiment_entropy")
