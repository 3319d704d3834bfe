"""Registered training-table, split, scaling, encoding, profile and model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterlens.functions.quarters import quarter_start
from quarterlens.operators.boosting import (best_splits, binned_rows, fit_boosted_trees,
                                            quantile_cuts, with_gradients)
from quarterlens.operators.dense_net import fit_dense_net
from quarterlens.operators.features import (MinMaxScaling, OneHotEncoding, StandardScaling,
                                            hash_split)
from quarterlens.operators.profile import column_profile
from quarterlens.operators.rowindex import positional_split
from quarterlens.operators.scoring import demo_scorer
from quarterlens.operators.sentiment import sentiment_stats
from quarterlens.plans import stand_ins
from quarterlens.plans import training as TR
from quarterlens.plans.model_store import ModelStore
from quarterlens.plans.q_index import SECTOR_SQL, sector_dim
from quarterlens.plans.q_prices import QOQ_SQL, quarterly_prices
from quarterlens.plans.q_sentiment import STATS_SQL
from quarterlens.plans.registry import register, rounded
from quarterlens.plans.sentiment import sentiment_export
from quarterlens.session import cut_lineage
from quarterlens.plans import prices as P
from quarterlens.sources.tables import read_table


def _doc_keys(spark, sf):
    """Each document is the filing of one order's customer in that order's quarter."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    return o.select(F.col("o_orderkey").alias("doc_id"), F.col("o_custkey").cast("string").alias("ticker"),
                    quarter_start("o_orderdate").alias("quarter_start"),
                    F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string")).alias("q"),
                    F.year("o_orderdate").alias("year"))


def _stats(spark, sf):
    return sentiment_stats(stand_ins.documents(spark, sf), demo_scorer())


def training_rows(spark, sf):
    """N15 on the stand-ins, rounded once so every downstream query sees the same values."""
    stock = P.quarter_over_quarter(quarterly_prices(spark, sf)).filter(F.col("up_or_down").isNotNull())
    sent = TR.sentiment_train(_stats(spark, sf), _doc_keys(spark, sf).select("doc_id", "ticker", "quarter_start"))
    return rounded(TR.training_table(stock, sector_dim(spark, sf), sent))


TRAIN_SQL = f"""
WITH st AS ({STATS_SQL}),
dk AS (SELECT o_orderkey AS doc_id, o_custkey::VARCHAR AS ticker,
              date_trunc('quarter', o_orderdate)::DATE AS quarter_start FROM orders),
sent AS (SELECT dk.ticker, dk.quarter_start, st.net_sentiment,
                count_positive_chunks + count_negative_chunks + count_neutral_chunks AS total,
                count_neutral_chunks / (count_positive_chunks + count_negative_chunks + count_neutral_chunks) AS share
         FROM st JOIN dk ON st.doc_id = dk.doc_id),
s2 AS (SELECT DISTINCT ticker, quarter_start, share > 0.6 AS neutral_dominance, net_sentiment
       FROM sent WHERE coalesce(total <> 0, true)),
qoq AS ({QOQ_SQL}),
stock AS (SELECT ticker, quarter, quarter_start, up_or_down FROM qoq WHERE up_or_down IS NOT NULL),
sec AS ({SECTOR_SQL}),
p AS (SELECT stock.*, sec.industry, nullif(regexp_extract(stock.quarter, 'Q([1-4])', 1), '') AS q_num
      FROM stock LEFT JOIN sec ON stock.ticker = sec.ticker)
SELECT p.ticker, p.quarter, p.quarter_start, p.q_num, p.industry, round(s2.net_sentiment, 6) AS net_sentiment,
       s2.neutral_dominance, CASE p.up_or_down WHEN 'Up' THEN 1 WHEN 'Down' THEN 0 END AS label
FROM p LEFT JOIN s2 ON p.quarter_start = s2.quarter_start AND p.ticker = s2.ticker
WHERE s2.net_sentiment IS NOT NULL"""


@register("training_table", TRAIN_SQL)
def q_training_table(spark, sf):
    """prices' Up/Down label + industry + quarter number + sentiment features."""
    return training_rows(spark, sf)


HASH_SQL = f"""
WITH t AS ({TRAIN_SQL}),
h AS (SELECT *, ('0x' || substr(md5(ticker || '|' || quarter), 1, 8))::BIGINT % 10000 AS hb FROM t)
SELECT *, CASE WHEN hb < 1500 THEN 'test' WHEN hb < 2350 THEN 'val' ELSE 'train' END AS split FROM h"""


@register("hash_split", f"SELECT ticker, quarter, quarter_start, label, split FROM ({HASH_SQL})")
def q_hash_split(spark, sf):
    """K6: 15 % test, then 10 % of the rest validation, by md5 of (ticker, quarter)."""
    return hash_split(training_rows(spark, sf), ["ticker", "quarter"]).select(
        "ticker", "quarter", "quarter_start", "label", "split")


ORDER = ["quarter_start", "ticker", "net_sentiment", "neutral_dominance", "label", "industry"]
POS_SQL = f"""
WITH t AS ({TRAIN_SQL}),
r AS (SELECT *, row_number() OVER (ORDER BY {', '.join(ORDER)}) - 1 AS row_index, count(*) OVER () AS n FROM t)
SELECT *, CASE WHEN row_index < floor(n * 0.6) THEN 'train' WHEN row_index < floor(n * 0.8) THEN 'val'
               ELSE 'test' END AS split FROM r"""


@register("positional_split", f"SELECT ticker, quarter, quarter_start, row_index, split FROM ({POS_SQL})")
def q_positional_split(spark, sf):
    """60 / 20 / 20 by position in (quarter_start, ticker, ...) order,
    with a distributed row index (no single-partition window)."""
    return positional_split(training_rows(spark, sf), ORDER).select(
        "ticker", "quarter", "quarter_start", "row_index", "split")


@register("minmax", f"""
WITH h AS ({HASH_SQL}),
m AS (SELECT min(net_sentiment) AS lo, max(net_sentiment) AS hi FROM h WHERE split = 'train')
SELECT ticker, quarter, quarter_start, split,
       round(CASE WHEN hi = lo THEN 0.0 ELSE (net_sentiment - lo) / (hi - lo) END, 6) AS net_sentiment_scaled
FROM h, m""")
def q_minmax(spark, sf):
    """K1: min-max scaling fitted on the training split, applied to every row."""
    h = hash_split(training_rows(spark, sf), ["ticker", "quarter"])
    sc = MinMaxScaling(["net_sentiment"]).fit_lazy(h.filter(F.col("split") == "train"))
    return rounded(sc.transform(h).select("ticker", "quarter", "quarter_start", "split",
                                          "net_sentiment_scaled"))


@register("standardize", f"""
WITH p AS ({POS_SQL}),
m AS (SELECT avg(net_sentiment) AS mu, stddev_pop(net_sentiment) AS sd FROM p WHERE split = 'train')
SELECT ticker, quarter, quarter_start, split,
       round((net_sentiment - mu) / CASE WHEN sd = 0 THEN 1.0 ELSE sd END, 6) AS net_sentiment_std
FROM p, m""")
def q_standardize(spark, sf):
    """K2: standard scaling (population deviation) fitted on the positional training split."""
    p = positional_split(training_rows(spark, sf), ORDER)
    sc = StandardScaling(["net_sentiment"]).fit_lazy(p.filter(F.col("split") == "train"))
    return rounded(sc.transform(p).select("ticker", "quarter", "quarter_start", "split", "net_sentiment_std"))


@register("onehot", f"""
WITH t AS ({TRAIN_SQL}),
c AS (SELECT list(DISTINCT industry ORDER BY industry) AS ci, list(DISTINCT q_num ORDER BY q_num) AS cq FROM t)
SELECT ticker, quarter, quarter_start, industry, q_num, array_to_string(list_concat(
    list_transform(CASE WHEN len(ci) = 2 THEN ci[2:] ELSE ci END, lambda x: CASE WHEN industry = x THEN '1' ELSE '0' END),
    list_transform(CASE WHEN len(cq) = 2 THEN cq[2:] ELSE cq END, lambda x: CASE WHEN q_num = x THEN '1' ELSE '0' END)),
  ',') AS onehot
FROM t, c""")
def q_onehot(spark, sf):
    """K3: one-hot of industry and quarter number (sorted categories, first dropped
    when a column has exactly two)."""
    t = cut_lineage(training_rows(spark, sf))  # one category job per column, then the transform
    enc = OneHotEncoding(["industry", "q_num"]).fit(t)
    v = enc.transform(t)
    return v.select("ticker", "quarter", "quarter_start", "industry", "q_num",
                    F.array_join(F.transform("onehot", lambda x: x.cast("int").cast("string")), ",")
                    .alias("onehot"))


_PROFILE_COLS = [("doc_id", "bigint"), ("lang", "string"), ("quality", "int"), ("toxic", "int")]


@register("profile_nonnull", """
WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
""" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null, "
                         f"count(*) AS n_rows FROM j" for c, t in _PROFILE_COLS))
def q_profile_nonnull(spark, sf):
    """E11 + E12: type and non-null count of every column, in one pass."""
    d = read_table(spark, sf, "documents", ["doc_id", "lang"])
    lab = read_table(spark, sf, "labels", ["doc_id", "quality", "toxic"])
    return column_profile(d.join(lab, "doc_id", "left").select("doc_id", "lang", "quality", "toxic"))


@register("sentiment_export", f"""
WITH st AS ({STATS_SQL})
SELECT o_custkey::VARCHAR AS ticker, 'Q' || quarter(o_orderdate) || '-' || right(year(o_orderdate)::VARCHAR, 2)
       AS quarter_year, st.net_sentiment
FROM st LEFT JOIN orders ON st.doc_id = orders.o_orderkey""")
def q_sentiment_export(spark, sf):
    """(ticker, quarter, year) statistics exported as (ticker, quarter_year, net)."""
    s = _stats(spark, sf).join(_doc_keys(spark, sf), "doc_id", "left")
    return rounded(sentiment_export(s.select("ticker", F.col("q").alias("quarter"), "year", "net_sentiment")))


def _fit(spark, sf):
    rows = cut_lineage(hash_split(training_rows(spark, sf), ["ticker", "quarter"]))
    model = TR.fit_model(rows.filter(F.col("split") == "train"))
    return rows, model


@register("gbt_accuracy")
def q_gbt_accuracy(spark, sf):
    """N16 / K5 + K9: boosted trees (100, rate 0.02) on the hash-split training rows;
    test accuracy next to the majority-class baseline. Rows-only check."""
    rows, model = _fit(spark, sf)
    return TR.evaluate(model, rows.filter(F.col("split") == "test"), rows)


def _requests(spark, sf):
    """One request per document; a document without an order has no ticker and quarter."""
    keys = _doc_keys(spark, sf).select("doc_id", "ticker", F.substring("q", 2, 1).alias("q_num"))
    return read_table(spark, sf, "documents", ["doc_id"]).join(keys, "doc_id", "left")


@register("score_documents")
def q_score_documents(spark, sf):
    """Every document scored: sentiment -> features -> model -> Up probability. The model
    is fitted once per input and kept, with its preprocessing, in the checkpoint folder (K11)."""
    return TR.score_documents(_requests(spark, sf), _stats(spark, sf), sector_dim(spark, sf),
                              _saved_model(spark, sf))


def _saved_model(spark, sf):
    """The pipeline fitted on this input, loaded if one with the same training rows is stored."""
    rows = cut_lineage(hash_split(training_rows(spark, sf), ["ticker", "quarter"]))
    train = rows.filter(F.col("split") == "train")
    return ModelStore.of_session(spark).get_or_fit("up_down", train, TR.FIT,
                                                   lambda: TR.fit_model(train, **TR.FIT))


BOOST = dict(rounds=10, rate=0.02, depth=6, max_bins=64)


def boost_features(train, rows_):
    """Numeric features of the trees: sentiment, dominance, and one indicator a category (a null
    category has none). (rows with the features, their names, with two digits to sort by)."""
    one = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    industries = sorted(r[0] for r in train.select("industry").distinct().collect() if r[0] is not None)
    made = {"net_sentiment": F.col("net_sentiment"),
            "neutral_dominance": F.col("neutral_dominance").cast("double"),
            **{f"q_num={q}": one(F.col("q_num") == str(q)) for q in (1, 2, 3, 4)},
            **{f"industry={i}": one(F.col("industry") == i) for i in industries}}
    names = [f"f{k}" for k in range(len(made))]
    return rows_.withColumns(dict(zip(names, made.values()))), names, list(made)


@register("boosted_trees")
def q_boosted_trees(spark, sf):
    """K5 + K8: second-order boosted trees fitted on the training part, and the probability of Up
    of every row; the same numbers as a plain version in the tests."""
    h = cut_lineage(hash_split(training_rows(spark, sf), ["ticker", "quarter"]))
    train = h.filter(F.col("split") == "train")
    featured, names, _ = boost_features(train, h)
    model = fit_boosted_trees(featured.filter(F.col("split") == "train"), names, **BOOST)
    return rounded(model.transform(featured).select("ticker", "quarter", "quarter_start", "split",
                                                    "label", "probability_up"))


@register("boosted_first_round", f"""
WITH h AS ({HASH_SQL}),
t AS (SELECT * FROM h WHERE split = 'train' AND label IS NOT NULL),
ind AS (SELECT DISTINCT industry FROM h WHERE split = 'train' AND industry IS NOT NULL),
x AS (SELECT 'net_sentiment' AS feature, 0 AS rank, '' AS name, net_sentiment::DOUBLE AS v, label FROM t
  UNION ALL SELECT 'neutral_dominance', 1, '', neutral_dominance::INT::DOUBLE, label FROM t
  UNION ALL SELECT 'q_num=' || q, 1 + q, '', coalesce(q_num = q::VARCHAR, false)::INT::DOUBLE, label
            FROM t, range(1, 5) r(q)
  UNION ALL SELECT 'industry=' || ind.industry, 6, ind.industry,
            coalesce(t.industry = ind.industry, false)::INT::DOUBLE, label FROM t, ind),
o AS (SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY v) AS nth,
             count(*) OVER (PARTITION BY feature) AS n FROM x WHERE v IS NOT NULL),
q AS (SELECT DISTINCT o.feature, o.v FROM o, range(0, {BOOST['max_bins'] + 1}) r(i)
      WHERE o.nth = greatest(1, ceil(i / {BOOST['max_bins']}.0 * o.n))),
c AS (SELECT feature, v AS cut, row_number() OVER (PARTITION BY feature ORDER BY v) - 1 AS bin FROM q),
b AS (SELECT x.feature, any_value(x.rank) AS rank, any_value(x.name) AS name, x.v, x.label, count(*) AS w,
             CASE WHEN x.v IS NULL THEN -1
                  ELSE (SELECT count(*) FROM c WHERE c.feature = x.feature AND c.bin > 0 AND c.cut <= x.v) END AS bin
      FROM x GROUP BY x.feature, x.v, x.label),
s AS (SELECT feature, any_value(rank) AS rank, any_value(name) AS name, bin,
             sum(w * (0.5 - label))::DOUBLE AS g, sum(w * 0.25)::DOUBLE AS h FROM b GROUP BY feature, bin),
k AS (SELECT *, sum(g) OVER p AS ga, sum(h) OVER p AS ha,
             coalesce(sum(g) FILTER (bin >= 0) OVER lo, 0) AS gl, coalesce(sum(h) FILTER (bin >= 0) OVER lo, 0) AS hl,
             coalesce(sum(g) FILTER (bin < 0) OVER p, 0) AS gm, coalesce(sum(h) FILTER (bin < 0) OVER p, 0) AS hm,
             coalesce(count(*) FILTER (bin >= 0) OVER lo, 0) AS below
      FROM s WINDOW p AS (PARTITION BY feature),
                    lo AS (PARTITION BY feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
side AS (SELECT k.*, d AS default_left, gl + CASE WHEN d THEN gm ELSE 0 END AS g1,
                hl + CASE WHEN d THEN hm ELSE 0 END AS h1 FROM k, (VALUES (false), (true)) AS v(d)
         WHERE bin >= 0 AND below > 0),
gain AS (SELECT *, (g1 * g1 / (h1 + 1) + (ga - g1) * (ga - g1) / (ha - h1 + 1) - ga * ga / (ha + 1)) / 2 AS gain
         FROM side WHERE h1 >= 1 AND ha - h1 >= 1),
best AS (SELECT *, row_number() OVER (ORDER BY round(gain, 9) DESC, rank, name, bin, default_left) AS nth
         FROM gain WHERE gain > 0)
SELECT best.feature, c.cut, best.default_left, round(best.gain, 6) AS gain, round(best.ga, 6) AS gradient,
       round(best.ha, 6) AS hessian, round(-g1 / (h1 + 1), 6) AS left_weight,
       round(-(ga - g1) / (ha - h1 + 1), 6) AS right_weight
FROM best JOIN c ON c.feature = best.feature AND c.bin = best.bin WHERE nth = 1""")
def q_boosted_first_round(spark, sf):
    """K5, first round: the root's best split of all features, bins and sides of missing values,
    its gain, and the weights that its two sides would have."""
    h = cut_lineage(hash_split(training_rows(spark, sf), ["ticker", "quarter"]))
    train = h.filter(F.col("split") == "train")
    featured, names, full = boost_features(train, train)
    cuts = quantile_cuts(featured.filter(F.col("label").isNotNull()), names, BOOST["max_bins"])
    data = cut_lineage(binned_rows(featured, names, "label", cuts))
    data = with_gradients(data.withColumn("margin", F.lit(0.0))).withColumn("node", F.lit(0))
    best = best_splits(data, 1.0, 0.0, 1.0).filter(F.col("gain").isNotNull())
    weight = lambda g, h: -g / (h + 1)
    cut = F.array(*[F.array(*[F.lit(float(x)) for x in c]) if c else F.array().cast("array<double>")
                    for c in cuts])
    return rounded(best.select(
        F.array(*[F.lit(n) for n in full])[F.col("feature")].alias("feature"),
        cut[F.col("feature")][F.col("bin") - 1].alias("cut"), "default_left", "gain",
        F.col("g").alias("gradient"), F.col("h").alias("hessian"),
        weight(F.col("g_left"), F.col("h_left")).alias("left_weight"),
        weight(F.col("g") - F.col("g_left"), F.col("h") - F.col("h_left")).alias("right_weight")))


@register("score_features", f"""
WITH st AS ({STATS_SQL}),
dk AS (SELECT o_orderkey AS doc_id, o_custkey::VARCHAR AS ticker, quarter(o_orderdate)::VARCHAR AS q_num FROM orders),
sec AS (SELECT ticker, min(industry) AS industry FROM ({SECTOR_SQL}) GROUP BY ticker)
SELECT d.doc_id, dk.ticker, dk.q_num, sec.industry, st.net_sentiment, st.sentiment_entropy,
       st.neutral_dominance_count AS neutral_dominance
FROM documents d LEFT JOIN dk ON d.doc_id = dk.doc_id LEFT JOIN st ON d.doc_id = st.doc_id
LEFT JOIN sec ON dk.ticker = sec.ticker""")
def q_score_features(spark, sf):
    """N17 before the model (A9, K4, K12): the inputs of every document's request."""
    return rounded(TR.score_features(_requests(spark, sf), _stats(spark, sf), sector_dim(spark, sf)))


@register("split_counts", f"SELECT split, count(*) AS n_rows, count(label) AS n_labelled FROM ({HASH_SQL}) GROUP BY split")
def q_split_counts(spark, sf):
    """K6: rows and labelled rows of each part of the hash split."""
    h = hash_split(training_rows(spark, sf), ["ticker", "quarter"])
    return h.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.count("label").alias("n_labelled"))


@register("label_baseline", f"""
SELECT count(*) AS n_rows, round(greatest(avg(label), 1 - avg(label)), 6) AS baseline
FROM ({TRAIN_SQL}) WHERE label IS NOT NULL""")
def q_label_baseline(spark, sf):
    """K9: the majority-class share that a model has to beat."""
    return rounded(TR.label_baseline(training_rows(spark, sf)))


# A fixed linear model for the deterministic part of evaluation.
FIXED_MODEL = {"net_sentiment": 2.5, "q_num=1": 0.4, "q_num=3": -0.7, "neutral_dominance=true": 0.9}
FIXED_INTERCEPT = -0.15


@register("fixed_model_accuracy", f"""
WITH h AS ({HASH_SQL}),
z AS (SELECT label, 2.5 * net_sentiment + CASE WHEN q_num = '1' THEN 0.4 ELSE 0 END
        - CASE WHEN q_num = '3' THEN 0.7 ELSE 0 END + CASE WHEN neutral_dominance THEN 0.9 ELSE 0 END
        - 0.15 AS z FROM h WHERE split = 'test' AND label IS NOT NULL)
SELECT count(*) AS n_test, round(avg(CASE WHEN (CASE WHEN 1 / (1 + exp(-z)) > 0.5 THEN 1 ELSE 0 END) = label
                                     THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM z""")
def q_fixed_model_accuracy(spark, sf):
    """K8 + E13: prediction by given coefficients and its accuracy on the test part."""
    h = hash_split(training_rows(spark, sf), ["ticker", "quarter"])
    return rounded(TR.accuracy(TR.predict_fixed(h.filter(F.col("split") == "test"), FIXED_MODEL,
                                                FIXED_INTERCEPT)))


@register("mlp_accuracy")
def q_mlp_accuracy(spark, sf):
    """The small dense network on the same split; accuracy and baseline. Rows-only."""
    rows_ = cut_lineage(hash_split(training_rows(spark, sf), ["ticker", "quarter"]))
    model = TR.fit_mlp(rows_.filter(F.col("split") == "train"))
    return TR.evaluate(model, rows_.filter(F.col("split") == "test"), rows_)


NET = dict(epochs=2, batch_rows=256, rate=0.01)


@register("dense_net")
def q_dense_net(spark, sf):
    """K10 + K8: the ReLU network trained by Adam on the training part, and the probability of Up
    of every row; the same numbers as a single-process version in the tests."""
    h = cut_lineage(hash_split(training_rows(spark, sf), ["ticker", "quarter"]))
    train = h.filter(F.col("split") == "train")
    featured, names, _ = boost_features(train, h)
    keys = ["ticker", "quarter", "net_sentiment", "neutral_dominance"]
    model = fit_dense_net(featured.filter(F.col("split") == "train"), names, keys, **NET)
    return rounded(model.transform(featured).select("ticker", "quarter", "quarter_start", "split",
                                                    "label", "probability_up"))
