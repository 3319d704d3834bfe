"""Per-document sentiment statistics.

Plan: scan (keys, text) -> ``posexplode_outer`` of the paragraph array -> score ->
one ``groupBy(keys)`` whose partial aggregation runs in the scan stage, so the
shuffle carries one partial row per document and partition, never paragraphs.
Documents without a usable paragraph survive the explode as one null row and come
out as the sentinel row: no join back to the document table.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterlens.functions.text import paragraphs

COUNT_COLUMNS = ["count_positive_chunks", "count_negative_chunks", "count_neutral_chunks"]
SCORE_COLUMNS = ["max_positive_score", "max_negative_score", "max_neutral_score",
                 "sum_positive", "sum_negative", "sum_neutral",
                 "avg_positive", "avg_negative", "avg_neutral"]
DERIVED_COLUMNS = ["net_sentiment", "neutral_dominance_score", "neutral_dominance_count",
                   "sentiment_entropy"]
STAT_COLUMNS = ["n_chunks"] + COUNT_COLUMNS + SCORE_COLUMNS + DERIVED_COLUMNS

# Fixed value that must equal the reference's: the dominance threshold.
NEUTRAL_DOMINANCE = 0.6
SENTINEL = -1.0


def explode_paragraphs(df: DataFrame, keys: Sequence[str], text_col: str,
                       outer: bool = True) -> DataFrame:
    """(keys..., pos, paragraph). ``outer`` keeps paragraph-less documents as one null row."""
    gen = F.posexplode_outer if outer else F.posexplode
    return df.select(*keys, gen(paragraphs(text_col)).alias("pos", "paragraph"))


def score_paragraphs(par: DataFrame, scorer, keys: Sequence[str],
                     balance_partitions: int | None = None) -> DataFrame:
    """Attach positive / negative / neutral.

    Native scorers run in place. Python scorers first hash-spread paragraphs over
    ``balance_partitions`` tasks by (keys, pos), so one huge filing is scored by
    many tasks instead of one.
    """
    if not getattr(scorer, "native", True):
        n = balance_partitions or int(par.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        par = par.repartition(n, *keys, "pos")
    return scorer.score(par, "paragraph")


def top_flags(p: Column, n: Column, u: Column) -> tuple[Column, Column, Column]:
    """E6 as three conditions (positive, negative, neutral): ties go to positive, then negative,
    then neutral; an unscored paragraph (null scores) is in no class."""
    pos = (p >= n) & (p >= u)
    neg = ~pos & (n >= u)
    return pos, neg, ~pos & ~neg


def aggregate_stats(scored: DataFrame, keys: Sequence[str], empty: str = "sentinel",
                    failures: bool = False) -> DataFrame:
    """E5-E10 per document.

    ``empty='sentinel'``: no chunk -> counts 0 and scores -1 (offline table form);
    ``empty='null'``: no chunk -> counts 0 and every score null (E10).
    Derived metrics (net, dominance, entropy) are null without chunks in both modes.
    ``failures`` adds ``failed_chunks``: paragraphs a skipping scorer left unscored
    (B5); such a document's other statistics are incomplete.
    """
    if empty not in ("sentinel", "null"):
        raise ValueError(empty)
    p, n, u = F.col("positive"), F.col("negative"), F.col("neutral")
    is_pos, is_neg, is_neu = top_flags(p, n, u)
    present = F.col("paragraph").isNotNull()
    agg = scored.groupBy(*keys).agg(
        F.count("paragraph").alias("n_chunks"),
        F.count_if(present & is_pos).alias("count_positive_chunks"),
        F.count_if(present & is_neg).alias("count_negative_chunks"),
        F.count_if(present & is_neu).alias("count_neutral_chunks"),
        F.max(p).alias("_max_p"), F.max(n).alias("_max_n"), F.max(u).alias("_max_u"),
        F.sum(p).alias("_sum_p"), F.sum(n).alias("_sum_n"), F.sum(u).alias("_sum_u"),
        *([F.count_if(F.col("paragraph").isNotNull() & p.isNull()).alias("failed_chunks")]
          if failures else []),
    )
    has = F.col("n_chunks") > 0
    fill = F.lit(SENTINEL) if empty == "sentinel" else F.lit(None).cast("double")

    def guarded(expr):
        return F.when(has, expr).otherwise(fill)

    cnt = F.col("n_chunks").cast("double")
    avg = {k: F.col(f"_sum_{k}") / cnt for k in ("p", "n", "u")}
    entropy = -(sum(F.when(a > 0, a * F.log2(a)).otherwise(F.lit(0.0)) for a in avg.values()))
    return agg.select(
        *keys, "n_chunks", *COUNT_COLUMNS,
        guarded(F.greatest(F.col("_max_p"), F.lit(0.0))).alias("max_positive_score"),
        guarded(F.greatest(F.col("_max_n"), F.lit(0.0))).alias("max_negative_score"),
        guarded(F.greatest(F.col("_max_u"), F.lit(0.0))).alias("max_neutral_score"),
        guarded(F.col("_sum_p")).alias("sum_positive"),
        guarded(F.col("_sum_n")).alias("sum_negative"),
        guarded(F.col("_sum_u")).alias("sum_neutral"),
        guarded(avg["p"]).alias("avg_positive"),
        guarded(avg["n"]).alias("avg_negative"),
        guarded(avg["u"]).alias("avg_neutral"),
        F.when(has, (F.col("_sum_p") - F.col("_sum_n")) / cnt).alias("net_sentiment"),
        F.when(has, avg["u"] > NEUTRAL_DOMINANCE).alias("neutral_dominance_score"),
        F.when(has, F.col("count_neutral_chunks") / cnt > NEUTRAL_DOMINANCE).alias("neutral_dominance_count"),
        F.when(has, entropy).alias("sentiment_entropy"),
        *(["failed_chunks"] if failures else []),
    )


def sentiment_stats(docs: DataFrame, scorer, keys: Sequence[str] = ("doc_id",),
                    text_col: str = "text", empty: str = "sentinel",
                    balance_partitions: int | None = None, failures: bool = False) -> DataFrame:
    """Documents -> one statistics row per document (sentinel rows included).

    ``failures`` adds the ``failed_chunks`` column (see :func:`aggregate_stats`).
    """
    keys = list(keys)
    par = explode_paragraphs(docs, keys, text_col, outer=True)
    scored = score_paragraphs(par, scorer, keys, balance_partitions)
    return aggregate_stats(scored, keys, empty, failures)


def skips_failures(scorer) -> bool:
    """True for a scorer that leaves failing paragraphs unscored instead of raising."""
    return getattr(scorer, "on_error", "raise") == "skip"


def averages_only(docs: DataFrame, scorer, keys: Sequence[str] = ("doc_id",),
                  text_col: str = "text") -> DataFrame:
    """The quarterly variant keeping three averages, null when no chunk."""
    full = sentiment_stats(docs, scorer, keys, text_col, empty="null")
    return full.select(*keys, "avg_positive", "avg_negative", "avg_neutral")

