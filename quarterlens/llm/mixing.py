"""Mixing sources to target weights. DataFrame functions only.

Sizes are summed per source (a partial sum in each task, so a hot source sends one row per task).
A source's share of the total is proportional to its weight, but its target stops at
``max_epochs`` times its size, and what is cut off is shared again by weight among the others
until none is above: target = min(cap, weight * level) for the one level at which the targets add
up to the total. With the sources ordered by cap / weight, the level is the largest of
(total - caps before) / (weights from here on), so no iteration is needed.

A document comes out floor(rate) times, rate = target / size of its source, plus once more if a
uniform number made from the MD5 of seed, id and text is below the fraction: the same documents
in every run and on every cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarterlens.llm.common import WORD, checkpointed, fresh

WEIGHTS = (5.0, 2.0, 1.0)
BROADCAST_BYTES = 4 << 20      # rates are broadcast only if they are no larger than this


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: str, *columns: str) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of the columns' text."""
    key = F.concat(F.lit(seed), *[F.concat(F.lit(":"), F.coalesce(F.col(c).cast("string"),
                                                                  F.lit(""))) for c in columns])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS,
                   max_epochs: float = 3.0) -> DataFrame:
    """(source, source_size, target, rate) from rows (source, size).

    Sources in order of code points, null last, take the weights in turn. One row per source
    goes through unpartitioned windows. If there are no words at all, every target is 0.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = F.row_number().over(order) - 1
    s = s.withColumn("w", F.element_at(F.array(*map(F.lit, weights)),
                                       (nth % len(weights) + 1).cast("int"))) \
        .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0.0))
    left = F.sum("w").over(fill.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("level", (F.sum("source_size").over(whole) - before) / left)
    s = s.withColumn("target", F.least("cap", F.col("w") * F.max("level").over(whole)))
    rate = F.when(F.col("source_size") > 0,
                  F.least(F.col("target") / F.col("source_size"), F.lit(float(max_epochs))))
    return s.select("source", "source_size", "target", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def plan(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text",
         weights: Sequence[float] = WEIGHTS, max_epochs: float = 3.0, seed: str = "mix",
         names: Sequence[str] = ("size", "source_size", "target", "copies")) -> DataFrame:
    """``docs`` plus its size, its source's size and target, and how often it is to be emitted.

    Null text: size 0. A null source is a source of its own. A null id counts as an empty text
    in the draw; rows equal in id and text share one draw. Sources without words have target 0.
    An empty table gives an empty result.
    """
    size, source_size, target, copies = names
    src, rate = fresh([*docs.columns, *names], "source", "rate")
    targets = checkpointed(source_targets(
        docs.select(F.col(source).alias("source"), word_count(text).alias("size")),
        weights, max_epochs)).select(F.col("source").alias(src),
                                     F.col("source_size").alias(source_size),
                                     F.col("target").alias(target), F.col("rate").alias(rate))
    held = targets.agg(F.sum(F.coalesce(F.octet_length(src), F.lit(0)) + 64)).first()[0] or 0
    if held <= BROADCAST_BYTES:
        targets = F.broadcast(targets)
    extra = (uniform(seed, id_col, text) < F.col(rate) - F.floor(rate)).cast("long")
    return docs.withColumn(size, word_count(text)) \
        .join(targets, F.col(source).eqNullSafe(F.col(src))) \
        .withColumn(copies, F.floor(rate).cast("long") + extra).drop(src, rate)


def mix(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text",
        weights: Sequence[float] = WEIGHTS, max_epochs: float = 3.0,
        seed: str = "mix") -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as ``plan`` says, columns unchanged."""
    names = fresh(docs, "size", "source_size", "target", "copies")
    nth, = fresh([*docs.columns, *names], "nth")
    planned = plan(docs, id_col, source, text, weights, max_epochs, seed, names)
    return planned.where(F.col(names[3]) > 0).withColumn(
        nth, F.explode(F.sequence(F.lit(1).cast("long"), F.col(names[3])))).select(*docs.columns)


SQL = """
WITH d AS (
  SELECT doc_id, source,
         CAST(CASE WHEN text IS NULL THEN 0
              ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS BIGINT) AS size,
         CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':'
              || coalesce(text, '')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]
        ::DOUBLE AS w, source_size * 3.0::DOUBLE AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER ()
        - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY cap / w, source NULLS LAST
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT *, least(cap, w * max(level) OVER ()) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0) ELSE 0 END AS rate
      FROM t)
SELECT d.doc_id, d.size, r.source_size, r.target,
       CAST(d.size * (floor(r.rate) + CASE WHEN d.u < r.rate - floor(r.rate) THEN 1 ELSE 0 END)
            AS BIGINT) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
"""
