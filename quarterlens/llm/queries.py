"""The registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame.

Each applies one operator, with production parameters, to its whole table and derives the
columns of its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from quarterlens.llm import (bpe, chat, crosstok, hnsw, langid, lines, mixing, pq, repair,
                             simhash, substring, toxicity, urls)
from quarterlens.llm.common import sha256_hex, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"),
                                   shingle=4, max_bits=4) \
        .select("doc_id", "fingerprint", "component_id")


@register("op2_hnsw_nearest")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"),
                        F.col("vec_id") % 100 == 0, k=10)


@register("op3_substring_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"),
                                    window=13) \
        .select("doc_id", "n_words", "n_removed", sha256_hex(F.col("text")).alias("kept_sha256"))


# (verdict, rule): the longest rule that fits decides.
URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/"))


@register("op4_url_filter")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages", "page_id", "url", "html"), URL_RULES) \
        .select("page_id", "host", "path", "rule", "verdict")


@register("op5_source_mix", mixing.SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents", "doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"))


@register("op6_byte_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents", "doc_id", "text"), "text",
                      public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                      decoded="decoded").select(
        "doc_id", "n_tokens", sha256_hex(F.col("token_ids")).alias("ids_sha256"),
        sha256_hex(F.col("decoded")).alias("decoded_sha256"))


@register("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (their source stands for the host) and pages; the other table's id is null."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    none = F.lit(None)
    items = docs.select("doc_id", none.cast("long").alias("page_id"), "text",
                        none.cast("string").alias("declared"), F.col("source").alias("host")) \
        .union(pages.select(none.cast("long"), "page_id",
                            langid.markup_text(F.col("html")),
                            langid.declared_language(F.col("html")),
                            urls.host_of(F.col("url"))))
    return langid.identify(items, langid.train_text(docs), ["doc_id", "page_id"])


@register("op8_pq_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"),
                              cosine=0.98)


@register("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.with_score(docs, model).select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op10_chat_format", chat.SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one (-1) whose texts are control strings."""
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(chat.PLANTED).alias("text"))
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").union(planted)
    done = chat.read_back(chat.format_chat(rows.withColumn("parts", chat.text_part("text"))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        sha256_hex(said).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        sha256_hex(F.col("loss_text")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@register("op11_tokenizer_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = crosstok.align(table(spark, sf_dir, "documents", "doc_id", "text"),
                             public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.PATTERN,
                             public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") > 0, sha256_hex(F.col("groups"))).otherwise("")
    return crosstok.with_link_counts(
        aligned.withColumn("groups_sha256", digest).drop("groups")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@register("op12_conversation_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    done = repair.repair(repair.damage(rows))
    lines_of = repair.digests(done.rows, "conv_id", "place",
                              F.concat("role", F.lit(":"), "text"), "repaired_sha256")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    ids = rows.select("conv_id").distinct()
    for part in (done.conversations, lines_of):
        own = part.withColumnRenamed("conv_id", "of")
        ids = ids.join(own, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    return ids.select("conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts),
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))
                      .alias("repaired_sha256"))


@register("op13_line_dedup", lines.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_repeated_lines(table(spark, sf_dir, "documents", "doc_id", "text"),
                                     min_chars=10) \
        .select("doc_id", "n_lines", "n_dropped", sha256_hex(F.col("text")).alias("kept_sha256"))
