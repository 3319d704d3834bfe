"""The corpus pipeline: toxicity, near-dedup, substring dedup, source mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's docs. Every stage but the last returns the columns of its docs.
Nulls, empty texts, repeated rows, empty tables and further columns are treated as the
stages' operators say.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlens.llm import bpe, mixing, simhash, substring, toxicity
from quarterlens.llm.common import table
from quarterlens.session import delete_folder, ensure_checkpoint_dir

TOXIC_FROM = 0.5            # documents that score this or more are rejected


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects toxic documents, by a model of the labelled ones that are still there."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"),
                                 TOXIC_FROM)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes passages of 13 words or more that an earlier document has out of the texts."""
    out = substring.remove_repeats(docs, window=13, n_words=None, n_removed=None)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target of its source asks for."""
    return mixing.mix(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to."""
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), "text",
                         public_tokenizers.path("byte_bpe_50k.tiktoken"),
                         public_tokenizers.PATTERN, decoded="decoded")
    return encoded.select(
        "doc_id", "lang", "source", F.col("decoded").cast("string").alias("text"), "n_tokens",
        "token_ids")


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_copies),
          ("substring_dedup", drop_repeated_passages), ("source_mix", mix_sources),
          ("byte_bpe", tokenise)]

# Learned scores, XXH64 fingerprints and BPE merges are beyond SQL; tests/llm holds the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``. What a stage returns is written to the shared folder and
    deleted once the next one's result is; the last result stays."""
    docs, read = table(spark, sf_dir, "documents"), None
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if read is not None:
            delete_folder(spark, read)
        read = path
    return docs
