"""Language identification by Bayesian evidence fusion.

The posterior of a language is proportional to
  text likelihood (byte trigrams, naive Bayes) x P(declared markup language | language)
  x P(address suffix | language) x P(language | host).

* The trigram model is fitted on a bounded sample of labelled texts (``SAMPLE`` rows of smallest
  id hash). A text's likelihood counts as at most ``EVIDENCE`` trigrams, as neighbouring trigrams
  are far from independent; short texts are thus open to the other evidence.
* The other tables are grouped counts over all items, by the language of their text alone: how
  often a declared language or a suffix goes with a language, and the languages of a host, smoothed
  towards those of its domain, which are smoothed towards those of all items. An item's
  own vote is taken out of its host's and domain's counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterlens.llm.common import checkpointed, with_python_columns

SAMPLE = 20_000
BUCKETS = 1 << 14           # hashed trigrams
EVIDENCE = 60.0
CHUNK = 1 << 22             # bytes of a text looked at together
SMOOTH_HOST, SMOOTH_DOMAIN = 5.0, 20.0
_KEEP = np.zeros(256, np.uint8)      # letters and bytes of letters; everything else is a space
_KEEP[:] = 32
for _c in range(26):
    _KEEP[65 + _c] = _KEEP[97 + _c] = 97 + _c
_KEEP[128:] = np.arange(128, 256)
_TAGS = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"


def trigrams(text: bytes) -> np.ndarray:
    """Counts of hashed byte trigrams; runs of other characters count as one space."""
    out = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(text), CHUNK):
        b = _KEEP[np.frombuffer(text, np.uint8, min(CHUNK + 2, len(text) - at), at)]
        b = b[np.r_[True, (b[1:] != 32) | (b[:-1] != 32)]].astype(np.uint32)
        if len(b) >= 3:
            h = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)
            out += np.bincount(h >> np.uint32(18), minlength=BUCKETS)
    return out


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count: dict[str, np.ndarray] = {}
    for b in batches:
        texts = b.column(0).cast(pa.large_binary()).to_pylist()
        for text, lang in zip(texts, b.column(1).to_pylist()):
            if lang not in count:
                count[lang] = np.zeros(BUCKETS, np.int64)
            count[lang] += trigrams(text or b"")
    for lang, c in count.items():
        at = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
             pa.array(c[at])], names=["lang", "bucket", "n"])


class TextModel:
    """Log probabilities of hashed trigrams, one column a language."""

    def __init__(self, languages: list[str], log_p: np.ndarray) -> None:
        self.languages, self.log_p = languages, log_p

    def log_likelihood(self, text: bytes) -> np.ndarray:
        c = trigrams(text)
        n = c.sum()
        at = np.flatnonzero(c)
        return (c[at] @ self.log_p[at]) * (min(n, EVIDENCE) / n) if n else \
            np.zeros(len(self.languages))


def held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def train_text(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
               lang: str = "lang") -> TextModel:
    """Fits the trigram model on labelled rows that are not held out (null labels: left out)."""
    known = docs.where(F.col(lang).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    ids = known.select(F.col(id_col).alias("id")).distinct() \
        .orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    rows = known.join(F.broadcast(ids), F.col(id_col) == F.col("id")) \
        .select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    found = rows.mapInArrow(_count_trigrams, "lang string, bucket int, n long") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(found.column("lang").to_pylist()))
    counts = np.full((BUCKETS, len(languages)), 0.5)
    column = {lg: i for i, lg in enumerate(languages)}
    np.add.at(counts, (found.column("bucket").to_numpy(),
                       [column[x] for x in found.column("lang").to_pylist()]),
              found.column("n").to_numpy())
    return TextModel(languages, np.log(counts / counts.sum(0)))


def declared_language(html: Column) -> Column:
    """Primary subtag of the language attribute of the html element, or null."""
    tag = F.regexp_extract(html, r"""(?i)<html\b[^>]*?\slang\s*=\s*["']?([a-z]+)""", 1)
    return F.when(tag != "", F.lower(tag))


def markup_text(html: Column) -> Column:
    return F.regexp_replace(html, _TAGS, " ")


def suffix_of(host: Column) -> Column:
    return F.when(host.contains("."), F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The last two labels."""
    return F.when(host.isNotNull() & (host != ""), F.substring_index(host, ".", -2))


def _votes(languages: list[str]) -> list[Column]:
    return [F.sum((F.col("text_at") == i).cast("long")).alias(f"v{i}")
            for i in range(len(languages))]


def _counts(items: DataFrame, column: str, languages: list[str]) -> DataFrame:
    """(key, votes): votes of the texts for each language, by the values of a column."""
    grouped = items.where(F.col(column).isNotNull() & (F.col("text_at") >= 0)) \
        .groupBy(F.col(column).alias(f"{column}_key")).agg(*_votes(languages))
    return checkpointed(grouped.select(f"{column}_key", F.array(
        *[f"v{i}" for i in range(len(languages))]).alias(f"{column}_votes")))


def identify(items: DataFrame, model: TextModel, key: list[str], text: str = "text",
             declared: str = "declared", host: str = "host") -> DataFrame:
    """One row per row of ``items``: the ``key`` columns, lang, score (its posterior), text_lang.

    declared and host may be null; unknown evidence takes no part. Null or empty texts, and texts
    without letters, are judged by the other evidence (text_lang null); with none at all by the
    shares of all items. Ties go to the language first in order. Without any language, lang is
    null. Repeated rows repeat and count. An empty table gives an empty result.
    """
    languages = model.languages
    n_lang = len(languages)
    base = items.select(*key, F.col(text).alias("text"),
                        F.lower(F.col(declared)).alias("declared"),
                        F.lower(F.col(host)).alias("host"))

    def read(cols: list[pa.Array]) -> list[pa.Array]:
        like, at = [], []
        for t in cols[0].cast(pa.large_binary()).to_pylist():
            ll = model.log_likelihood(t or b"")
            like.append(ll)
            at.append(int(ll.argmax()) if n_lang and ll.any() else -1)
        return [pa.array([x.tolist() for x in like], pa.list_(pa.float64())),
                pa.array(at, pa.int32())]

    read_items = with_python_columns(
        base, ["text"], [T.StructField("like", T.ArrayType(T.DoubleType())),
                         T.StructField("text_at", T.IntegerType())], read).drop("text")
    seen = checkpointed(read_items.withColumn("suffix", suffix_of(F.col("host")))
                        .withColumn("domain", domain_of(F.col("host"))))
    overall = seen.where("text_at >= 0").agg(*_votes(languages)).first() if n_lang else []
    total = np.array([v or 0 for v in overall], float)
    joined = seen
    for column in ("host", "domain", "declared", "suffix"):
        joined = joined.join(_counts(seen, column, languages) if n_lang else
                             _counts(seen, column, ["-"]),
                             F.col(column) == F.col(f"{column}_key"), "left")
    share = (total + 1) / (total.sum() + n_lang) if n_lang else total

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column("text_at").to_numpy()
            post = np.array(b.column("like").to_pylist(), float).reshape(len(own), n_lang)
            mine = np.zeros_like(post)
            some = own >= 0
            mine[some, own[some]] = 1

            def votes(name: str) -> np.ndarray:
                none = [0] * n_lang
                return np.array([v or none for v in b.column(f"{name}_votes").to_pylist()],
                                float).reshape(len(own), n_lang)

            if n_lang:
                prior = np.broadcast_to(share, post.shape)
                for name, weight in (("domain", SMOOTH_DOMAIN), ("host", SMOOTH_HOST)):
                    v = np.maximum(votes(name) - mine, 0)
                    prior = (v + weight * prior) / (v.sum(1, keepdims=True) + weight)
                post = post + np.log(prior)
                for name in ("declared", "suffix"):
                    v = votes(name)
                    known = v.sum(1) > 0
                    post[known] += np.log((v[known] + 0.5) / (total + 1))
                post -= post.max(1, keepdims=True)
                post = np.exp(post)
                post /= post.sum(1, keepdims=True)
                best = post.argmax(1)
                lang, score = [languages[i] for i in best], post.max(1)
            else:
                lang, score = [None] * len(own), np.zeros(len(own))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in key), pa.array(lang, pa.string()), pa.array(score),
                 pa.array([languages[i] if i >= 0 else None for i in own], pa.string())],
                names=[*key, "lang", "score", "text_lang"])

    schema = T.StructType([*[items.schema[c] for c in key], T.StructField("lang", T.StringType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("text_lang", T.StringType())])
    return joined.mapInArrow(fuse, schema)
