"""Alignment of two tokenizers: which tokens of one cover the same bytes as which of the other.

A text's tokens of both sides are byte ranges over the same bytes. ``pandas.merge_asof``, keyed by
document and run over a block of documents at a time, finds for each token start of one side the
token of the other that covers it. Both directions together give all overlaps; starts that fall
together (equal ends of the tokens before) cut the tokens into groups, and each token of a group
is linked to each of the other side.

Link counts are corpus-wide. A task works on blocks of about ``BLOCK_BYTES`` of text: a block sends
its distinct id pairs, each with its number of documents, and gets one count for each back; what a
document keeps of its links are places in its block's list of pairs. So a pair that every document
holds is one row a block, and nothing but sums crosses blocks.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterlens.llm.bpe import _kept
from quarterlens.llm.common import checkpointed, fresh

BLOCK_BYTES = 2 << 20
PAIRS_AT_ONCE = 1 << 22      # links expanded at a time
WORDS_KEPT = 200_000         # words whose pieces a worker remembers
_SPACE = "▁"
_WORDS = re.compile(" +[^ ]*")
_LONG_SPACE = re.compile(r"\s{1000}")


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(other)}}


class ByteLevel:
    """A byte-level BPE of a ``tokenizers`` file. Special tokens are ordinary text.

    Where ids are the order of the merges, ``tiktoken`` does the work on the same vocabulary, as it
    is several times faster; other files, and texts with very long white space, go through
    ``tokenizers``.
    """

    def __init__(self, raw: bytes, pattern: str) -> None:
        spec = json.loads(raw)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        at = byte_alphabet()
        special = {t["content"] for t in spec.get("added_tokens", [])}
        self.tokens = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if token not in special:
                self.tokens[i] = bytes([at[c] for c in token])
        made = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
        in_order = [vocab.get(m) for m in made] == list(range(256, 256 + len(made))) \
            and len(set(made)) == len(made)
        from tokenizers import Tokenizer
        model = Tokenizer.from_str(raw.decode())
        model.encode_special_tokens = True
        self._plain = self._fast = lambda t: model.encode(t, add_special_tokens=False).ids
        if in_order and not spec.get("normalizer"):
            import tiktoken
            ranks = {t: i for i, t in enumerate(self.tokens) if t}
            self._fast = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks,
                                           special_tokens={}).encode_ordinary

    def encode(self, text: str) -> list[int]:
        # the pattern's look-ahead overflows tiktoken's stack on very long white space
        return (self._plain if _LONG_SPACE.search(text) else self._fast)(" " + text)


class Pieces:
    """A ``sentencepiece`` model, which puts a space before the text by itself.

    If no piece holds a space behind another character, no merge crosses the start of a run of
    spaces: such words are then encoded apart, and their pieces remembered.
    """

    def __init__(self, raw: bytes) -> None:
        import sentencepiece
        self._model = sentencepiece.SentencePieceProcessor(model_proto=raw)
        names = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self.tokens = [bytes([int(n[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", n)
                       else n.replace(_SPACE, " ").encode() for n in names]
        probe = "  a  b \n c "
        self._by_word = not any(_SPACE in n.lstrip(_SPACE) for n in names) and b"".join(
            self.tokens[i] for i in self._model.encode(probe)) == f" {probe}".encode()
        self._space = self._model.piece_to_id(_SPACE)
        self._known: dict[str, list[int]] = {}

    def _word(self, word: str) -> list[int]:
        ids = self._model.encode(word[1:]) if len(word) > 1 else [self._space]
        if len(word) < 64:
            if len(self._known) >= WORDS_KEPT:
                self._known.clear()
            self._known[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        if not self._by_word or _SPACE in text:
            return self._model.encode(text)
        known, out = self._known, []
        for word in _WORDS.findall(" " + text):
            out += known.get(word) or self._word(word)
        return out


class Side:
    """The tokens of one side for the documents of a block: ids, document and byte range."""

    def __init__(self, ids: list[list[int]], tokens: list[bytes]) -> None:
        self.count = np.array([len(i) for i in ids], np.int64)
        self.ids = np.fromiter((i for x in ids for i in x), np.int64, int(self.count.sum()))
        size = np.array([len(t) for t in tokens], np.int64)[self.ids]
        self.end = np.cumsum(size)
        self.start = self.end - size
        self.doc = np.repeat(np.arange(len(ids)), self.count)

    def frame(self, name: str) -> pd.DataFrame:
        return pd.DataFrame({"at": self.start, "doc": self.doc, name: np.arange(len(self.ids))})


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """For each token the one of the other side that covers its first byte."""
    left, right = a.frame("a"), b.frame("b")
    over_a = pd.merge_asof(left, right, on="at", by="doc")["b"].to_numpy(np.int64)
    over_b = pd.merge_asof(right, left, on="at", by="doc")["a"].to_numpy(np.int64)
    return over_a, over_b


class Aligned:
    """The groups of a block of documents and the distinct id pairs that they link."""

    def __init__(self, a: Side, b: Side, n_docs: int, a_size: int, b_size: int) -> None:
        self.a, self.b, self.n_docs, self.sizes = a, b, n_docs, (a_size, b_size)
        over_a, over_b = overlaps(a, b) if len(a.ids) else (a.ids, b.ids)
        a_new = a.start == b.start[over_a]          # equal starts: a group begins
        b_new = b.start == a.start[over_b]
        self.a_group, self.b_group = np.cumsum(a_new) - 1, np.cumsum(b_new) - 1
        n = int(a_new.sum())
        self.n_a, self.n_b = (np.bincount(g, minlength=n) for g in (self.a_group, self.b_group))
        doc = a.doc[a_new]                           # of each group
        self.n_groups = np.bincount(doc, minlength=n_docs)
        self.n_links = np.bincount(doc, self.n_a * self.n_b, n_docs).astype(np.int64)
        # both directions, pairs of equal start counted once
        self.n_overlaps = a.count + b.count - self.n_groups

    def notation(self, names: tuple[np.ndarray, np.ndarray]) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` for each document: the ids of each group."""
        a, b = self.a, self.b
        out = np.empty(len(a.ids) + len(b.ids), object)
        b_before = np.cumsum(self.n_b) - self.n_b
        a_until = np.cumsum(self.n_a)
        for side, group, other, name in ((a, self.a_group, b_before, names[0]),
                                         (b, self.b_group, a_until, names[1])):
            last = np.ones(len(group), bool)
            last[:-1] = group[1:] != group[:-1]
            out[np.arange(len(group)) + other[group]] = name[side.ids * 2 + last]
        to = np.cumsum(a.count + b.count).tolist()
        return ["".join(out[i:j])[:-1] for i, j in zip([0, *to], to)]

    def _links(self, low: int, high: int) -> np.ndarray:
        """(document, a, b) as one number for each link of the A tokens low .. high - 1."""
        at = np.arange(low, high)
        group = self.a_group[at]
        times = self.n_b[group]
        first = (np.cumsum(self.n_b) - self.n_b)[group]
        edge = np.cumsum(times)
        who = np.repeat(np.arange(len(at)), times)
        other = np.arange(edge[-1] if len(edge) else 0) - (edge - times)[who] + first[who]
        head = self.a.doc[at] * self.sizes[0] + self.a.ids[at]
        return head[who] * self.sizes[1] + self.b.ids[other]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, a, b), sorted, and how often each is linked."""
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        edge = np.cumsum(self.n_b[self.a_group])
        low, n = 0, len(self.a.ids)
        while low < n:
            done = edge[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(edge, done + PAIRS_AT_ONCE, side="right")))
            k, c = np.unique(self._links(low, high), return_counts=True)
            if len(keys):
                # only the last document can go on from one part to the next
                k, back = np.unique(np.concatenate([keys, k]), return_inverse=True)
                c = np.bincount(back, np.concatenate([counts, c])).astype(np.int64)
            keys, counts, low = k, c, high
        return keys, counts


def _packed(x: np.ndarray) -> bytes:
    """Numbers from 0 in as few bytes as the largest needs; the first byte tells how many."""
    width = next(w for w in (1, 2, 4, 8) if not len(x) or int(x.max()) < 1 << 8 * w)
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def _numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in order, about ``BLOCK_BYTES`` of text at a time."""
    held, size = [], 0
    for batch in batches:
        lengths = np.array([len(t or b"") for t in
                            batch.column(1).cast(pa.large_binary()).to_pylist()], np.int64)
        start = 0
        for i, n in enumerate(lengths.tolist()):
            size += n
            if size >= BLOCK_BYTES:
                held.append(batch.slice(start, i + 1 - start))
                yield pa.Table.from_batches(held)
                held, size, start = [], 0, i + 1
        if start < len(batch):
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


COLUMNS = "block long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, " \
    "groups string, links binary, link_counts binary, pairs array<long>, pair_docs array<int>"
PAIR = 1 << 32               # a pair of ids as one number: a * PAIR + b


def align(docs: DataFrame, a_file: str, pattern: str, b_file: str, id_col: str = "doc_id",
          text: str = "text") -> DataFrame:
    """The alignment of each text, one row a document, and one row a block of documents.

    Document rows: ``id_col``, block, number of A and B tokens, groups, links and overlaps, the
    groups in the notation ``a1,a2|b1;a3|b2,b3`` (ids in order), and packed links: places in the
    block's pairs (as differences) and how often each is linked. Block rows have a null id and
    hold ``pairs`` (null in document rows), sorted, with the number of documents of each.

    a_file: a ``tokenizers`` byte-level BPE that is given a space and the text; ``pattern`` is its
    pattern of pieces. b_file: a ``sentencepiece`` model, which adds the space. Null and empty
    texts, and texts whose tokens on either side do not spell a space and the text, have no
    tokens: zeros and an empty notation. Each row is a document, repeated ids too. Other columns
    of ``docs`` are not read. Texts are taken whole, however long (one must fit in memory with its
    tokens). An empty table gives an empty result. Files are read on the driver and broadcast.
    """
    spark = docs.sparkSession
    raw = []
    for path in (a_file, b_file):
        with open(path, "rb") as f:
            raw.append(f.read())
    name = hashlib.md5(raw[0] + raw[1] + pattern.encode()).hexdigest()
    sent = spark.sparkContext.broadcast(raw)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           *T._parse_datatype_string(COLUMNS).fields])
    arrow = spark.createDataFrame([], schema).toArrow().schema

    def tools():
        a, b = ByteLevel(sent.value[0], pattern), Pieces(sent.value[1])
        names = tuple(np.array([f"{i}{c}" for i in range(len(s.tokens)) for c in seps], object)
                      for s, seps in ((a, ",|"), (b, ",;")))
        return a, b, names

    def spelt(side, texts: list[str]) -> list[list[int]]:
        ids = [side.encode(t) if t else [] for t in texts]
        token = side.tokens.__getitem__
        return [i if i and b"".join(map(token, i)) == b" " + t.encode() else []
                for i, t in zip(ids, texts)]

    def rows(table: pa.Table, block: int, made) -> Iterator[pa.RecordBatch]:
        a_side, b_side, names = made
        texts = [t or "" for t in table.column(1).to_pylist()]
        a_ids, b_ids = spelt(a_side, texts), spelt(b_side, texts)
        for i, (x, y) in enumerate(zip(a_ids, b_ids)):
            if not x or not y:
                a_ids[i] = b_ids[i] = []
        n = len(texts)
        a, b = Side(a_ids, a_side.tokens), Side(b_ids, b_side.tokens)
        both = Aligned(a, b, n, len(a_side.tokens), len(b_side.tokens))
        key, times = both.links()
        span = both.sizes[0] * both.sizes[1]
        doc, pair = key // span, key % span
        pairs, place, docs_of = np.unique(pair, return_inverse=True, return_counts=True)
        edge = np.searchsorted(doc, np.arange(n + 1))
        links = [_packed(np.diff(place[i:j], prepend=0)) for i, j in zip(edge, edge[1:])]
        counts = [_packed(times[i:j]) for i, j in zip(edge, edge[1:])]
        none = pa.nulls(n)
        yield from pa.table(
            [table.column(0), pa.array(np.full(n, block)), pa.array(a.count), pa.array(b.count),
             pa.array(both.n_groups), pa.array(both.n_links), pa.array(both.n_overlaps),
             pa.array(both.notation(names), pa.string()), pa.array(links, pa.binary()),
             pa.array(counts, pa.binary()), none, none], names=arrow.names) \
            .cast(arrow).combine_chunks().to_batches()
        if len(pairs):
            full = pairs // both.sizes[1] * PAIR + pairs % both.sizes[1]
            one = [pa.nulls(1), pa.array([block]), *(pa.nulls(1) for _ in range(8)),
                   pa.array([full], pa.list_(pa.int64())),
                   pa.array([docs_of.astype(np.int32)], pa.list_(pa.int32()))]
            yield from pa.table(one, names=arrow.names).cast(arrow).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        made = _kept(f"crosstok_{name}", tools)
        first = TaskContext.get().partitionId() << 32
        for i, table in enumerate(_blocks(batches)):
            yield from rows(table, first + i, made)

    return docs.select(id_col, text).mapInArrow(run, schema)


def with_link_counts(aligned: DataFrame) -> DataFrame:
    """Document rows of ``align`` with corpus-wide counts of their links.

    A pair's count is the number of documents in which it is linked. ``n_best``: links whose
    count is the highest of their A id's pairs (ties included); ``count_sum``: the counts of all
    links together. Columns added to ``aligned`` stay; links and pairs go. Checkpoints
    ``aligned`` (in the shared folder), so texts are tokenised once; drop ``groups`` before if it
    is not needed after.
    """
    block, place, many, top = fresh(aligned, "block", "place", "many", "top")
    kept = checkpointed(aligned)
    docs = kept.filter(F.col("pairs").isNull()).drop("pairs", "pair_docs")
    asked = kept.filter(F.col("pairs").isNotNull()) \
        .select(F.col("block").alias(block),
                F.posexplode(F.arrays_zip("pairs", "pair_docs")).alias(place, many)) \
        .select(block, place, F.col(f"{many}.pairs").alias("pair"),
                F.col(f"{many}.pair_docs").alias(many))
    totals = asked.groupBy("pair").agg(F.sum(many).alias(many))
    a_id = F.floor(F.col("pair") / F.lit(PAIR))
    best = totals.groupBy(a_id.alias("a")).agg(F.max(many).alias(top))
    counted = totals.withColumn("a", a_id).join(best, "a") \
        .select("pair", many, (F.col(many) == F.col(top)).alias(top))
    answers = asked.select(block, place, "pair").join(counted, "pair").select(
        block, place, many, top)
    out = [f for f in docs.schema.fields if f.name not in ("block", "links", "link_counts")]
    out += [T.StructField(c, T.LongType()) for c in ("n_best", "count_sum")]
    names = [f.name for f in out]

    def count(group: pa.Table, back: pa.Table) -> pa.Table:
        at = back.column(1).to_numpy()
        n = np.zeros(len(at), np.int64)
        is_best = np.zeros(len(at), np.int64)
        n[at], is_best[at] = back.column(2).to_numpy(), back.column(3).to_numpy()
        best_of, sum_of = [], []
        for places, times in zip(group.column("links").to_pylist(),
                                 group.column("link_counts").to_pylist()):
            i, t = np.cumsum(_numbers(places)), _numbers(times)
            best_of.append(int((t * is_best[i]).sum()))
            sum_of.append(int((t * n[i]).sum()))
        columns = [group.column(c) for c in names[:-2]]
        return pa.table([*columns, pa.array(best_of, pa.int64()), pa.array(sum_of, pa.int64())],
                        names=names)

    return docs.groupBy("block").cogroup(answers.groupBy(block)) \
        .applyInArrow(_only_docs(count, T.StructType(out), docs), T.StructType(out))


def _only_docs(count: Callable, schema: T.StructType, docs: DataFrame) -> Callable:
    """``count`` for a block; nothing for one without documents."""
    arrow = docs.sparkSession.createDataFrame([], schema).toArrow().schema

    def run(group: pa.Table, back: pa.Table) -> pa.Table:
        return count(group, back) if group.num_rows else arrow.empty_table()

    return run
