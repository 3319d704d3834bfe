"""Substring dedup: passages of ``window`` words that an earlier document has.

Fixed-block anchors. With blocks of b = (window + 1) // 2 words, every window of ``window`` words
contains a whole block that starts at a multiple of b, whatever its place. So:

1. index and probe: each document's non-overlapping blocks are the index, and all its rolling
   windows of b words are the probes. A probe hits if its key is in the index and occurs more
   than once;
2. extend: a hit grows to every ``window``-word run around it. A run is a repeat if a document
   with a smaller id has it too; overlapping repeats together are the maximal exact repeats, whose
   words go. Both steps look at the input, never at what is left.

Any run that two documents share holds a block of each, so both find it; nothing depends on
frequency, and there is no cap.

Documents are dealt over batches of about ``BATCH_BYTES`` by hash. What a batch sends are packed
arrays of *distinct* sorted keys, one array for each range of keys (a passage that a third of all
documents share is one key a batch), and what comes back is one bit a key. The texts are
shuffled once, and read again for each step. Step 1 is a filter, its keys have 32 bits and the
range; step 2 decides with 96 bits and the range.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterlens.llm.common import fresh

BATCH_BYTES = 4 << 20
RANGE_BYTES = 16 << 20       # text bytes whose keys share a range
CHUNK = 1 << 20              # text bytes hashed at a time
LAST = (1 << 63) - 1         # a null id sorts after all others

_BASE = np.uint64(0x9E3779B97F4A7C15)
_TURN = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words:
    """The words of a batch of texts: bytes, bounds, the document each is in, two hashes."""

    def __init__(self, texts: list[bytes]) -> None:
        self.data = b"\n".join(texts) + b"\n"
        raw = np.frombuffer(self.data, np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts])
        space = _SPACE[raw]
        change = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(raw) and not space[0]:
            change = np.r_[0, change]
        self.start, self.end = change[0::2], change[1::2]
        self.doc = np.searchsorted(ends, self.start, side="right")
        self.count = np.bincount(self.doc, minlength=len(texts))
        self.first = np.cumsum(self.count) - self.count
        self.place = np.arange(len(self.start)) - self.first[self.doc]
        self.hash = self._hashes(raw)

    def _hashes(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes a word, from sums of byte * base^position, a chunk at a time."""
        n = len(self.start)
        total = np.zeros(n, np.uint64)
        at = 0
        while at < n:
            low = self.start[at]
            to = max(at + 1, int(np.searchsorted(self.end, low + CHUNK, side="right")))
            high = self.end[to - 1]
            power = np.empty(high - low + 1, np.uint64)
            power[0], power[1:] = 1, _BASE
            np.multiply.accumulate(power, out=power)
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum((raw[low:high].astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
            s, e = self.start[at:to] - low, self.end[at:to] - low
            # brought to one scale: the sum times base^(chunk - start)
            total[at:to] = (sums[e] - sums[s]) * power[(high - low) - s]
            total[at:to] *= _inverse_power(high - low)
            at = to
        size = (self.end - self.start).astype(np.uint64)
        return _mix(total + size), _mix(total * _TURN[0] + ~size)

    def keys(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the first word, hash, other hash) of every run of k words of a document."""
        n = len(self.start) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), *(np.zeros(0, np.uint64),) * 2
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1:])
        out = []
        for h, turn in zip(self.hash, _TURN):
            run = h[:n].copy()
            for i in range(1, k):
                run = run * turn + h[i:n + i]
            out.append(_mix(run)[at])
        return at, *out


def _inverse_power(n: int) -> np.uint64:
    """base^-n modulo 2^64."""
    return np.uint64(pow(pow(int(_BASE), -1, 1 << 64), int(n), 1 << 64))


def _packed(name: str, batch: int, split: np.ndarray, ranges: int, **columns) -> pa.Table:
    """One row a range: the slices of sorted arrays, whose range is ``split``."""
    edge = np.searchsorted(split, np.arange(ranges + 1))
    some = np.flatnonzero(edge[1:] > edge[:-1])
    out = {name: pa.array(some.astype(np.int32)),
           "batch": pa.array(np.full(len(some), batch, np.int32))}
    for c, values in columns.items():
        out[c] = pa.array([values[edge[i]:edge[i + 1]].tobytes() for i in some], pa.binary())
    return pa.table(out)


def _anchor_keys(words: Words, block: int, ranges: int):
    """Sorted distinct probe keys (range in the high half), the key of each rolling window, the
    word it starts at, and for each distinct key flags: 1 in the index, 2 more than once."""
    at, h, _ = words.keys(block)
    key = ((h >> np.uint64(32)) % np.uint64(ranges)) << np.uint64(32) | h & np.uint64(0xFFFFFFFF)
    order = np.argsort(key, kind="stable")
    k = key[order]
    head = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    number = np.empty(len(k), np.int64)
    number[order] = np.cumsum(np.r_[True, k[1:] != k[:-1]]) - 1 if len(k) else 0
    size = np.diff(np.r_[head, len(k)])
    flags = (size > 1).astype(np.uint8) * 2
    flags[number[words.place[at] % block == 0]] |= 1
    return k[head], number, at, flags


def _run_keys(words: Words, ids: np.ndarray, window: int, hits: np.ndarray, block: int,
              ranges: int):
    """Runs around hits: word index, sort order, first of each distinct key and its least id."""
    at, h, g = words.keys(window)
    n = len(words.start)
    reach = np.zeros(n + 1, np.int64)       # a run at w holds hits at w .. w + window - block
    reach[1:] = np.cumsum(hits)
    at_hit = reach[at + window - block + 1] > reach[at]
    at, h, g = at[at_hit], h[at_hit], g[at_hit]
    split = (h >> np.uint64(40)) % np.uint64(ranges)
    low = (g & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    who = ids[words.doc[at]]
    order = np.lexsort((who, low, h, split))
    split, h, low, who = split[order], h[order], low[order], who[order]
    new = np.ones(len(at), bool)
    new[1:] = (h[1:] != h[:-1]) | (low[1:] != low[:-1])
    head = np.flatnonzero(new)
    return at[order], np.cumsum(new) - 1, who, head, split[head], h[head], low[head], who[head]


def _bits_of(back: pa.Table, step: int) -> np.ndarray:
    """The answers of a step, in the order of the keys that were sent."""
    rows = [r for r in back.to_pylist() if r["step"] == step]
    rows.sort(key=lambda r: r["range"])
    out = [np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["n"]) for r in rows]
    return np.concatenate(out).astype(bool) if out else np.zeros(0, bool)


def _answer(step: int, table: pa.Table, answers: list[np.ndarray]) -> pa.Table:
    return pa.table({
        "batch": table.column("batch"), "range": table.column("range"),
        "step": pa.array([step] * len(answers), pa.int32()),
        "n": pa.array([len(a) for a in answers], pa.int32()),
        "bits": pa.array([np.packbits(a).tobytes() for a in answers], pa.binary())})


_BACK = "batch int, range int, step int, n int, bits binary"


def _probe_range(table: pa.Table) -> pa.Table:
    """Which keys of a range are in some document's index and occur more than once."""
    sent = [np.frombuffer(x, "<u4") for x in table.column("keys").to_pylist()]
    flags = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("flags").to_pylist()])
    key = np.concatenate(sent)
    order = np.argsort(key, kind="stable")
    k, f = key[order], flags[order]
    new = np.r_[True, k[1:] != k[:-1]]
    head = np.flatnonzero(new)
    hit = np.bitwise_or.reduceat(f & 1, head).astype(bool)
    hit &= np.add.reduceat(1 + (f >> 1), head, dtype=np.int64) > 1
    out = np.empty(len(key), bool)
    out[order] = hit[np.cumsum(new) - 1]
    return _answer(1, table, np.split(out, np.cumsum([len(s) for s in sent])[:-1]))


def _least_of_range(table: pa.Table) -> pa.Table:
    """Which runs of a batch some other batch has in a document with a smaller id."""
    h = [np.frombuffer(x, "<u8") for x in table.column("high").to_pylist()]
    low = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("low").to_pylist()])
    who = np.concatenate([_ids_of(x) for x in table.column("least").to_pylist()])
    key = np.concatenate(h)
    order = np.lexsort((who, low, key))
    k, lo, w = key[order], low[order], who[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (lo[1:] != lo[:-1])
    least = w[np.flatnonzero(new)][np.cumsum(new) - 1]
    out = np.empty(len(key), bool)
    out[order] = least < w
    return _answer(2, table, np.split(out, np.cumsum([len(x) for x in h])[:-1]))


def _packed_ids(x: np.ndarray) -> bytes:
    """Ids as differences from the least, in four bytes where they fit."""
    low = int(x.min())
    wide = int(x.max()) - low >= 1 << 32
    return np.int64(low).tobytes() + bytes([8 if wide else 4]) + \
        (x.view(np.uint64) - np.uint64(low & 0xFFFFFFFFFFFFFFFF)).astype(
            "<u8" if wide else "<u4").tobytes()


def _ids_of(packed: bytes) -> np.ndarray:
    low = np.frombuffer(packed, "<i8", 1)
    d = np.frombuffer(packed, "<u8" if packed[8] == 8 else "<u4", offset=9).astype(np.uint64)
    return (d + low.view(np.uint64)).view(np.int64)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = 13,
                   n_words: str | None = "n_words", n_removed: str | None = "n_removed",
                   ) -> DataFrame:
    """``docs`` with the words of repeated passages taken out of ``text``, the words kept joined
    by one space, plus the number of its words and of those removed (if names are given).

    A word goes if a run of ``window`` words of its document that covers it also starts in a
    document with a smaller id. Words are runs without ASCII white space, compared as they are.
    Null texts have no words and become empty; a text of fewer than ``window`` words has no run.
    A null id counts as larger than any other; rows that share an id are one document in this
    (none is before the other), each with its own text. Equal rows (id and text) that together
    are longer than a batch are treated once, and each of them gets the result. Other columns pass
    through. An empty table gives an empty result. One text must fit in memory; nothing else must.
    """
    size, most = _sizes(docs, id_col, text)
    if most <= BATCH_BYTES:
        return _remove(docs, size, id_col, text, window, n_words, n_removed)
    names = fresh(docs, "id", "row", "text", "words", "gone")
    id_, row, cut, words, gone = names
    once = docs.select(F.col(id_col).alias(id_), F.col(text).alias(cut)).distinct() \
        .withColumn(row, F.xxhash64(cut))
    done = _remove(once, size, id_, cut, window, words, gone)
    counts = [F.col(c).alias(f) for c, f in ((words, n_words), (gone, n_removed)) if f]
    return docs.withColumn(f"{row}_", F.xxhash64(text)).drop(text).join(
        done, F.col(id_col).eqNullSafe(F.col(id_)) & (F.col(f"{row}_") == F.col(row))) \
        .select(*[F.col(cut).alias(c) if c == text else c for c in docs.columns], *counts)


def _sizes(docs: DataFrame, id_col: str, text: str) -> tuple[int, int]:
    """Bytes of all texts, and of the largest group of more than one equal row."""
    size = F.octet_length(F.col(text))
    equal = docs.groupBy(F.col(id_col), F.xxhash64(text).alias("row")) \
        .agg(F.sum(size).alias("size"), F.count("*").alias("n"))
    found = equal.agg(F.sum("size").alias("all"),
                      F.max(F.when(F.col("n") > 1, F.col("size"))).alias("most")).first()
    return found["all"] or 0, found["most"] or 0


def _remove(docs: DataFrame, size: int, id_col: str, text: str, window: int,
            n_words: str | None, n_removed: str | None) -> DataFrame:
    block = (window + 1) // 2
    batches, ranges = math.ceil(size / BATCH_BYTES) or 1, math.ceil(size / RANGE_BYTES) or 1
    batch, = fresh([*docs.columns, "range", "step", "n", "bits"], "batch")
    at = [docs.columns.index(c) for c in (id_col, text)]
    dealt = docs.withColumn(batch, F.pmod(F.xxhash64(id_col, text), F.lit(batches)).cast("int"))
    fields = [(f, T.StructField(f, T.LongType())) for f in (n_words, n_removed) if f]

    def opened(group: pa.Table) -> tuple[Words, np.ndarray, int]:
        texts = [x or b"" for x in group.column(at[1]).cast(pa.large_binary()).to_pylist()]
        ids = group.column(at[0]).cast(pa.int64()).fill_null(LAST).to_numpy()
        return Words(texts), ids, group.column(batch)[0].as_py()

    def index_and_probe(group: pa.Table) -> pa.Table:
        words, _, b = opened(group)
        key, _, _, flags = _anchor_keys(words, block, ranges)
        return _packed("range", b, key >> np.uint64(32), ranges,
                       keys=(key & np.uint64(0xFFFFFFFF)).astype("<u4"), flags=flags)

    def hits_of(words: Words, back: pa.Table) -> np.ndarray:
        _, number, first, _ = _anchor_keys(words, block, ranges)
        hits = np.zeros(len(words.start), bool)
        hits[first] = _bits_of(back, 1)[number]
        return hits

    def extend(group: pa.Table, back: pa.Table) -> pa.Table:
        schema = pa.schema([("range", pa.int32()), ("batch", pa.int32()), ("high", pa.binary()),
                            ("low", pa.binary()), ("least", pa.binary())])
        if not group.num_rows or not back.num_rows:
            return schema.empty_table()
        words, ids, b = opened(group)
        *_, split, h, low, who = _run_keys(words, ids, window, hits_of(words, back), block, ranges)
        edge = np.searchsorted(split, np.arange(ranges + 1))
        out = _packed("range", b, split, ranges, high=h.astype("<u8"), low=low.astype("<u4"))
        least = [_packed_ids(who[edge[i]:edge[i + 1]]) for i in range(ranges)
                 if edge[i + 1] > edge[i]]
        return out.append_column("least", pa.array(least, pa.binary()))

    def remove(group: pa.Table, back: pa.Table) -> pa.Table:
        if not group.num_rows:
            return out_schema.empty_table()
        words, ids, _ = opened(group)
        gone = np.zeros(len(words.start) + 1, np.int64)
        if back.num_rows:
            run, number, who, _, _, _, _, least = _run_keys(
                words, ids, window, hits_of(words, back), block, ranges)
            if len(run):
                # elsewhere in an earlier document, or in an earlier one of this batch
                repeat = run[_bits_of(back, 2)[number] | (least[number] < who)]
                np.add.at(gone, repeat, 1)
                np.subtract.at(gone, repeat + window, 1)
        gone = np.cumsum(gone)[:-1] > 0
        removed = np.bincount(words.doc[gone], minlength=len(words.count))
        texts = _kept_texts(words, gone)
        columns = [*group.columns]
        columns.pop(group.schema.get_field_index(batch))
        columns[at[1]] = pa.array(texts, pa.binary()).cast(pa.string())
        counts = [words.count, removed]
        columns += [pa.array(c.astype(np.int64)) for c, f in zip(counts, (n_words, n_removed)) if f]
        return pa.table(columns, names=out_schema.names)

    def grouped(rows: DataFrame):
        return dealt.groupBy(batch).cogroup(rows.groupBy("batch"))

    keys = dealt.groupBy(batch).applyInArrow(
        index_and_probe, "range int, batch int, keys binary, flags binary")
    hits = keys.groupBy("range").applyInArrow(_probe_range, _BACK)
    runs = grouped(hits).applyInArrow(
        extend, "range int, batch int, high binary, low binary, least binary")
    repeats = runs.groupBy("range").applyInArrow(_least_of_range, _BACK)
    out = T.StructType([*docs.schema.fields, *(f for _, f in fields)])
    out_schema = _arrow_schema(docs.sparkSession, out)
    return grouped(hits.union(repeats)).applyInArrow(remove, out)


def _arrow_schema(spark, schema: T.StructType) -> pa.Schema:
    return spark.createDataFrame([], schema).toArrow().schema


def _kept_texts(words: Words, gone: np.ndarray) -> list[bytes]:
    """Each document's kept words, joined by one space."""
    data, out = words.data, []
    touched = np.zeros(len(words.count), bool)
    touched[words.doc[gone]] = True
    bounds = list(zip(words.first.tolist(), (words.first + words.count).tolist(),
                      touched.tolist()))
    start, end = words.start, words.end
    for a, b, cut in bounds:
        if a == b:
            out.append(b"")
        elif not cut:
            out.append(b" ".join(data[start[a]:end[b - 1]].split()))
        else:
            keep = ~gone[a:b]
            edge = np.flatnonzero(np.diff(np.r_[False, keep, False].astype(np.int8)))
            out.append(b" ".join([b" ".join(data[start[a + i]:end[a + j - 1]].split())
                                  for i, j in zip(edge[::2], edge[1::2])]))
    return out
