"""SimHash near-duplicates over a covering code of anchor points.

Fingerprint: lower-case A-Z, words (runs without ASCII white space), shingles of ``shingle``
words joined by one space (repeats count; fewer words: the whole sequence), XXH64 (seed 42) of
each; a bit is set if it is set in more than half of the hashes. A text without words has
fingerprint zero.

Search: two fingerprints that differ in at most t bits differ in at most t // 2 bits of one 32-bit
half. In the first 31 bits of each half the anchors are the words of the Hamming code [31, 26],
whose covering radius is 1. Points at distance s have a midpoint at most ceil(s / 2) from both, and
the midpoint has an anchor within 1, so both are copied to a common anchor if each is copied to
every anchor within the covering radius plus ceil(s / 2). (Radius plus the whole of s would do as
well, at 156 instead of 16 copies a half for t = 4.) Every pair is then found at some anchor, where
all fingerprints are compared in full; there is no miss and no cap.

Equal fingerprints are one node. An anchor with more than ``BLOCK`` nodes is cut into blocks whose
pairs are compared by separate tasks. What leaves an anchor is a spanning forest of its links,
never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import re
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quarterlens.llm.common import as_bytes, checkpointed, fresh, with_python_columns
from quarterlens.llm.components import connected_components

SEED = 42
CODE_BITS = 31          # length of the Hamming code; its syndromes are 0..31
BLOCK = 8192            # nodes of an anchor that one task compares
PAIRWISE = 16           # anchors up to this size are compared by shifted columns
PIECE = 1 << 20         # bytes of a text that are split into words at a time
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, about ``PIECE`` bytes at a time."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > PIECE:
            found = _SPACE.search(text, at + PIECE)
            end = found.start() if found else end
        yield text[at:end].split()
        at = end


def fingerprint(text: bytes, shingle: int) -> int:
    """The 64-bit SimHash of one text (unsigned)."""
    ones, n, rest = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest

    def add(shingles) -> int:
        h = np.array([digest(s, SEED) for s in shingles], "<u8")
        if len(h):
            ones[:] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                                     bitorder="little").sum(0, dtype=np.int64)
        return len(h)

    for words in words_of(text.lower()):
        rest += words
        n += add(map(b" ".join, zip(*(rest[i:] for i in range(shingle)))))
        rest = rest[max(0, len(rest) - shingle + 1):] if len(rest) >= shingle else rest
    if not n and rest:
        n = add([b" ".join(rest)])
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]) if n else 0


def with_fingerprint(docs: DataFrame, text: str, out: str, shingle: int = 4) -> DataFrame:
    """``docs`` plus the fingerprint as a signed long. Null text: as empty."""
    def work(cols: list[pa.Array]) -> list[pa.Array]:
        fps = np.array([fingerprint(t, shingle) for t in as_bytes(cols[0])], np.uint64)
        return [pa.array(fps.view(np.int64))]

    return with_python_columns(docs, [text], [T.StructField(out, T.LongType())], work)


def _patterns(radius: int) -> list[np.ndarray]:
    """For each syndrome, the error patterns of weight <= radius: x ^ pattern is a code word."""
    by: list[list[int]] = [[] for _ in range(CODE_BITS + 1)]
    for weight in range(radius + 1):
        for bits in combinations(range(1, CODE_BITS + 1), weight):
            syndrome = 0
            for b in bits:
                syndrome ^= b
            by[syndrome].append(sum(1 << (b - 1) for b in bits))
    return [np.array(p, np.uint64) for p in by]


def anchors(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, index of the fingerprint) for every anchor in reach of each fingerprint."""
    near = -(-(max_bits // 2) // 2)
    patterns = _patterns(1 + near)
    keys, owners = [], []
    for half in (0, 1):
        x = (fps >> np.uint64(32 * half)) & np.uint64((1 << CODE_BITS) - 1)
        syndrome = np.zeros(len(x), np.uint64)
        for b in range(1, CODE_BITS + 1):
            syndrome ^= ((x >> np.uint64(b - 1)) & np.uint64(1)) * np.uint64(b)
        for s, pattern in enumerate(patterns):
            rows = np.flatnonzero(syndrome == s)
            if len(rows) and len(pattern):
                keys.append(((x[rows][:, None] ^ pattern) | np.uint64(half << CODE_BITS)).ravel())
                owners.append(np.repeat(rows, len(pattern)))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def forest(fps: np.ndarray, max_bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Spanning forest of the links among ``fps``: each node is visited once and is compared only
    with nodes not yet reached, so a dense group costs little more than its size."""
    left, a, b = fps, [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = np.bitwise_count(left ^ node) <= max_bits
            if near.any():
                hit = left[near]
                left = left[~near]
                a.append(np.full(len(hit), node))
                b.append(hit)
                queue.extend(hit)
    return a, b


def _links_of_runs(key: np.ndarray, fp: np.ndarray, max_bits: int):
    """Links within runs of equal ``key`` (sorted), as two arrays of fingerprints."""
    a, b = [], []
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    lengths = np.diff(np.r_[starts, len(key)])
    small = lengths <= PAIRWISE
    active = np.flatnonzero(np.repeat(small & (lengths > 1), lengths))
    for k in range(1, PAIRWISE):
        active = active[active + k < len(key)]
        active = active[key[active] == key[active + k]]
        if not len(active):
            break
        near = active[np.bitwise_count(fp[active] ^ fp[active + k]) <= max_bits]
        a.append(fp[near])
        b.append(fp[near + k])
    for s, n in zip(starts[~small], lengths[~small]):
        x, y = forest(fp[s:s + n], max_bits)
        a += x
        b += y
    empty = np.zeros(0, np.uint64)
    return np.concatenate(a or [empty]), np.concatenate(b or [empty])


def _out(a: np.ndarray, b: np.ndarray, block: np.ndarray | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
         pa.array(np.full(len(a), -1, np.int32) if block is None else block)],
        names=["a", "b", "block"])


def compare_anchors(max_bits: int):
    """Sorted (anchor, fp) rows -> links (a, b, block -1); members of an anchor with more than
    ``BLOCK`` nodes come out as they are (anchor, fp, block >= 0) for a second pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = fp = np.zeros(0, np.uint64)
        hot, done = None, 0          # an anchor that is being passed on, and its rows so far

        def pass_on(k, f):
            nonlocal done
            block = ((done + np.arange(len(f))) // BLOCK).astype(np.int32)
            done += len(f)
            return _out(k, f, block)

        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy().view(np.uint64)])
            fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            if hot is not None and len(key):
                same = int(np.searchsorted(key != hot, True)) if key[-1] != hot else len(key)
                if same:
                    yield pass_on(key[:same], fp[:same])
                key, fp = key[same:], fp[same:]
                if len(key):
                    hot = None
            if not len(key):
                continue
            last = int(np.searchsorted(key != key[-1], False)) if key[0] == key[-1] else \
                len(key) - int(np.searchsorted((key != key[-1])[::-1], True))
            yield from settle(key[:last], fp[:last], max_bits)
            key, fp = key[last:], fp[last:]
            if len(key) > BLOCK:
                hot, done = key[0], 0
                yield pass_on(key, fp)
                key, fp = key[:0], fp[:0]
        yield from settle(key, fp, max_bits)

    def settle(key, fp, max_bits):
        if not len(key):
            return
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        lengths = np.diff(np.r_[starts, len(key)])
        for s, n in zip(starts[lengths > BLOCK], lengths[lengths > BLOCK]):
            yield _out(key[s:s + n], fp[s:s + n], (np.arange(n) // BLOCK).astype(np.int32))
        keep = np.repeat((lengths <= BLOCK) & (lengths > 1), lengths)
        a, b = _links_of_runs(key[keep], fp[keep], max_bits)
        if len(a):
            yield _out(a, b)

    return run


def links(fps: DataFrame, fp: str, max_bits: int = 4) -> DataFrame:
    """(a, b): links that connect every pair of distinct fingerprints within ``max_bits`` bits."""
    if not 0 <= max_bits <= 9:
        raise ValueError("max_bits: 0 to 9")
    nodes = fps.select(F.col(fp).alias("fp")).distinct()

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = batch.column(0).to_numpy().view(np.uint64)
            key, owner = anchors(f, max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)),
                                              pa.array(f[owner].view(np.int64))],
                                             names=["anchor", "fp"])

    def pairs(group: pa.Table) -> pa.Table:
        f = np.unique(group.column("fp").to_numpy()).view(np.uint64)
        a, b = forest(f, max_bits)
        empty = np.zeros(0, np.uint64)
        out = _out(np.concatenate(a or [empty]), np.concatenate(b or [empty]))
        return pa.Table.from_batches([out]).select(["a", "b"])

    at_anchor = nodes.mapInArrow(copy, "anchor long, fp long").repartition("anchor") \
        .sortWithinPartitions("anchor", "fp")
    found = checkpointed(at_anchor.mapInArrow(compare_anchors(max_bits),
                                              "a long, b long, block int"))
    cold = found.where("block = -1").select("a", "b")
    hot = found.where("block >= 0").select(F.col("a").alias("anchor"), F.col("b").alias("fp"),
                                           "block")
    blocks = hot.groupBy("anchor").agg(F.max("block").alias("top"))
    tasks = hot.join(blocks, "anchor").select(
        "anchor", "fp", "block", F.explode(F.sequence(F.lit(0), F.col("top"))).alias("other")) \
        .select("anchor", "fp", F.least("block", "other").alias("lo"),
                F.greatest("block", "other").alias("hi"))
    return cold.union(tasks.groupBy("anchor", "lo", "hi").applyInArrow(pairs, "a long, b long")) \
        .distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                    shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row per row of ``docs``: id, text_hash, fingerprint (16 hex digits), component_id,
    component (the component's smallest fingerprint, signed).

    component_id is the smallest id reachable over links of at most ``max_bits`` bits. Null text:
    as empty; texts without words share fingerprint zero, which links like any other. Null ids
    get a component_id like any row and are never one (null if a component has no other id).
    Repeated rows give repeated rows. An empty table gives an empty result. Other columns are
    not read.
    """
    rows = checkpointed(with_fingerprint(
        docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"),
                    F.col(text).alias("text")), "text", "fp", shingle).drop("text"))
    nodes = checkpointed(rows.groupBy("fp").agg(F.min("id").alias("least_id")))
    labels = checkpointed(connected_components(links(nodes, "fp", max_bits), "a", "b"))
    member = checkpointed(nodes.join(labels, F.col("fp") == F.col("node"), "left").select(
        "fp", "least_id", F.coalesce("label", "fp").alias("label")))
    least = checkpointed(member.groupBy("label").agg(F.min("least_id").alias("component_id")))
    member = checkpointed(member.join(least, "label").select(
        F.col("fp").alias("f"), "component_id", F.col("label").alias("component")))
    return rows.join(member, F.col("fp") == F.col("f")).select(
        F.col("id").alias(id_col), "text_hash",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 4,
             max_bits: int = 4) -> DataFrame:
    """``docs`` with one row left of each group: that of the smallest id (a null id only where
    the group has no other; of rows with that id, the one with the smallest text hash)."""
    found = near_duplicates(docs.select(id_col, text), id_col, text, shingle, max_bits)
    first = Window.partitionBy("component").orderBy("text_hash")
    kept = found.where(F.col(id_col).eqNullSafe(F.col("component_id"))).withColumn(
        "nth", F.row_number().over(first)).where("nth = 1")
    h, kid, kh, nth = fresh(docs, "hash", "kept_id", "kept_hash", "nth")
    kept = kept.select(F.col(id_col).alias(kid), F.col("text_hash").alias(kh))
    return docs.withColumn(h, F.xxhash64(text)).join(
        kept, F.col(id_col).eqNullSafe(F.col(kid)) & (F.col(h) == F.col(kh))) \
        .withColumn(nth, F.row_number().over(Window.partitionBy(kid, kh).orderBy(h))) \
        .where(F.col(nth) == 1).select(*docs.columns)
