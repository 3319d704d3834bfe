"""Byte-level BPE encoding and decoding with segment trees over byte positions.

A text is cut by the vocabulary's pattern and each piece is merged on its own. The leaves of a
piece's segment tree are its byte positions; the leaf of a live position holds the rank of the
pair it begins (with its position in the low bits, so the root is the leftmost minimum). A merge
removes one live neighbour and updates three leaves, each in logarithmic time, so a piece of n
bytes costs O(n log n) even if it has no white space at all. Pieces of up to ``TOGETHER`` bytes are
merged many at a time: one row of a matrix is one tree, and each step merges the best
pair of every row.

Words repeat, so each Python worker keeps the ids of the last ones it met (two generations of at
most ``CACHE``). What it keeps are runs that the pattern never joins: with ``cut`` (by default the
white-space rule of the byte-level patterns) a text falls into runs whose matches are the
text's matches. Token ids travel as packed little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from itertools import chain, islice
from types import ModuleType

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quarterlens.llm.common import with_python_columns

CACHE = 150_000              # runs of one generation
CACHED_CHARS = 64            # longer runs are not kept
GROUP_CHARS = 1 << 20        # text that is held as a list of runs
TOGETHER = 64                # bytes of pieces that are merged many at a time
TREE_CELLS = 1 << 18         # leaves of the trees merged together
# A space goes with the word after it; other white space stands alone, its last character apart.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CUT = rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
NONE = 1 << 62               # no pair here
POSITION = (1 << 32) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """Token ids of one piece. Every single byte must have a rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    width = 1 << (n - 1).bit_length()
    tree = [NONE] * (2 * width)
    for i in range(n - 1):
        rank = ranks.get(piece[i:i + 2])
        if rank is not None:
            tree[width + i] = rank << 32 | i
    for k in range(width - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    after = list(range(1, n + 1))       # next live position
    before = list(range(-1, n - 1))
    while tree[1] != NONE:
        i = tree[1] & POSITION
        j = after[i]
        k = after[i] = after[j]
        if k < n:
            before[k] = i
        leaves = [(j, NONE)]
        value = NONE
        if k < n and after[k] - i <= longest:
            rank = ranks.get(piece[i:after[k]])
            if rank is not None:
                value = rank << 32 | i
        leaves.append((i, value))
        h = before[i]
        if h >= 0:
            value = NONE
            if k - h <= longest:
                rank = ranks.get(piece[h:k])
                if rank is not None:
                    value = rank << 32 | h
            leaves.append((h, value))
        for at, value in leaves:
            at += width
            tree[at] = value
            while at > 1:
                other = tree[at ^ 1]
                if other < value:
                    value = other
                at >>= 1
                if tree[at] == value:
                    break
                tree[at] = value
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class Pairs:
    """Hash table (token, token) -> rank of the two together, looked up for whole arrays."""

    BITS = 20

    def __init__(self, ranks: dict[bytes, int]) -> None:
        if len(ranks) > 1 << self.BITS:
            raise ValueError("too many tokens")
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << self.BITS | b)
                    values.append(rank)
        left, value = np.array(keys, np.int64), np.array(values, np.int64)
        self.mask = (4 << max(1, len(keys)).bit_length()) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.values = np.full(self.mask + 1, NONE, np.int64)
        at, self.probes = self._slot(left), 0
        while len(left):
            self.probes += 1
            free = self.keys[at] < 0
            first = np.zeros(len(at), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.keys[at[put]], self.values[at[put]] = left[put], value[put]
            left, value, at = left[~put], value[~put], (at[~put] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        key = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (key >> np.uint64(40)).astype(np.int64) & self.mask

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where there is no such token."""
        key = a << self.BITS | b
        at = self._slot(key)
        out = np.full(len(key), NONE, np.int64)
        todo = np.arange(len(key))
        for _ in range(self.probes):
            here = self.keys[at]
            hit = here == key[todo]
            out[todo[hit]] = self.values[at[hit]]
            more = ~hit & (here >= 0)
            todo, at = todo[more], (at[more] + 1) & self.mask
            if not len(todo):
                break
        return out


def merge_many(pieces: list[bytes], width: int, pairs: Pairs, singles: np.ndarray) -> list[bytes]:
    """Packed ids of pieces of 2 to ``width`` bytes (a power of two), one tree a row."""
    n_rows, shift = len(pieces), width.bit_length()
    n = np.array([len(p) for p in pieces])
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
    ids = np.full((n_rows, width + 1), -1, np.int64)
    ids[:, :width] = singles[raw.reshape(n_rows, width)]
    place = np.arange(width + 1)
    ids[place >= n[:, None]] = -1
    after = np.broadcast_to(place + 1, (n_rows, width + 1)).copy()
    before = np.broadcast_to(place - 1, (n_rows, width + 1)).copy()

    def leaf(rows, i, k):
        """Value of the leaf of live position i whose next live position is k."""
        out = np.full(len(rows), NONE, np.int64)
        some = np.flatnonzero(k < n[rows])
        rank = pairs.rank(ids[rows[some], i[some]], ids[rows[some], k[some]])
        out[some] = np.where(rank < NONE, rank << shift | i[some], NONE)
        return out

    tree = np.full((n_rows, 2 * width), NONE, np.int64)
    rows, cols = np.nonzero(place[None, :width] < n[:, None] - 1)
    tree[rows, width + cols] = leaf(rows, cols, cols + 1)
    level = width
    while level > 1:
        level >>= 1
        low = tree[:, 2 * level:4 * level]
        tree[:, level:2 * level] = np.minimum(low[:, ::2], low[:, 1::2])
    live = np.arange(n_rows)
    while True:
        live = live[tree[live, 1] < NONE]
        if not len(live):
            break
        best = tree[live, 1]
        i = best & ((1 << shift) - 1)
        j = after[live, i]
        k = after[live, j]
        ids[live, i], ids[live, j] = best >> shift, -1
        after[live, i], before[live, k] = k, i
        h = before[live, i]
        has = np.flatnonzero(h >= 0)
        tree[live, width + j] = NONE
        tree[live, width + i] = leaf(live, i, k)
        tree[live[has], width + h[has]] = leaf(live[has], h[has], i[has])
        paths = [(live, width + j), (live, width + i), (live[has], width + h[has])]
        for _ in range(shift - 1):
            paths = [(r, p >> 1) for r, p in paths]
            for r, p in paths:
                tree[r, p] = np.minimum(tree[r, 2 * p], tree[r, 2 * p + 1])
    kept = ids >= 0
    packed = ids[kept].astype("<u4").tobytes()
    ends = (4 * np.cumsum(kept.sum(1))).tolist()
    return [packed[a:b] for a, b in zip([0, *ends], ends)]


class Pieces:
    """Ids of runs of text; new ones are merged together, a full generation becomes the old one."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.longest = ranks, max(map(len, ranks))
        self.pattern, self.pairs = regex.compile(pattern), Pairs(ranks)
        self.singles = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.runs: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merged(self, pieces: set[str]) -> dict[str, bytes]:
        """The packed ids of each piece."""
        out, by_width = {}, {}
        for piece in pieces:
            raw = piece.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                out[piece] = whole.to_bytes(4, "little")
            elif len(raw) > TOGETHER:
                out[piece] = np.array(merge(raw, self.ranks, self.longest), "<u4").tobytes()
            else:
                by_width.setdefault(1 << (len(raw) - 1).bit_length(), []).append((piece, raw))
        for width, some in by_width.items():
            step = max(1, TREE_CELLS // width)
            for i in range(0, len(some), step):
                part = some[i:i + step]
                ids = merge_many([raw for _, raw in part], width, self.pairs, self.singles)
                out.update(zip((piece for piece, _ in part), ids))
        return out

    def known(self, runs: set[str]) -> dict[str, bytes]:
        """The packed ids of each run."""
        out, new = {}, {}
        for run in runs:
            ids = self.runs.get(run)
            if ids is None:
                ids = self.old.get(run)
                if ids is None:
                    new[run] = self.pattern.findall(run)
                    continue
                self.runs[run] = ids
            out[run] = ids
        pieces = self.merged({p for found in new.values() for p in found})
        for run, found in new.items():
            ids = out[run] = b"".join([pieces[p] for p in found])
            if len(run) <= CACHED_CHARS:
                self.runs[run] = ids
        if len(self.runs) > CACHE:
            self.runs, self.old = {}, self.runs
        return out

    def encode(self, texts: list[str], cut: re.Pattern | None) -> list[bytes]:
        """The packed ids of each text; about ``GROUP_CHARS`` of text are held as runs at a time."""
        out, group, size = [], [], 0

        def settle() -> None:
            ids = self.known(set(chain.from_iterable(group)))
            out.extend(b"".join(map(ids.__getitem__, runs)) for runs in group)
            group.clear()

        for text in texts:
            if cut is None or len(text) > GROUP_CHARS:
                settle()
                found = (m.group() for m in (cut or self.pattern).finditer(text))
                parts = []
                while block := list(islice(found, GROUP_CHARS // 4)):
                    ids = self.known(set(block))
                    parts.append(b"".join(map(ids.__getitem__, block)))
                out.append(b"".join(parts))
                size = 0
                continue
            group.append(cut.findall(text))
            size += len(text)
            if size > GROUP_CHARS:
                settle()
                size = 0
        settle()
        return out


def _kept(name: str, make):
    """An object kept by this Python worker from task to task."""
    shelf = sys.modules.setdefault("_llm_worker_shelf", ModuleType("_llm_worker_shelf"))
    if not hasattr(shelf, name):
        setattr(shelf, name, make())
    return getattr(shelf, name)


def _decode(ids: bytes, tokens: dict[int, bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _vocabulary(spark: SparkSession, rank_file: str):
    """(name, ranks, tokens): the rank file, read once on the driver and broadcast (its size is
    fixed), and what workers make of it."""
    with open(rank_file, "rb") as f:
        raw = f.read()
    sent = spark.sparkContext.broadcast(raw)

    def ranks() -> dict[bytes, int]:
        return {base64.b64decode(a): int(b)
                for a, b in map(bytes.split, sent.value.splitlines())}

    return hashlib.md5(raw).hexdigest(), ranks, lambda: {b: a for a, b in ranks().items()}


def encode(docs: DataFrame, text: str, rank_file: str, pattern: str, cut: str | None = CUT,
           ids: str = "token_ids", n_tokens: str = "n_tokens",
           decoded: str | None = None) -> DataFrame:
    """``docs`` plus the packed ids of its texts, their number and, if ``decoded`` names a column,
    the bytes that the ids decode to.

    Null and empty texts: no ids. Special tokens are ordinary text. Every row is encoded by itself,
    so repeated rows, ties and other columns play no part; an empty table gives an empty result.
    cut: a pattern (of ``re``) for runs across whose bounds ``pattern`` never matches; None: no
    such runs.
    """
    name, ranks, tokens = _vocabulary(docs.sparkSession, rank_file)
    key = hashlib.md5(pattern.encode()).hexdigest()

    def work(cols: list[pa.Array]) -> list[pa.Array]:
        pieces = _kept(f"pieces_{name}_{key}", lambda: Pieces(ranks(), pattern))
        out = pieces.encode([t or "" for t in cols[0].to_pylist()], cut and re.compile(cut))
        made = [pa.array(out, pa.binary()), pa.array([len(x) // 4 for x in out], pa.int64())]
        if decoded:
            known = _kept(f"tokens_{name}", tokens)
            made.append(pa.array([_decode(x, known) for x in out], pa.binary()))
        return made

    fields = [T.StructField(ids, T.BinaryType()), T.StructField(n_tokens, T.LongType())]
    if decoded:
        fields.append(T.StructField(decoded, T.BinaryType()))
    return with_python_columns(docs, [text], fields, work)


def decode(encoded: DataFrame, rank_file: str, ids: str = "token_ids",
           out: str = "decoded") -> DataFrame:
    """``encoded`` plus the bytes of its ids (null ids: none). An unknown id is an error."""
    name, _, tokens = _vocabulary(encoded.sparkSession, rank_file)

    def work(cols: list[pa.Array]) -> list[pa.Array]:
        known = _kept(f"tokens_{name}", tokens)
        return [pa.array([_decode(x or b"", known) for x in cols[0].to_pylist()], pa.binary())]

    return with_python_columns(encoded, [ids], [T.StructField(out, T.BinaryType())], work)


def unpack(ids: bytes) -> list[int]:
    """Packed ids as a list of integers."""
    return np.frombuffer(ids, "<u4").tolist()

