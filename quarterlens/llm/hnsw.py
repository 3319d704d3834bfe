"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard.

Equal vectors are one node that keeps its ``k`` + 1 smallest ids (enough for any query), so a
vector that holds a third of all rows neither clogs a graph nor lands in one task. Nodes are
dealt over about sqrt(n) / 32 shards by hash, so both the shards and their number grow slowly.

A graph's nodes are ordered by level, highest first: level l holds nodes 0 .. n_l - 1, and its
neighbours are one flat int32 array of n_l rows (-1: no neighbour). Nodes are inserted in
batches that at most double the graph; a batch searches the graph as it is, compares its own
nodes directly, and picks neighbours by the usual diversity rule, filled up with the nearest.
Searching runs many queries at once, each with its own beam. A shard's graph is one row of the
index (entry point, level sizes, neighbours, vectors, ids).

Graphs are walked in single precision, so shards are by magnitude too: within one, the largest
components differ by a factor of 2^``BAND`` at most, and squares neither vanish nor overflow. One
row that is 10^24 times longer than the others is a shard of its own. A query beyond 2^``FAR`` times
its shard is drawn in to that distance: from there on only its direction decides.

Every query meets every shard. A shard's index row is read once by its task, and the queries stream
past it in blocks; it returns each query's ``k`` best with exact distances in double precision,
and the shards' results are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quarterlens.llm.common import checkpointed, with_python_columns
from quarterlens.llm.vectors import usable

M = 16                      # neighbours a node picks on each level; twice that on level 0
EF_BUILD = 100              # beam while building
EF_SEARCH = 160             # beam while searching
EXPAND = 4                  # beam entries expanded in one step
BATCH = 512                 # nodes inserted, or queries searched, at once
VISITED = 1 << 26           # cells of the visited table of one search
QUERY_BLOCK = 1 << 12       # queries searched at a time by a task
BAND, FAR = 32, 20          # powers of two
INDEX = ("shard int, dim int, band int, levels array<int>, neighbours binary, vectors binary, "
         "id_ends binary, ids binary")


def _distances(vectors: np.ndarray, norms: np.ndarray, q: np.ndarray, ids: np.ndarray):
    """Squared distances (without |q|^2) of each query to its row of node ids (-1: infinite)."""
    d = norms[ids] - 2 * np.matmul(vectors[ids], q[:, :, None])[:, :, 0]
    d[ids < 0] = np.inf
    return d


def beam_search(vectors: np.ndarray, norms: np.ndarray, links: np.ndarray, q: np.ndarray,
                entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, distances) of each query's beam on one level, nearest first; -1 pads."""
    step = max(1, VISITED // max(1, len(links)))
    if len(q) > step:
        parts = [beam_search(vectors, norms, links, q[i:i + step], entry[i:i + step], ef)
                 for i in range(0, len(q), step)]
        return tuple(np.concatenate(x) for x in zip(*parts))
    n, rows = len(q), np.arange(len(q))
    seen = np.zeros((n, len(links) + 1), bool)        # the last column is for -1
    seen[:, -1] = True
    ids = np.full((n, ef), -1, np.int64)
    ids[:, :entry.shape[1]] = entry[:, :ef]
    seen[rows[:, None], ids] = True
    dist = _distances(vectors, norms, q, ids)
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
    opened = ids < 0
    expand = min(EXPAND, ef)
    live = rows
    while len(live):
        o = opened[live]
        rank = np.cumsum(~o, axis=1)
        pick = ~o & (rank <= expand)
        more = pick.any(1)
        live, pick = live[more], pick[more]
        if not len(live):
            break
        r, c = np.nonzero(pick)
        near = np.full((len(live), expand), -1, np.int64)
        near[r, (rank[more][r, c] - 1)] = ids[live[r], c]
        opened[live[r], c] = True
        new = links[near].reshape(len(live), -1).astype(np.int64)
        new[np.repeat(near < 0, links.shape[1], axis=1)] = -1
        new.sort(axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        new[seen[live[:, None], new]] = -1
        seen[live[:, None], new] = True
        d = _distances(vectors, norms, q[live], new)
        all_ids = np.concatenate([ids[live], new], axis=1)
        all_d = np.concatenate([dist[live], d], axis=1)
        all_o = np.concatenate([opened[live], new < 0], axis=1)
        keep = np.argsort(all_d, axis=1, kind="stable")[:, :ef]
        ids[live] = np.take_along_axis(all_ids, keep, 1)
        dist[live] = np.take_along_axis(all_d, keep, 1)
        opened[live] = np.take_along_axis(all_o, keep, 1) | (ids[live] < 0)
    ids[~np.isfinite(dist)] = -1
    return ids, dist


def _pick(vectors: np.ndarray, q: np.ndarray, ids: np.ndarray, m: int) -> np.ndarray:
    """Up to ``m`` neighbours of each row of ``q`` out of its candidates: a candidate that is
    nearer to a neighbour already picked than to the node waits; gaps are filled by those."""
    v = vectors[ids]
    d = ((v - q[:, None, :]) ** 2).sum(2)
    d[ids < 0] = np.inf
    order = np.argsort(d, axis=1, kind="stable")
    ids, d = np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1)
    v = np.take_along_axis(v, order[:, :, None], 1)
    sq = (v ** 2).sum(2)
    apart = sq[:, :, None] + sq[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
    width = ids.shape[1]
    picked = np.zeros(ids.shape, bool)
    for c in range(width):
        blocked = (picked[:, :c] & (apart[:, c, :c] < d[:, c:c + 1])).any(1)
        picked[:, c] = ~blocked & (ids[:, c] >= 0) & (picked[:, :c].sum(1) < m)
    rank = np.where(picked, 0, 1) * width + np.arange(width)
    rank[ids < 0] = 2 * width
    best = np.argsort(rank, axis=1, kind="stable")[:, :m]
    out = np.take_along_axis(ids, best, 1)
    if out.shape[1] < m:
        out = np.pad(out, ((0, 0), (0, m - out.shape[1])), constant_values=-1)
    return out


def _link_back(vectors: np.ndarray, links: np.ndarray, nodes: np.ndarray, picked: np.ndarray):
    """Adds the reverse of new links; a full node picks anew among old and new neighbours."""
    source = np.repeat(nodes, picked.shape[1])
    target = picked.ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    heads, first, count = np.unique(target, return_index=True, return_counts=True)
    for i in range(0, len(heads), BATCH):
        h, f, c = heads[i:i + BATCH], first[i:i + BATCH], count[i:i + BATCH]
        new = np.full((len(h), c.max()), -1, np.int64)
        at = np.arange(c.max())
        has = at < c[:, None]
        new[has] = source[(f[:, None] + at)[has]]
        both = np.concatenate([links[h].astype(np.int64), new], axis=1)
        both.sort(axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        both = -np.sort(-both, axis=1)
        width = max(1, int((both >= 0).sum(1).max()))
        cap = links.shape[1]
        both = both[:, :width]
        if width <= cap:
            links[h] = np.pad(both, ((0, 0), (0, cap - width)), constant_values=-1)
        else:
            links[h] = _pick(vectors, vectors[h], both, cap)


def build(vectors: np.ndarray, seed: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(order, levels) of the graph of ``vectors`` (float32): nodes in order of level, highest
    first, and one neighbour array a level, level 0 first."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    level = np.minimum((-np.log(1 - rng.random(n)) / math.log(M)).astype(int), 24)
    order = np.argsort(-level, kind="stable")
    vectors, level = vectors[order], level[order]
    norms = (vectors ** 2).sum(1)
    sizes = [int((level >= lv).sum()) for lv in range(int(level[0]) + 1)]
    graph = [np.full((s, M if lv else 2 * M), -1, np.int32) for lv, s in enumerate(sizes)]
    done = 1
    while done < n:
        end = min(2 * done, done + BATCH, n)
        own = level[done]
        end = min(end, int(np.searchsorted(-level, -own, side="right")))
        nodes = np.arange(done, end)
        q = vectors[nodes]
        entry = np.zeros((len(nodes), 1), np.int64)
        for lv in range(len(sizes) - 1, -1, -1):
            if lv > own:
                entry = beam_search(vectors, norms, graph[lv], q, entry, 1)[0]
                continue
            ids, _ = beam_search(vectors, norms, graph[lv], q, entry, EF_BUILD)
            entry = ids
            among = np.broadcast_to(nodes, (len(nodes), len(nodes))).copy()
            np.fill_diagonal(among, -1)
            if len(nodes) > EF_BUILD:
                d = norms[nodes] - 2 * q @ q.T
                np.fill_diagonal(d, np.inf)
                near = np.argpartition(d, M, axis=1)[:, :M]
                among = np.take_along_axis(among, near, 1)
            picked = _pick(vectors, q, np.concatenate([ids, among], axis=1), M)
            graph[lv][nodes, :M] = picked
            _link_back(vectors, graph[lv], nodes, picked)
        done = end
    return order, graph


def search(vectors: np.ndarray, graph: list[np.ndarray], q: np.ndarray) -> np.ndarray:
    """Node ids of each query's beam on level 0 (-1 pads)."""
    scale = np.abs(vectors).max()           # single precision must hold the squares
    low = (vectors / scale).astype(np.float32)
    norms = (low ** 2).sum(1)
    far = np.abs(q).max(1, keepdims=True) / (scale * 2.0 ** FAR)
    q = (q / scale / np.maximum(far, 1)).astype(np.float32)
    out = []
    for i in range(0, len(q), BATCH):
        part = q[i:i + BATCH]
        entry = np.zeros((len(part), 1), np.int64)
        for links in graph[:0:-1]:
            entry = beam_search(low, norms, links, part, entry, 1)[0]
        out.append(beam_search(low, norms, graph[0], part, entry, EF_SEARCH)[0])
    return np.concatenate(out)


def _build_shard(group: pa.Table) -> pa.Table:
    shard, dim, band = (group.column(c)[0].as_py() for c in ("shard", "dim", "band"))
    packed = group.column("vec").to_pylist()
    first = sorted(range(len(packed)), key=packed.__getitem__)   # whatever order rows came in
    vectors = np.frombuffer(b"".join(packed), "<f8").reshape(len(packed), -1)[first]
    ids = group.column("ids").to_pylist()
    order, graph = build((vectors / np.abs(vectors).max()).astype(np.float32), shard)
    ids = [ids[first[i]] for i in order]
    return pa.table({
        "shard": pa.array([shard], pa.int32()), "dim": pa.array([dim], pa.int32()),
        "band": pa.array([band], pa.int32()),
        "levels": pa.array([[len(g) for g in graph]], pa.list_(pa.int32())),
        "neighbours": pa.array([b"".join(g.tobytes() for g in graph)], pa.binary()),
        "vectors": pa.array([vectors[order].tobytes()], pa.binary()),
        "id_ends": pa.array([np.cumsum([len(x) for x in ids]).astype("<i8").tobytes()],
                            pa.binary()),
        "ids": pa.array([np.array([i for x in ids for i in x], "<i8").tobytes()], pa.binary())})


def read_graph(row: dict) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """(vectors, levels, id ends, ids) of an index row."""
    vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, row["dim"])
    flat, graph, at = np.frombuffer(row["neighbours"], "<i4"), [], 0
    for lv, size in enumerate(row["levels"]):
        width = M if lv else 2 * M
        graph.append(flat[at:at + size * width].reshape(size, width))
        at += size * width
    return vectors, graph, np.frombuffer(row["id_ends"], "<i8"), np.frombuffer(row["ids"], "<i8")


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search_block(index: tuple, q: np.ndarray, own: np.ndarray, k: int) -> pa.RecordBatch:
    vectors, graph, ends, ids = index
    starts = np.r_[0, ends[:-1]]
    found = search(vectors, graph, q)
    out = ([], [], [])
    for i, nodes in enumerate(found):
        nodes = nodes[nodes >= 0]
        exact = np.sqrt(((vectors[nodes] - q[i]) ** 2).sum(1))
        count = ends[nodes] - starts[nodes]
        cand = np.concatenate([ids[starts[x]:ends[x]] for x in nodes])
        d = np.repeat(exact, count)
        other = cand != own[i]
        cand, d = cand[other], d[other]
        best = np.lexsort((cand, d))[:k]
        out[0].append(np.full(len(best), own[i]))
        out[1].append(cand[best])
        out[2].append(d[best])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], schema=_FOUND)


def _search_shards(k: int):
    """Rows of whole shards, sorted: the index row, then the queries that stream past it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, key, held = None, None, []

        def answer() -> Iterator[pa.RecordBatch]:
            if held:
                q = np.frombuffer(b"".join(v for _, v in held), "<f8").reshape(len(held), -1)
                yield _search_block(index, q, np.array([i for i, _ in held]), k)
                held.clear()

        for b in batches:
            for row in b.to_pylist():
                if row["vec"] is None:
                    yield from answer()
                    index, key = read_graph(row), (row["shard"], row["dim"], row["band"])
                elif (row["shard"], row["dim"], row["band"]) == key:
                    held.append((row["vec_id"], row["vec"]))
                    if len(held) >= QUERY_BLOCK:
                        yield from answer()
        yield from answer()
    return run


def _bands(cols: list[pa.Array]) -> list[pa.Array]:
    """The magnitude of packed vectors: their largest component's power of two, in steps."""
    most = [np.abs(np.frombuffer(v, "<f8")).max() for v in cols[0].to_pylist()]
    return [pa.array((np.frexp(np.array(most, "f8"))[1] + BAND // 2) // BAND, pa.int32())]


def build_index(vectors: DataFrame, k: int, id_col: str = "vec_id",
                vec: str = "embedding") -> DataFrame:
    """The index (columns ``INDEX``) of every usable vector, for up to ``k`` neighbours."""
    rows = usable(vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                                 F.col(vec).alias("vec")), "vec") \
        .where("vec IS NOT NULL AND vec_id IS NOT NULL").distinct()
    least = Window.partitionBy("vec").orderBy("vec_id")
    nodes = rows.withColumn("nth", F.row_number().over(least)).where(F.col("nth") <= k + 1) \
        .groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = checkpointed(with_python_columns(nodes, ["vec"], [T.StructField("band", T.IntegerType())],
                                             _bands))
    shards = max(1, math.ceil(math.sqrt(nodes.count()) / 32))
    return checkpointed(nodes.withColumn("shard", F.pmod(F.xxhash64("vec"), F.lit(shards))
                                         .cast("int"))
                        .withColumn("dim", (F.octet_length("vec") / 8).cast("int"))
                        .groupBy("shard", "dim", "band").applyInArrow(_build_shard, INDEX))


def nearest(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id",
            vec: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row that satisfies
    ``is_query`` (a condition on the id), by Euclidean distance; ties go to the smaller id.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without
    an id, take no part; vectors of different lengths are never compared. Exact repeats of a row
    count once. Rows so far from a query that double precision cannot tell their distances apart
    are ties, of which those found first in their graphs come. A query's own id is no candidate. Fewer than ``k`` candidates: all of them, as far
    as found. An empty table gives an empty result. Other columns are not read.
    """
    index = build_index(vectors, k, id_col, vec)
    queries = usable(vectors.where(is_query).select(F.col(id_col).cast("long").alias("vec_id"),
                                                    F.col(vec).alias("vec")), "vec") \
        .where("vec IS NOT NULL AND vec_id IS NOT NULL").distinct() \
        .withColumn("dim", (F.octet_length("vec") / 8).cast("int"))
    shards = index.select("shard", "band", F.col("dim").alias("d")).groupBy("d") \
        .agg(F.collect_set(F.struct("shard", "band")).alias("shards"))
    asked = queries.join(shards, F.col("dim") == F.col("d")) \
        .select(F.explode("shards").alias("s"), "dim", "vec_id", "vec") \
        .select("s.shard", "dim", "s.band", "vec_id", "vec")
    rows = index.unionByName(asked, allowMissingColumns=True)
    group = ["shard", "dim", "band"]
    found = rows.withColumn("is_query", F.col("vec").isNotNull()).repartition(*group) \
        .sortWithinPartitions(*group, "is_query").drop("is_query") \
        .mapInArrow(_search_shards(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
