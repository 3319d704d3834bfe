"""Near-duplicate embeddings by product quantisation.

Coarse centroids and residual sub-space codes are fitted on a bounded sample (``SAMPLE`` vectors of
smallest hash); every vector is indexed. With unit vectors, cosine >= c is a distance of at
most t = sqrt(2 - 2c), which makes each approximate step safe:

* probes: a vector within t of a query lies in its own list, so the query is at most t beyond
  the plane between its own centroid and that one; exactly those lists are probed;
* codes: a list stores each vector's quantisation error e, and |table distance - true distance|
  <= e, so every table distance up to t + e (plus rounding) is a candidate;
* candidates are ranked anew by the exact cosine in double precision.

So no pair is missed and none is added. Equal vectors of one label are one node with a
multiplicity. A list of one label with more than ``BLOCK`` vectors is cut into blocks, and so are
its probes beyond ``PROBE_BLOCK``; each pair of a block and a probe block is searched by itself, and
small pairs share tasks, as many as their vectors and probes ask for. Links never leave a task
as pairs: each probe brings back its number of links and an edge to the representative of what
it links to.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterlens.llm.common import checkpointed
from quarterlens.llm.components import connected_components
from quarterlens.llm.vectors import unpacked, usable

SAMPLE = 16384              # vectors that the codebooks are fitted on
ROUNDS = 8                  # k-means rounds
SUBSPACES = 8
CODES = 64                  # codes a sub-space
MAX_LISTS = 1024
BLOCK = 4096                # vectors of one list and label that one task searches
PROBE_BLOCK = 16384         # probes of one list and label that one task holds
PROBES = 1024               # probes compared at once
BUCKET = 16384              # vectors and probes a task holds, about
SLACK = 1e-5                # rounding of single-precision table distances
KEY = ("label", "dim", "list", "block", "probe_block")      # of what is searched by itself


def k_means(x: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Centroids of the rows of ``x`` (at most k; an empty cluster keeps its centroid)."""
    rng = np.random.default_rng(seed)
    centroids = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        near = _nearest(x, centroids)
        count = np.bincount(near, minlength=len(centroids))
        total = np.zeros_like(centroids)
        np.add.at(total, near, x)
        some = count > 0
        centroids[some] = total[some] / count[some, None]
    return centroids


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids ** 2).sum(1) - 2 * x @ centroids.T, axis=1)


def fit(sample: np.ndarray, n: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(coarse centroids, one codebook a sub-space) for n unit vectors, from a sample."""
    lists = max(1, min(MAX_LISTS, len(sample), round(math.sqrt(n) / 2)))
    coarse = k_means(sample, lists)
    residual = sample - coarse[_nearest(sample, coarse)]
    parts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
    return coarse, [k_means(residual[:, p], CODES, i + 1) for i, p in enumerate(parts)]


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)          # no overflow in the norm
    return v / np.sqrt((v ** 2).sum(1, keepdims=True))


def _encode(u: np.ndarray, home: np.ndarray, coarse: np.ndarray, books: list[np.ndarray]):
    """(codes, quantisation errors) of unit vectors."""
    residual = u - coarse[home]
    parts = np.array_split(np.arange(u.shape[1]), len(books))
    codes = np.stack([_nearest(residual[:, p], b) for p, b in zip(parts, books)], axis=1)
    near = np.concatenate([b[codes[:, i]] for i, b in enumerate(books)], axis=1)
    return codes.astype(np.uint8), np.sqrt(((residual - near) ** 2).sum(1))


def _probes(u: np.ndarray, home: np.ndarray, coarse: np.ndarray, t: float):
    """(row, list) of every list that can hold a vector within t of the row's."""
    d = ((u ** 2).sum(1)[:, None] - 2 * u @ coarse.T + (coarse ** 2).sum(1))
    own = coarse[home]
    gap = np.sqrt(np.maximum(((own[:, None, :] - coarse[None]) ** 2).sum(2), 0)) \
        if len(u) * coarse.size <= 1 << 24 else \
        np.sqrt(np.maximum((own ** 2).sum(1)[:, None] - 2 * own @ coarse.T
                           + (coarse ** 2).sum(1), 0))
    beyond = d - d[np.arange(len(u)), home][:, None]
    return np.nonzero(beyond <= 2 * t * gap + SLACK)


def _components(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of each of n nodes' component under the edges a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _match(t: float, cosine: float, model: dict):
    """Links between the vectors of a list block and its probes."""
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("other", pa.int64())])

    def one(coarse, books, lst, codes, err, u, mult, ref, q, probe):
        """(probe node, links, edges) of one block."""
        parts = np.array_split(np.arange(u.shape[1]), len(books))
        tally, edges = [], []
        for i in range(0, len(q), PROBES):
            x, own = q[i:i + PROBES], probe[i:i + PROBES]
            shifted = x - coarse[lst]
            est = np.zeros((len(x), len(u)), np.float32)
            for s, (p, book) in enumerate(zip(parts, books)):
                lut = ((shifted[:, p][:, None, :] - book[None]) ** 2).sum(2).astype(np.float32)
                est += lut[:, codes[:, s]]
            cand = np.sqrt(np.maximum(est, 0)) <= t + err[None] + SLACK
            cand &= own[:, None] != ref[None]
            r, c = np.nonzero(cand)
            good = np.zeros(len(r), bool)
            for j in range(0, len(r), 1 << 16):
                cut = slice(j, j + (1 << 16))
                good[cut] = (x[r[cut]] * u[c[cut]]).sum(1) >= cosine
            r, c = r[good], c[good]
            tally.append(np.bincount(r, mult[c], minlength=len(x)).astype(np.int64))
            if len(r):
                label = _components(r, len(x) + c, len(x) + len(u))
                name = np.concatenate([own, ref])
                moved = np.flatnonzero(label != np.arange(len(label)))
                edges.append((name[moved], name[label[moved]]))
        return np.concatenate(tally), edges

    def run(refs: pa.Table, probes: pa.Table) -> pa.Table:
        if not refs.num_rows or not probes.num_rows:
            return schema.empty_table()
        node, n, other = [], [], []
        dims = refs.column("dim").to_numpy(), probes.column("dim").to_numpy()
        for dim in np.unique(dims[0]):
            r = refs.filter(pa.array(dims[0] == dim))
            p = probes.filter(pa.array(dims[1] == dim))
            if not p.num_rows:
                continue
            coarse, books = model.get(int(dim)) or _empty_model(int(dim))
            key = [np.stack([x.column(c).to_numpy() for c in KEY if c != "dim"], axis=1)
                   for x in (r, p)]
            _, inverse = np.unique(np.concatenate(key), axis=0, return_inverse=True)
            inverse = inverse.ravel()
            rk, pk = inverse[:r.num_rows], inverse[r.num_rows:]
            ro, po = np.argsort(rk, kind="stable"), np.argsort(pk, kind="stable")
            u, q = _unit(unpacked(r.column("vec"))), _unit(unpacked(p.column("vec")))
            codes = np.frombuffer(b"".join(r.column("codes").to_pylist()),
                                  np.uint8).reshape(r.num_rows, -1)
            cols = [r.column(c).to_numpy() for c in ("list", "err", "mult", "node")]
            probe = p.column("node").to_numpy()
            for k in np.intersect1d(rk, pk):
                a = ro[np.searchsorted(rk[ro], k):np.searchsorted(rk[ro], k, "right")]
                b = po[np.searchsorted(pk[po], k):np.searchsorted(pk[po], k, "right")]
                tally, edges = one(coarse, books, cols[0][a[0]], codes[a], cols[1][a], u[a],
                                   cols[2][a], cols[3][a], q[b], probe[b])
                some = tally > 0
                node.append(probe[b][some])
                n.append(tally[some])
                other.append(probe[b][some])
                for x, y in edges:
                    node.append(x)
                    n.append(np.zeros(len(x), np.int64))
                    other.append(y)
        empty = np.zeros(0, np.int64)
        return pa.table([np.concatenate(x or [empty]) for x in (node, n, other)], schema=schema)

    return run


def _empty_model(dim: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """For a length that the sample lacks: one list, one code, so everything is compared."""
    parts = np.array_split(np.arange(dim), min(SUBSPACES, dim))
    return np.zeros((1, dim)), [np.zeros((1, len(p))) for p in parts]


def _models(nodes: DataFrame, n: int) -> dict:
    """Codebooks by vector length, fitted on the vectors of smallest hash."""
    sample = nodes.select("dim", "vec").orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).toArrow()
    out = {}
    dims = sample.column("dim").to_numpy()
    for dim in np.unique(dims):
        rows = sample.filter(pa.array(dims == dim))
        out[int(dim)] = fit(_unit(unpacked(rows.column("vec"))), n)
    return out


def _dealt(refs: DataFrame, probes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides, each row once for every block of the other side of its list, with a bucket.

    A pair of blocks has about ``BLOCK`` vectors and ``PROBE_BLOCK`` probes at most; there are as
    many buckets as hold ``BUCKET`` of the rows that are dealt.
    """
    key = ["label", "dim", "list"]
    asked = probes.groupBy(*key).agg(F.count("*").alias("asked"))
    sizes = checkpointed(refs.groupBy(*key).agg(F.count("*").alias("held")).join(asked, key)
                         .withColumn("blocks", F.ceil(F.col("held") / BLOCK).cast("int"))
                         .withColumn("probe_blocks",
                                     F.ceil(F.col("asked") / PROBE_BLOCK).cast("int")))
    dealt = sizes.agg(F.sum(F.col("held") * F.col("probe_blocks")
                            + F.col("asked") * F.col("blocks"))).first()[0] or 0
    held = sizes.agg(F.sum("held")).first()[0] or 0
    buckets = max(1, math.ceil(held / BUCKET) * 8, math.ceil(dealt / BUCKET))
    bucket = F.pmod(F.xxhash64(*KEY), F.lit(buckets)).alias("bucket")
    sizes = sizes.select(*key, "blocks", "probe_blocks")

    def side(rows: DataFrame, own: str, n_own: str, other: str, n_other: str, *columns: str):
        return rows.join(sizes, key) \
            .withColumn(own, F.pmod(F.xxhash64("node"), F.col(n_own)).cast("int")) \
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(n_other) - 1))) \
            .select(bucket, *KEY, "node", "vec", *columns)

    return (side(refs, "block", "blocks", "probe_block", "probe_blocks", "mult", "codes", "err"),
            side(probes, "probe_block", "probe_blocks", "block", "blocks"))


def near_duplicates(vectors: DataFrame, cosine: float = 0.98, id_col: str = "vec_id",
                    vec: str = "embedding", label: str = "label") -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept.

    Rows link if their labels are equal and not null and their cosine is at least ``cosine``. Null,
    empty and zero vectors, and those with null or non-finite components, link with nothing;
    neither do vectors of different lengths. n_links counts the other rows linked directly,
    repeats included. component_id is the smallest id reachable, the row's own included (null ids
    are never one). kept: the row's id is its component_id. An empty table gives an empty result.
    Other columns are not read.
    """
    t = math.sqrt(2 - 2 * cosine)
    rows = usable(vectors.select(F.col(id_col).cast("long").alias("id"),
                                 F.col(label).alias("tag"), F.col(vec).alias("vec")), "vec") \
        .withColumn("vec", F.when(F.col("tag").isNotNull(), F.col("vec")))
    rows = checkpointed(rows)
    whole = isinstance(vectors.schema[label].dataType, T.IntegralType)
    tag_key = F.col("tag").cast("long") if whole else F.xxhash64("tag")
    live = rows.where("vec IS NOT NULL")
    nodes = checkpointed(live.groupBy("tag", "vec").agg(F.count("*").alias("mult"),
                                                        F.min("id").alias("least_id"))
                         .withColumn("dim", (F.octet_length("vec") / 8).cast("int"))
                         .withColumn("label", tag_key)
                         .withColumn("node", F.monotonically_increasing_id()))
    n = nodes.count()
    model = _models(nodes, n)

    def assign(batches):
        for b in batches:
            out = {c: [] for c in ("at", "list", "home", "codes", "err")}
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                coarse, books = model.get(int(dim)) or _empty_model(int(dim))
                for i in range(0, len(at), PROBES):
                    rows = at[i:i + PROBES]
                    u = _unit(unpacked(b.column("vec").take(pa.array(rows))))
                    home = _nearest(u, coarse)
                    codes, err = _encode(u, home, coarse, books)
                    r, lists = _probes(u, home, coarse, t)
                    own = lists == home[r]
                    out["at"].append(rows[r])
                    out["list"].append(lists)
                    out["home"].append(own)
                    out["codes"] += [codes[x].tobytes() if h else None for x, h in zip(r, own)]
                    out["err"].append(np.where(own, err[r], 0))
            if not out["at"]:
                continue
            taken = b.take(pa.array(np.concatenate(out["at"])))
            yield pa.RecordBatch.from_arrays(
                [*(taken.column(c) for c in ("label", "dim", "node", "mult", "vec")),
                 pa.array(np.concatenate(out["list"]).astype(np.int32)),
                 pa.array(np.concatenate(out["home"])), pa.array(out["codes"], pa.binary()),
                 pa.array(np.concatenate(out["err"]))],
                names=["label", "dim", "node", "mult", "vec", "list", "home", "codes", "err"])

    placed = checkpointed(nodes.mapInArrow(assign, "label long, dim int, node long, mult long, "
                                           "vec binary, list int, home boolean, codes binary, "
                                           "err double"))
    refs = placed.where("home")
    probes = placed.select(*[F.col(c).alias(c) for c in ("label", "dim", "node", "vec", "list")])
    refs, probes = _dealt(refs, probes)
    found = checkpointed(refs.groupBy("bucket").cogroup(probes.groupBy("bucket")).applyInArrow(
        _match(t, cosine, model), "node long, n long, other long"))

    tally = found.where("n > 0").groupBy("node").agg(F.sum("n").alias("n"))
    labels = connected_components(found.where("node <> other"), "node", "other")
    member = checkpointed(
        nodes.select("tag", "vec", "node", "mult", "least_id")
        .join(tally, "node", "left").join(labels, "node", "left")
        .select("tag", "vec", "least_id", F.coalesce("label", "node").alias("root"),
                (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links")))
    least = checkpointed(member.groupBy("root").agg(F.min("least_id").alias("component_id")))
    member = checkpointed(member.join(least, "root").select(
        F.col("tag").alias("t"), F.col("vec").alias("v"), "n_links", "component_id"))
    linked = live.join(member, (F.col("tag") == F.col("t")) & (F.col("vec") == F.col("v"))) \
        .select("id", "n_links", "component_id")
    alone = rows.where("vec IS NULL").select("id", F.lit(0).cast(T.LongType()).alias("n_links"),
                                             F.col("id").alias("component_id"))
    return linked.union(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
