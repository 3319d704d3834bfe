"""Brute-force versions and fixtures of the training-data operators."""

import itertools
import os

import duckdb
import numpy as np
import xxhash

SMALL = "/root/testdata/sf0.001"


def read(sf_dir, name, order):
    con = duckdb.connect()
    path = os.path.join(sf_dir, f"{name}.parquet")
    return con.execute(f"SELECT * FROM read_parquet('{path}') ORDER BY {order}").fetchdf()


def oracle(sql, sf_dir, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con.execute(sql).fetchall()


def words(text):
    return (text or "").encode().split()


def fingerprint(text, n=4):
    w = [x.lower() for x in words(text)]
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))]
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(n, pairs):
    """Smallest reachable index of each of n indices."""
    label = list(range(n))

    def find(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near_dup_ids(ids, texts, bits=4):
    """component_id of each row by comparing all pairs."""
    fp = [fingerprint(t) for t in texts]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(fp)), 2)
             if (fp[i] ^ fp[j]).bit_count() <= bits]
    label = components(len(fp), pairs)
    least = {}
    for lab, i in zip(label, ids):
        if i is not None:
            least[lab] = min(i, least.get(lab, i))
    return fp, [least.get(lab) for lab in label]


def remove_repeats(rows, window=13):
    """{id: (n_words, n_removed, kept text)} for rows (id, text) of distinct ids."""
    first = {}
    big = float("inf")
    split = [(i, words(t)) for i, t in rows]
    for i, w in split:
        for j in range(len(w) - window + 1):
            k = tuple(w[j:j + window])
            first[k] = min(first.get(k, big), big if i is None else i)
    out = {}
    for i, w in split:
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if first[tuple(w[j:j + window])] < (big if i is None else i):
                gone[j:j + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g).decode()
        out[i] = (len(w), sum(gone), kept)
    return out


def nearest(ids, x, queries, k=10):
    """{query: [(id, distance)]} by exact search."""
    out = {}
    for q in queries:
        i = ids.index(q)
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        order = sorted((d[j], ids[j]) for j in range(len(ids)) if j != i)
        out[q] = [(j, s) for s, j in order[:k]]
    return out
