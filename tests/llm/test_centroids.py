"""Clustering of distinct vectors against Lloyd's rounds over all rows, one by one."""

import hashlib
import math
import random

import numpy as np

from scriptorium.llm import centroids
from scriptorium.llm.centroids import cluster_vectors

SCHEMA = "vec_id long, embedding array<float>, vector string, n long, cluster string"


def plain(rows, k=8, rounds=10, width=4, scale=1024, seed=3):
    kept = []
    for i, e, *_ in rows:
        if e is not None and len(e) == width and all(x is not None and math.isfinite(x) and abs(x * scale) < 1 << 27 for x in e):
            kept.append((i, tuple(math.floor(scale * float(np.float32(x))) for x in e)))
    name = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    first = sorted(kept, key=lambda r: (r[0] is None, name(r[0]) if r[0] is not None else "", r[1]))[:k]
    cs = [list(v) for _, v in first]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    own = lambda v: min(range(len(cs)), key=lambda j: (far(v, cs[j]), j))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(own(v), []).append(v)
        for j, g in groups.items():
            cs[j] = [sum(x) // len(g) for x in zip(*g)]
    out = [(i, own(v), far(v, cs[own(v)])) for i, v in kept]
    inertia = {j: sum(d for _, c, d in out if c == j) for j in range(len(cs))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), sha[c]) for i, c, d in out), key=str)


def vectors():
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(i % 9, 0.4) for _ in range(4)]) for i in range(300)]
    rows += [(1000 + i, [0.25, -0.5, 1.0, 2.0]) for i in range(400)]  # one vector holds over half of all rows
    rows += [(2000, None), (2001, []), (2002, [1.0, 2.0]), (2003, [1.0, None, 2.0, 3.0]), (2004, [1.0, float("nan"), 0.0, 0.0]), (2005, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(2006, [1e30, 0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0, 1.0]), (None, [9.0, 1.0, 1.0, -1.0]), (7, [3.0, 3.0, 3.0, 3.0]), (8, [-130000.0, 5.0, 1.0, 0.0]), (8, [-130000.0, 5.0, 1.0, 0.0])]
    return [(*r, "v", 1, "c") for r in rows]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_rounds_over_all_rows(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(cluster_vectors(df, width=4)) == plain(rows)
    assert got(cluster_vectors(df, width=4, clusters=3, rounds=1)) == plain(rows, k=3, rounds=1)
    assert got(cluster_vectors(df, width=4, rounds=0)) == plain(rows, rounds=0)


def test_few_or_no_vectors(spark):
    assert got(cluster_vectors(spark.createDataFrame([], SCHEMA), width=4)) == []
    rows = [(5, [1.0, 2.0, 3.0, 4.0], "v", 1, "c"), (6, [1.0, 2.0, 3.0, 4.0], "v", 1, "c"), (9, None, "v", 1, "c")]
    assert got(cluster_vectors(spark.createDataFrame(rows, SCHEMA), width=4)) == plain(rows)
    assert got(cluster_vectors(spark.createDataFrame(rows, SCHEMA))) == []  # another width than the vectors'


def test_same_rows_without_broadcast(spark, monkeypatch):
    import scriptorium.llm.common as common

    rows = vectors()
    monkeypatch.setattr(common, "BROADCAST_LIMIT", 0)
    assert got(cluster_vectors(spark.createDataFrame(rows, SCHEMA).repartition(5), width=4)) == plain(rows)


def test_sums_beyond_a_long():
    x, n = np.array([[1 << 26, -(1 << 26)], [3, 4]], np.int64), np.array([1 << 50, 2], np.int64)
    assert centroids._weighted(x, n) == [(1 << 76) + 6, -(1 << 76) + 8]
