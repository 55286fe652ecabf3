"""Operator 11: Lloyd's clustering of distinct quantised vectors, weighted by how often each occurs.

1. Vectors are quantised to integers and grouped; equal ones become one row with its multiplicity (Spark combines
   them before the shuffle, so a vector that a third of all rows share costs one row a task).
2. Each round reads the distinct vectors once.  Tasks hold the centroids only, and send per cluster and component one
   exact weighted sum; the driver gets ``clusters * (width + 1)`` sums, whatever the corpus.
3. The assignment of each distinct vector is joined back to the ids; vectors of very many rows go to all executors,
   the rest meet by a shuffle.

Distinct vectors, ids and assignments are written to the shared folder, so a lost executor costs no earlier round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import Written, join_classes, releasing, table

WIDTH, SCALE, CLUSTERS, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Quantised components lie below 2^COMPONENT_BITS in size: then a squared distance of 64 components fits a long.
COMPONENT_BITS = 27
#: Vectors whose distances to all centroids are in memory at a time.
SLICE_ROWS = 4096


def quantised(embedding: Column, width: int = WIDTH, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, x as double; null for vectors that take no part."""
    x = embedding.cast("array<double>")
    bound = F.lit(float(1 << COMPONENT_BITS))
    fits = lambda c: F.coalesce((c * scale >= -bound) & (c * scale < bound), F.lit(False))  # noqa: E731  NaN is above all
    return F.when((F.size(x) == width) & F.forall(x, fits), F.transform(x, lambda c: F.floor(c * scale).cast("int")))


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of ``x`` the nearest centroid (ties: the smaller number) and the squared distance, in whole numbers."""
    cluster, distance = np.empty(len(x), np.int32), np.empty(len(x), np.int64)
    for at in range(0, len(x), SLICE_ROWS):
        part = x[at : at + SLICE_ROWS]
        apart = np.empty((len(part), len(centroids)), np.int64)
        for k, c in enumerate(centroids):
            off = part - c
            np.einsum("ij,ij->i", off, off, out=apart[:, k])
        cluster[at : at + SLICE_ROWS] = own = apart.argmin(axis=1)
        distance[at : at + SLICE_ROWS] = apart[np.arange(len(part)), own]
    return cluster, distance


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _weighted(x: np.ndarray, n: np.ndarray) -> list[int]:
    """Exact sum of rows, each ``n`` times; numbers that a long may not hold are added as Python's."""
    if float(np.abs(x).max(initial=0)) * float(n.sum(dtype=np.float64)) < 2.0**62:
        return (x * n[:, None]).sum(axis=0).tolist()
    return (x.astype(object) * n.astype(object)[:, None]).sum(axis=0).tolist()


def _sums(distinct: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Per cluster that has vectors: how many, and their sum."""
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [[0] * (width + 1) for _ in centroids]
        for b in batches:
            x, n = _matrix(b.column(0), width), b.column(1).to_numpy()
            cluster, _ = nearest(x, centroids)
            for c in np.unique(cluster).tolist():
                mine = cluster == c
                own = [int(n[mine].sum()), *_weighted(x[mine], n[mine])]
                total[c] = [a + b for a, b in zip(total[c], own)]
        found = [(c, d, Decimal(v)) for c, own in enumerate(total) if own[0] for d, v in enumerate(own)]
        columns = list(zip(*found)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, (pa.int32(), pa.int32(), pa.decimal128(38, 0)))], names=["cluster", "place", "total"])

    sums = distinct.select("vector", "n").mapInArrow(releasing(run), "cluster int, place int, total decimal(38,0)").groupBy("cluster", "place").agg(F.sum("total").alias("total"))
    out: dict[int, list[int]] = {}
    for c, place, total in sums.collect():  # clusters * (width + 1) rows at most
        out.setdefault(c, [0] * (width + 1))[place] = int(total)
    return {c: (own[0], own[1:]) for c, own in out.items()}


def _start(rows: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors whose ids hash lowest, in that order; null ids come last, ties go to the smaller vector."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(name.alias("name"), "vector").orderBy(F.asc_nulls_last("name"), "vector").limit(clusters)
    return np.array([r["vector"] for r in first.collect()], np.int64)


def _assigned(distinct: DataFrame, centroids: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cluster, distance = nearest(_matrix(b.column(0), centroids.shape[1]), centroids)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cluster), pa.array(distance)], names=["vector", "n", "cluster", "distance"])

    return distinct.select("vector", "n").mapInArrow(releasing(run), "vector array<int>, n long, cluster int, distance long")


def cluster_vectors(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: int = SEED, id_column: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """Per kept row: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Vectors that are null, of another width, or hold null or non-finite components take no part, nor do those with a
    component of 2^COMPONENT_BITS or more after scaling, whose squared distances no long holds.  Repeated rows and null
    ids each give a row.  Centroids start as the vectors whose ids hash lowest; with fewer kept rows than clusters there
    are as many centroids as rows.  Ties go to the smaller number; an empty cluster keeps its centroid.  An inertia that
    no long holds is null.  An empty table gives no row; other columns are not read.
    """
    base = vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), quantised(F.col(f"`{embedding}`"), width, scale).alias("vector"))
    rows = Written(base.filter("vector is not null"), "vectors").df
    distinct = Written(rows.groupBy("vector").agg(F.count(F.lit(1)).alias("n")), "distinct")
    centroids = _start(rows, clusters, seed)
    if not len(centroids):
        centroids = np.zeros((1, width), np.int64)
    for _ in range(rounds):
        before = centroids.copy()
        for c, (n, total) in _sums(distinct.df, centroids).items():
            centroids[c] = [v // n for v in total]
        if (centroids == before).all():  # every later round would do the same
            break
    assigned = Written(_assigned(distinct.df, centroids), "assigned")
    distinct.drop()
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # one row a cluster, so a broadcast of it has a bound by parameter
    inertia = assigned.df.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)") * F.col("n")).alias("own"), F.sum("n").alias("n")).collect()
    long = lambda v: v if v < 1 << 63 else None
    whole = long(sum(int(r["own"]) for r in inertia))
    facts = [(r["cluster"], long(int(r["own"])), whole, names[r["cluster"]]) for r in inertia]
    about = vectors.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    back = join_classes(rows, assigned, "vector", "n", sum(r["n"] for r in inertia))
    return back.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """Lloyd's rounds as one common table each: x (vec_id, d, x) against c0, c1, ... (k, d, c)."""
    nearest = """
n{r} AS (SELECT vec_id, arg_min(k, (far, k)) AS k, min(far) AS far FROM (SELECT x.vec_id, c.k, sum((x.x - c.c) * (x.x - c.c)) AS far FROM x JOIN c{r} c ON x.d = c.d GROUP BY x.vec_id, c.k) GROUP BY vec_id)"""
    moved = """
m{r} AS (SELECT n.k, x.d, sum(x.x) AS s, count(*) AS n FROM x JOIN n{r} n ON x.vec_id = n.vec_id GROUP BY n.k, x.d),
c{next} AS (SELECT c.k, c.d, CASE WHEN m.n IS NULL THEN c.c ELSE CAST((m.s - ((m.s % m.n) + m.n) % m.n) // m.n AS BIGINT) END AS c FROM c{r} c LEFT JOIN m{r} m ON c.k = m.k AND c.d = m.d)"""
    steps = [nearest.format(r=r) + "," + moved.format(r=r, next=r + 1) for r in range(ROUNDS)] + [nearest.format(r=ROUNDS)]
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda e: CAST(floor({SCALE} * CAST(e AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
),
x AS (SELECT vec_id, unnest(range({WIDTH})) AS d, unnest(v) AS x FROM v),
s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS k FROM v),
c0 AS (SELECT s.k, x.d, x.x AS c FROM s JOIN x ON s.vec_id = x.vec_id WHERE s.k < {CLUSTERS}),{",".join(steps)},
names AS (SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY d)) AS name FROM c{ROUNDS} GROUP BY k)
SELECT n.vec_id, CAST(n.k AS INTEGER) AS cluster, CAST(n.far AS BIGINT) AS distance,
       CAST(sum(n.far) OVER (PARTITION BY n.k) AS BIGINT) AS cluster_inertia, CAST(sum(n.far) OVER () AS BIGINT) AS inertia, names.name AS centroid_sha256
FROM n{ROUNDS} n JOIN names ON names.k = n.k
"""


OP11_SQL = _sql()
