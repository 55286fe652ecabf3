"""Operator 3: exact top-k inner products without random access.

Candidates come in blocks; within a block every dimension is a list sorted by component.  The lists are
read in order, for each query from their better end, step by step and all alike; what is read of a candidate
adds to its score so far.  An entry not yet read is bounded by the last one read (upper) and by the end of its
list (lower).  Candidates whose upper bound falls below the k-th best lower bound are out for that query; those
out for all queries of the block are passed over from then on.  Reading on resolves the rest: once every list
is through, what has been added up is the score.  All queries of a block read together: a step is two products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.llm.common import BROADCAST_LIMIT, Written, partitions, releasing, table

K, SCALE, QUERY_STEP = 5, 256, 50
#: Rows in a candidate block and in a query block.
CANDIDATE_ROWS, QUERY_ROWS = 4096, 512
#: Shares of the lists that are read before each look at the bounds.
DEPTHS = (0.25, 0.5, 0.75, 1.0)


def quantise(embedding: pa.Array, scale: int = SCALE) -> list[np.ndarray | None]:
    """floor(scale * x) of each vector, x as double; none for null, empty or non-finite ones."""
    out: list[np.ndarray | None] = []
    for v in embedding.to_pylist():
        x = None if not v or any(c is None for c in v) else np.array(v, np.float64)
        out.append(np.floor(scale * x) if x is not None and np.isfinite(x).all() else None)
    return out


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """``dim, ids, matrix``: vectors of one width in packed blocks, within their partition, from ``vec_id, embedding``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[int], list[np.ndarray]]] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, x = held.pop(dim)
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([np.array(ids, "<i8").tobytes()]), pa.array([np.stack(x).astype("<f8").tobytes()])], names=["dim", "ids", "matrix"])

        for b in batches:
            for i, x in zip(b.column(0).to_pylist(), quantise(b.column(1))):
                if i is None or x is None:
                    continue
                ids, own = held.setdefault(len(x), ([], []))
                ids.append(i)
                own.append(x)
                if len(ids) == rows:
                    yield block(len(x))
        for dim in list(held):
            yield block(dim)

    return vectors.mapInArrow(releasing(run), "dim int, ids binary, matrix binary")


def _kind(most: float) -> type:
    """The fastest kind of number in which sums of whole numbers up to ``most`` stay exact."""
    return np.float32 if most < 1 << 23 else np.float64 if most < 1 << 52 else object


def block_top(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its best k of a block (more on ties), with exact scores."""
    n = len(ids)
    kind = _kind(float(np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * x.shape[1]) * 2)
    q, x = (np.vectorize(int, otypes=[object])(v) if kind is object else v.astype(kind) for v in (q, x))
    order = np.sort(x, axis=0)
    rank = np.argsort(np.argsort(x, axis=0, kind="stable"), axis=0, kind="stable")
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    live = np.arange(n)  # candidates that some query has not ruled out
    own = q_ids[:, None] == ids[None, :]
    open_, score = ~own, np.zeros((len(q), n), kind)
    done = 0
    for depth in DEPTHS:
        read = n if depth == 1 else int(n * depth)
        r, y = rank[live], x[live]
        step = [np.where(z, y, 0) @ w.T for z, w in (((r >= n - read) & (r < n - done), plus), ((r >= done) & (r < read), minus))]
        score[:, live] += (step[0] + step[1]).T
        done = read
        if read == n or not read or n <= k + 1:
            continue
        high, low = r < n - read, r >= read  # not yet read, of the lists from either end
        upper = score[:, live] + (np.where(high, order[n - read], 0) @ plus.T + np.where(low, order[read - 1], 0) @ minus.T).T
        lower = score[:, live] + (np.where(high, order[0], 0) @ plus.T + np.where(low, order[-1], 0) @ minus.T).T
        for row in range(len(q)):
            at = open_[row, live]
            if at.sum() > k:
                bar = np.sort(lower[row, at])[-k]
                open_[row, live[at & (upper[row] < bar)]] = False
        live = live[open_[:, live].any(axis=0)]
    for row in range(len(q)):
        at = np.flatnonzero(open_[row])
        if len(at):
            best = np.lexsort((ids[at], -score[row, at]))[:k]
            yield int(q_ids[row]), ids[at][best], score[row, at][best]


def _paired(candidates: DataFrame, queries: DataFrame, asked: Written) -> DataFrame:
    """Every candidate block beside every query block of its width.

    Query blocks that are too many to broadcast are dealt to numbered columns and candidate blocks to numbered
    rows of a grid; a cell, with few query blocks and a share of the candidates, is one key of the shuffle.
    """
    if asked.bytes * 4 <= BROADCAST_LIMIT:
        return candidates.join(F.broadcast(queries), "dim")
    columns, rows = asked.df.count(), partitions(candidates.sparkSession)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = queries.withColumn("column", F.pmod(F.xxhash64("q_ids"), F.lit(columns)).cast("int")).withColumn("row", each(rows))
    candidates = candidates.withColumn("row", F.pmod(F.xxhash64("ids"), F.lit(rows)).cast("int")).withColumn("column", each(columns))
    return candidates.join(queries, ["dim", "row", "column"])


def top_k(vectors: DataFrame, is_query, k: int = K, id_column: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query row the k highest inner products of quantised vectors.

    Vectors null, empty, or with null or non-finite components take no part, nor do null ids; vectors of
    another width than the query's are no candidates of it.  Ties go to the smaller id.  Every repeated
    candidate row counts; a query's own id never does, and repeated query rows give one list.  Empty tables
    give no row; other columns are not read.  Scores must fit a long.
    """
    base = vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("embedding"))
    asked = Written(blocks(base.filter(is_query).dropDuplicates(["vec_id"]), QUERY_ROWS).withColumn("block", F.monotonically_increasing_id()), "queries")
    queries = asked.df.select("dim", F.col("ids").alias("q_ids"), F.col("matrix").alias("q"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, ids, x, q_ids, q in zip(*(c.to_pylist() for c in b.columns)):
                found = list(block_top(np.frombuffer(q_ids, "<i8"), np.frombuffer(q).reshape(-1, dim), np.frombuffer(ids, "<i8"), np.frombuffer(x).reshape(-1, dim), k))
                if found:
                    sizes = [len(i) for _, i, _ in found]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat([f[0] for f in found], sizes)), pa.array(np.concatenate([f[1] for f in found])), pa.array([int(s) for f in found for s in f[2]], pa.int64())], names=["query_id", "vec_id", "score"]
                    )

    pairs = _paired(blocks(base, CANDIDATE_ROWS), queries, asked)
    near = pairs.select("dim", "ids", "matrix", "q_ids", "q").mapInArrow(releasing(run), "query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
