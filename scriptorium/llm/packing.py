"""Operator 10: pack documents, in their order, into sequences of at most ``limit`` tokens.

Every partition is packed on its own, in the order its rows come, so nothing is shuffled.  The ids of a
partition form one stream; a cut may fall after a document (free), after a sentence (a small penalty) or,
where neither comes for long, between any two tokens (a larger one).  The best cuts minimise padding plus
penalties:

    best(c) = penalty(c) + limit - c + min over c' in [c - limit, c) of (best(c') + c')

and the minimum over that sliding window comes from a monotone queue, so a transition costs O(1).  A
sequence whose length is a power of two needs no padding; those transitions are looked up one by one.
"""

from __future__ import annotations

import functools
import math
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import bpe
from scriptorium.llm.bpe_codec import TOKENIZER
from scriptorium.llm.common import releasing, table

LIMIT = 2048
SENTENCE_PENALTY, HARD_PENALTY = 6.0, 12.0
#: A hard cut is offered every so many tokens where no other boundary lies.
HARD_STEP = 64
#: Tokens that are planned together; the last, open sequence goes over to the next plan.
PLAN_TOKENS = 1 << 19
#: Closes every document.
END_ID = 1
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def candidates(doc_ends: np.ndarray, sentence_ends: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a cut may fall, and their penalties; no two neighbours are more than HARD_STEP apart."""
    fee = np.full(total + 1, HARD_PENALTY)
    offered = np.zeros(total + 1, bool)
    for ends, cost in ((sentence_ends, SENTENCE_PENALTY), (doc_ends, 0.0)):
        offered[ends] = True
        fee[ends] = cost
    at = np.flatnonzero(offered)
    gaps = np.diff(at, prepend=0)
    for i in np.flatnonzero(gaps > HARD_STEP):
        offered[at[i] - gaps[i] + HARD_STEP : at[i] : HARD_STEP] = True
    at = np.flatnonzero(offered)
    penalty = fee[at]
    return at.astype(np.int64), penalty


def best_cuts(at: np.ndarray, penalty: np.ndarray, limit: int = LIMIT) -> list[int]:
    """The cuts, ascending and ending with the last candidate, of least padding plus penalties."""
    n = len(at)
    number = np.full(int(at[-1]) + 1, -1, np.int32)  # of the candidate at a position; the beginning is 0
    number[0], number[at] = 0, np.arange(1, n + 1)
    exact = []
    size = 1
    while size <= limit:
        exact.append(np.where(at >= size, number[np.maximum(at - size, 0)], -1))
        size *= 2
    whole = np.stack(exact, axis=1)
    special = whole[whole >= 0].tolist()
    until = [0, *np.cumsum((whole >= 0).sum(axis=1)).tolist()]
    place = [0, *at.tolist()]
    fee = [0.0, *penalty.tolist()]
    best, came = [0.0] * (n + 1), [0] * (n + 1)
    keys, nodes, front = [-math.inf, 0.0], [0, 0], 1  # the monotone queue, which begins at front; what lies before ends a search
    for i, here, cost, some, more in zip(range(1, n + 1), place[1:], fee[1:], until, until[1:]):
        while place[nodes[front]] < here - limit:
            keys[front] = -math.inf
            front += 1
        j = nodes[front]
        value = keys[front] + limit - here
        if more > some:
            for k in special[some:more]:
                if best[k] < value:
                    value, j = best[k], k
        value += cost
        best[i], came[i] = value, j
        key = value + here
        while keys[-1] >= key:
            del keys[-1], nodes[-1]
        keys.append(key)
        nodes.append(i)
    cuts, i = [], n
    while i:
        cuts.append(place[i])
        i = came[i]
    return cuts[::-1]


class Packer:
    """Takes documents in order and gives pieces; holds one plan's tokens at most, and a document in hand."""

    def __init__(self, base: int, sentence_end: np.ndarray, limit: int = LIMIT, plan: int = PLAN_TOKENS):
        self.sequence, self.sentence_end, self.limit, self.plan = base, sentence_end, limit, plan
        self.docs: list[tuple[object, int, int, np.ndarray]] = []  # id, tokens of the whole, tokens gone, ids left
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> list[tuple]:
        self.docs.append((doc_id, len(ids), 0, ids))
        self.held += len(ids)
        return self.cut(last=False) if self.held >= self.plan else []

    def cut(self, last: bool) -> list[tuple]:
        if not self.held:
            return []
        ids = np.concatenate([d[3] for d in self.docs])
        ends = np.cumsum([len(d[3]) for d in self.docs])
        cuts = best_cuts(*candidates(ends, np.flatnonzero(self.sentence_end[ids]) + 1, len(ids)), self.limit)
        if not last and len(cuts) > 1:
            cuts.pop()
        out, k, start = [], 0, 0
        raw = ids.astype("<u4")
        for cut in cuts:
            offset = 0
            while start < cut:
                doc_id, total, gone, left = self.docs[k]
                begin = int(ends[k]) - len(left)
                stop = min(cut, int(ends[k]))
                out.append((doc_id, gone + start - begin, stop - start, zlib.crc32(raw[start:stop].tobytes()), total, self.sequence, offset))
                offset += stop - start
                start = stop
                k += start == ends[k]
            self.sequence += 1
        rest = self.docs[k:]
        if rest:
            doc_id, total, gone, left = rest[0]
            used = start - (int(ends[k]) - len(left))
            rest[0] = (doc_id, total, gone + used, left[used:])
        self.docs, self.held = rest, len(ids) - start
        return out


@functools.lru_cache(2)
def _tools(tokenizer: str):
    vocabulary = bpe.load(tokenizer)

    def make(ids: np.ndarray, starts: list[int]) -> list[bytes]:
        raw = ids.astype(np.uint32).tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(starts, starts[1:])]

    pieces = bpe.Memo(vocabulary, make)
    ends = np.zeros(max(vocabulary.token) + 1, bool)
    for i, t in vocabulary.token.items():
        ends[i] = t.endswith((".</w>", "!</w>", "?</w>"))
    return vocabulary, pieces, ends


def _batch_ids(texts: list[str | None], vocabulary: bpe.Vocabulary, pieces: bpe.Memo) -> Iterator[np.ndarray]:
    """Of each text its ids and the closing one; what stands between white space is encoded once for all texts."""
    end = np.array([END_ID], np.uint32)
    plain = [bpe.plain(text or "", vocabulary) for text in texts]
    lines, place, first = bpe.distinct_parts([text for text in plain if text is not None])
    ids, starts = bpe.line_ids(lines, pieces)
    sizes = np.diff(starts)[place]
    ends = np.cumsum(sizes)
    ids = ids[np.repeat(starts[place] - ends + sizes, sizes) + np.arange(sizes.sum())]
    bounds = iter(np.concatenate([[0], ends])[first].tolist())
    begin = next(bounds, 0)
    for text, own in zip(texts, plain):
        if own is not None:
            stop = next(bounds)
            yield np.concatenate([ids[begin:stop], end])
            begin = stop
        else:
            for runs in bpe.gathered([text], vocabulary, [pieces]):
                known = [array("I", [run]).tobytes() if isinstance(run, int) else b"".join(map(pieces.__getitem__, run)) for run in runs]
                yield np.concatenate([np.frombuffer(b"".join(known), np.uint32), end])


def document_ids(texts: Iterable[str | None], tokenizer: str = TOKENIZER) -> Iterator[np.ndarray]:
    """Of each text its ids and the closing one."""
    vocabulary, pieces, _ = _tools(tokenizer)
    held: list[str | None] = []
    size = 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size > bpe.BATCH_CHARS:
            yield from _batch_ids(held, vocabulary, pieces)
            held, size = [], 0
    yield from _batch_ids(held, vocabulary, pieces)


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece of a document.

    Null and empty texts are the closing id alone; null ids and repeated rows are documents of their own;
    an empty table gives no row; other columns are not read.  A sequence never spans partitions, so each
    partition pads one open end at most, and a task that runs again packs the same way.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() << 40, _tools(tokenizer)[2], limit)

        def rows(found: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64()] * 7
            names = [x.split()[0] for x in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), document_ids((t.as_py() for t in batch.column(1)), tokenizer)):
                if found := packer.add(doc_id, ids):
                    yield rows(found)
        if found := packer.cut(last=True):
            yield rows(found)

    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(releasing(run), PIECES)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
