"""Operator 8: near duplicates by SimHash, joined over byte positions.

A fingerprint has eight positional bytes.  Two that differ in at most two bits share at least six of them,
so that is the count filter's guaranteed minimum.  Postings of single bytes are only 2048 lists and tallies
over them grow with the square of the corpus; the index therefore keys its postings by the guaranteed
minimum itself, the 28 choices of six positions.  Texts that meet in a posting have the minimum number of
matches by construction (the tally is checked again), and the differing bits are verified.  Two bytes
are free in a posting, so it holds 65,536 distinct fingerprints at most, whatever the corpus; of the links
found in one, those of a spanning forest are kept.  Equal fingerprints are one entry of the index.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import Written, join_classes, partitions, releasing, table

SHINGLE_WORDS, MOST_BITS, SEED = 3, 2, 42
BLOCK_BYTES = 1 << 20
#: Postings: the two byte positions left out of each.
LEFT_OUT = list(itertools.combinations(range(8), 2))
LEAST_MATCHES = 6


def _word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """Words in blocks of bounded size."""
    at = 0
    while len(text) - at > BLOCK_BYTES:
        end = at + BLOCK_BYTES
        while end < len(text) and text[end] not in b" \t\n\v\f\r":
            end += 1
        yield text[at:end].split()
        at = end
    yield text[at:].split()


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """Unsigned SimHash over all shingles, repeats included; 0 for a text without words."""
    ones, n = np.zeros(64, np.int64), 0
    digest = xxhash.xxh64_intdigest
    words: list[bytes] = []
    for block in _word_blocks((text or "").encode().lower()):
        words = words[len(words) - width + 1 :] if len(words) >= width else words
        words += block
        if len(words) < width:
            continue
        line = b" ".join(words)
        gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        starts = [0, *(gaps[: len(words) - width] + 1).tolist()]
        ends = [*gaps[width - 1 :].tolist(), len(line)]
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends)], np.uint64)
        for part in range(0, len(hashes), 1 << 15):
            bits = np.unpackbits(hashes[part : part + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int32)
        n += len(hashes)
    if not n and words:
        ones = np.array([digest(b" ".join(words), SEED) >> k & 1 for k in range(64)], np.int64)
        n = 1
    return int(sum(1 << k for k in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS, carried: Sequence[str] = ()) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) and binary columns ``carried``, from columns ``doc_id, text`` and those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = np.array([fingerprint(t.as_py(), width) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints.view(np.int64)), *b.columns[2:]], names=["doc_id", "fp", *carried])

    return docs.select("doc_id", "text", *carried).mapInArrow(releasing(run), ", ".join(["doc_id long, fp long", *(f"{c} binary" for c in carried)]))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _mask(i: int, j: int) -> int:
    return ((1 << 64) - 1) & ~(255 << 8 * i) & ~(255 << 8 * j)


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """How many positional bytes two fingerprints share, from their exclusive or."""
    return (x[..., None].view(np.uint8).reshape(*x.shape, 8) == 0).sum(axis=-1)


def posting_links(v: np.ndarray, most_bits: int, free: tuple[int, int]) -> np.ndarray:
    """Links of a spanning forest among the distinct fingerprints of one posting, as rows (smaller, larger)."""
    n = len(v)
    if n <= 256:
        x = v[:, None] ^ v[None, :]
        near = (shared_bytes(x) >= LEAST_MATCHES) & (np.bitwise_count(x) <= most_bits)
        label = np.arange(n)
        while True:
            new = np.where(near, label[None, :], n).min(axis=1)
            if (new == label).all():
                break
            label = new
    else:
        i, j = free
        code = (((v >> np.uint64(8 * i)) & np.uint64(255)) << np.uint64(8) | ((v >> np.uint64(8 * j)) & np.uint64(255))).astype(np.int64)
        masks = [sum(1 << b for b in bits) for k in range(1, most_bits + 1) for bits in itertools.combinations(range(16), k)]
        at = np.full(1 << 16, n, np.int64)
        at[code] = label = np.arange(n)
        while True:
            new = label.copy()
            for m in masks:
                np.minimum(new, at[code ^ m], out=new)
            if (new == label).all():
                break
            at[code] = label = new
    other = np.flatnonzero(label != np.arange(n))
    return np.stack([v[label[other]], v[other]], axis=1)


def links(prints: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """``a, b``: links that connect all fingerprints within ``most_bits`` of each other, from distinct ``fp``."""
    if not 0 < most_bits <= 2:
        raise ValueError("six shared bytes are guaranteed for one or two differing bits")
    masks = F.array(*[F.lit(_signed(_mask(i, j))) for i, j in LEFT_OUT])
    spread = prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(len(LEFT_OUT) - 1))).alias("posting"))
    key = F.col("fp").bitwiseAND(F.element_at(masks, F.col("posting") + 1))
    dealt = spread.repartition(partitions(prints.sparkSession), "posting", key).sortWithinPartitions("posting", key)
    mask_of = np.array([_mask(i, j) for i, j in LEFT_OUT], np.uint64)

    def found(posting: np.ndarray, v: np.ndarray) -> list[np.ndarray]:
        same = (posting[1:] == posting[:-1]) & (v[1:] & mask_of[posting[1:]] == v[:-1] & mask_of[posting[1:]])
        starts = np.flatnonzero(~np.concatenate([[False], same]))
        sizes = np.diff(np.append(starts, len(v)))
        two = starts[sizes == 2]
        x = v[two] ^ v[two + 1]
        two = two[(shared_bytes(x) >= LEAST_MATCHES) & (np.bitwise_count(x) <= most_bits)]
        out = [np.stack([v[two], v[two + 1]], axis=1)]
        for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
            out.append(posting_links(np.unique(v[s : s + n]), most_bits, LEFT_OUT[posting[s]]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, v = np.empty(0, np.int64), np.empty(0, np.uint64)

        def rows(parts: list[np.ndarray]) -> pa.RecordBatch:
            both = np.concatenate(parts).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

        for b in batches:
            v = np.concatenate([v, b.column(0).to_numpy().view(np.uint64)])
            p = np.concatenate([p, b.column(1).to_numpy().astype(np.int64)])
            if not len(v):
                continue
            last = (p == p[-1]) & (v & mask_of[p] == v[-1] & mask_of[p[-1]])
            cut = len(v) - int(np.argmin(last[::-1])) if not last.all() else 0  # the last posting may go on
            if cut:
                yield rows(found(p[:cut], v[:cut]))
            p, v = p[cut:], v[cut:]
        if len(v):
            yield rows(found(p, v))

    return dealt.mapInArrow(releasing(run), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``: its component's smallest node, by alternating stars.

    Each round links the larger neighbours of a node to its smallest (large star), then the smaller ones
    (small star), until nothing changes; rounds grow with the logarithm of the size.  Every round is
    written, so a lost executor repeats one round at most.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    table_now = Written(pairs, "stars")
    mark = None
    while True:
        now = table_now.df
        new = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == mark:
            break
        mark = new
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = Written(large, "large")
        least = large.df.groupBy("u").agg(F.min("v").alias("m"))
        small = large.df.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        before, table_now = table_now, Written(small.filter("u <> v").distinct(), "stars")
        before.drop()
        large.drop()
    stars = table_now.df
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def members(base: DataFrame, width: int = SHINGLE_WORDS, most_bits: int = MOST_BITS, carried: Sequence[str] = ()) -> DataFrame:
    """``doc_id, fp, carried, root, component`` of every row of ``base (doc_id, text, carried)``.

    ``root`` is one fingerprint per component, null for a row that is alone; ``component`` is its smallest id.
    """
    rows = Written(fingerprints(base, width, carried), "prints")
    prints = Written(rows.df.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "index")
    edges = Written(links(prints.df.select("fp"), most_bits), "links")
    stars = Written(components(edges.df), "components")
    ids = stars.df.join(prints.df, stars.df["node"] == prints.df["fp"]).select("node", "root", "least")
    roots = ids.groupBy("root").agg(F.min("least").alias("component"))
    linked = ids.join(roots, "root").select(F.col("node").alias("fp"), "root", "component")
    linked = linked.join(prints.df.select("fp", "n"), "fp")
    alone = prints.df.filter("n > 1").join(stars.df.select(F.col("node").alias("fp")), "fp", "left_anti").select("fp", F.col("fp").alias("root"), F.col("least").alias("component"), "n")
    classes = Written(linked.union(alone), "classes")
    return join_classes(rows.df, classes, "fp", "n", rows.df.count()).drop("n")


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, most_bits: int = MOST_BITS, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable).

    Null and wordless texts have fingerprint zero and link like any other.  A null id takes part but is no
    component's smallest unless all its ids are null; repeated rows give a row each; empty tables give
    none; other columns are not read.
    """
    base = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    out = members(base, width, most_bits)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.coalesce("component", "doc_id").alias("component_id"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
