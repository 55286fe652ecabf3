"""Operator 9: exact duplicates by an exchange of Golomb-coded fingerprints.

1. Every partition hashes its texts and writes, per owner (a hash range), its sorted fingerprints; only as
   many bits are sent as the row count calls for, as Golomb-Rice coded gaps.
2. Owners decode what all partitions sent and answer with one bitmap per message: which of its
   fingerprints occur more than once anywhere.
3. Marked rows are suspects.  Only their texts are shuffled, and grouped byte for byte (Spark's hash aggregation compares
   keys by bytes and combines copies before the shuffle, so a huge group sends one row per task), and only
   texts with two rows or more remain as classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import BROADCAST_LIMIT, Written, join_classes, partitions, releasing, table

#: Bits of a fingerprint beyond log2 of the row count; a false suspect has a chance of about 2^-EXTRA_BITS.
EXTRA_BITS = 16
#: Bits of the bitmap that tells suspects apart before texts are shuffled: 32 MB at any corpus size, in pages.
BITMAP_BITS, PAGE_BITS = 28, 12


def golomb_encode(values: np.ndarray, universe_bits: int) -> bytes:
    """Sorted unsigned values below 2^universe_bits as Golomb-Rice coded gaps: header, unary part, remainders."""
    n = len(values)
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    mean = (1 << universe_bits) / max(n, 1)
    k = max(0, min(56, int(np.floor(np.log2(max(mean * 0.6931, 1.0))))))
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.ones(int(ends[-1]) + 1 if n else 0, np.uint8)
    unary[ends] = 0
    low = ((gaps[:, None] >> np.arange(k, dtype=np.uint64)[None, :]) & np.uint64(1)).astype(np.uint8)
    head = np.array([n, k, len(unary)], "<u8").tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(low.reshape(-1)).tobytes()


def golomb_decode(data: bytes) -> np.ndarray:
    n, k, size = (int(x) for x in np.frombuffer(data[:24], "<u8"))
    used = 24 + (size + 7) // 8
    unary = np.unpackbits(np.frombuffer(data[24:used], np.uint8), count=size)
    quotients = np.diff(np.flatnonzero(unary == 0), prepend=-1) - 1
    low = np.unpackbits(np.frombuffer(data[used:], np.uint8), count=n * k).reshape(n, k).astype(np.uint64)
    remainders = (low << np.arange(k, dtype=np.uint64)[None, :]).sum(axis=1, dtype=np.uint64)
    return np.cumsum((quotients.astype(np.uint64) << np.uint64(k)) + remainders, dtype=np.uint64)


def _prints(h: pa.Array, bits: int) -> np.ndarray:
    return h.to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - bits)


def _messages(rows: DataFrame, owners: int, bits: int) -> DataFrame:
    """One row per (partition, owner): distinct sorted fingerprints, which of them the partition holds twice, and their full hashes for the way back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b.column(0) for b in batches]
        h = np.concatenate([p.to_numpy(zero_copy_only=False) for p in parts]).view(np.uint64) if parts else np.empty(0, np.uint64)
        full, n = np.unique(h, return_counts=True)
        prints, first = np.unique(full >> np.uint64(64 - bits), return_index=True)
        twice = np.add.reduceat(n, first) > 1 if len(first) else np.empty(0, bool)
        width = -(-(1 << bits) // owners)
        owner = (prints // np.uint64(width)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(owner)) + 1
        ends = np.append(first[1:], len(full))
        out: list[tuple] = []
        for where in np.split(np.arange(len(prints)), cuts) if len(prints) else ():
            o = int(owner[where[0]])
            base = np.uint64(o * width)
            code = golomb_encode(prints[where] - base, max(1, int(width - 1).bit_length()))
            mine = full[first[where[0]] : ends[where[-1]]]
            sizes = (ends[where] - first[where]).astype("<u4")
            out.append((TaskContext.get().partitionId(), o, code, np.packbits(twice[where]).tobytes(), mine.astype("<u8").tobytes(), sizes.tobytes()))
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        columns = list(zip(*out)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "owner", "code", "twice", "hashes", "sizes"])

    return rows.select("h").mapInArrow(releasing(run), "part int, owner int, code binary, twice binary, hashes binary, sizes binary")


def _bitmaps(messages: DataFrame, owners: int) -> DataFrame:
    """(part, owner, bitmap): bit i is set if fingerprint i of that message occurs more than once in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
        for b in batches:
            for part, owner, code, twice in zip(*(c.to_pylist() for c in b.columns)):
                values = golomb_decode(code)
                sent.setdefault(owner, []).append((part, values, np.unpackbits(np.frombuffer(twice, np.uint8), count=len(values)).astype(bool)))
        out = []
        for owner, got in sent.items():
            values, n = np.unique(np.concatenate([v for _, v, _ in got]), return_counts=True)
            many = np.concatenate([v[t] for _, v, t in got] + [values[n > 1]])
            many = np.unique(many)
            for part, v, _ in got:
                hit = np.isin(v, many)
                if hit.any():
                    out.append((part, owner, np.packbits(hit).tobytes()))
        columns = list(zip(*out)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int32(), pa.int32(), pa.binary()])], names=["part", "owner", "bitmap"])

    sent = messages.select("part", "owner", "code", "twice").repartition(owners, "owner")
    return sent.mapInArrow(releasing(run), "part int, owner int, bitmap binary")


def _suspects(messages: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Distinct full hashes that a bitmap marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for hashes, sizes, bitmap in zip(*(c.to_pylist() for c in b.columns)):
                sizes = np.frombuffer(sizes, "<u4")
                marks = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=len(sizes)).astype(bool)
                found = np.frombuffer(hashes, "<i8")[np.repeat(marks, sizes)]
                yield pa.RecordBatch.from_arrays([pa.array(found)], names=["h"])

    joined = messages.select("part", "owner", "hashes", "sizes").join(bitmaps, ["part", "owner"])
    return joined.select("hashes", "sizes", "bitmap").mapInArrow(releasing(run), "h long").distinct()


def suspicious(rows: DataFrame, suspects: Written) -> DataFrame:
    """The rows whose ``h`` is among the suspects; no other row leaves its task, however many suspects there are.

    Beyond what may be broadcast whole, all tasks get a bitmap of fixed size over the hashes' first bits, which
    lets every suspect pass and few others; what passes meets the suspects by a shuffle.
    """
    if suspects.bytes * 4 <= BROADCAST_LIMIT:
        return rows.join(F.broadcast(suspects.df), "h", "left_semi")
    page_bits = 1 << BITMAP_BITS - PAGE_BITS
    page = F.shiftrightunsigned("h", 64 - PAGE_BITS)

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            at = b.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - BITMAP_BITS)
            for p in np.unique(at // np.uint64(page_bits)).tolist():
                bits = held.setdefault(p, np.zeros(page_bits, bool))
                bits[(at[at // np.uint64(page_bits) == p] % np.uint64(page_bits)).astype(np.int64)] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([np.packbits(x).tobytes() for x in held.values()], pa.binary())], names=["page", "marks"])

    marks = np.zeros(1 << BITMAP_BITS - 3, np.uint8)
    dealt = suspects.df.repartition(partitions(rows.sparkSession), page).select("h")
    for part in dealt.mapInArrow(releasing(pages), "page int, marks binary").toLocalIterator():  # 2^PAGE_BITS rows at most
        marks[part["page"] * (page_bits >> 3) :][: page_bits >> 3] = np.frombuffer(part["marks"], np.uint8)
    shared = rows.sparkSession.sparkContext.broadcast(marks)

    @F.pandas_udf("boolean")
    def marked(h: pd.Series) -> pd.Series:
        at = h.to_numpy().view(np.uint64) >> np.uint64(64 - BITMAP_BITS)
        return pd.Series((shared.value[(at >> np.uint64(3)).astype(np.int64)] << (at & np.uint64(7)).astype(np.uint8) & 128).astype(bool))

    return rows.filter(marked("h")).join(suspects.df, "h", "left_semi")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Null texts equal the empty text.  Of equal texts the row with the largest id stays; a null id counts as
    smaller than any number, and repeated rows with one id all carry ``kept`` when that id stays.  Empty
    tables give no row; other columns are not read.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    base = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), body.alias("body"))
    hashed = Written(base.select("doc_id", F.xxhash64("body").alias("h"), F.unhex(F.sha2("body", 256)).alias("sha")), "hashed")
    n = hashed.df.count()
    bits = min(64, max(1, n).bit_length() + EXTRA_BITS)
    owners = min(partitions(spark), 1 << 16)
    messages = Written(_messages(hashed.df, owners, bits), "messages")
    suspects = Written(_suspects(messages.df, _bitmaps(messages.df, owners)), "suspects")
    checked = suspicious(base.withColumn("h", F.xxhash64("body")), suspects)
    same = checked.groupBy("body").agg(F.max("doc_id").alias("keep"), F.count(F.lit(1)).alias("n"))
    classes = Written(same.filter("n > 1").select(F.unhex(F.sha2("body", 256)).alias("sha"), "keep", "n"), "classes")
    messages.drop()
    suspects.drop()
    out = join_classes(hashed.df, classes, "sha", "n", n)
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep"))
    return out.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP9_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
