"""Operator 7: remove byte strings of ``THRESHOLD`` bytes that also start earlier in the corpus.

A depth-limited radix sort would order every suffix through THRESHOLD bytes; equal groups are the repeated
windows.  Ordering all suffixes of all texts means shuffling every position, so positions are first thinned
without losing a window: winnowing over GRAM-byte grams selects at least one anchor in every window, and
the same one in equal windows.  Only suffixes at anchors whose gram repeats go on.

1. Anchors.  A partition sends, per owner of the gram's hash, hash, digest of the context (all windows
   around the anchor; 128 bits, by its length) and place.  Of equal contexts in a partition only the first is sent.
2. Owners.  Of equal contexts anywhere all but the first are removed whole: contexts count as equal if both
   digests, of gram and context, and the lengths on both sides are.  Where one gram stands in
   different contexts, the first of each context is left to be ordered.
3. Texts meet those places and send the context bytes to the gram's owner.
4. Owners order the suffixes from each anchor, and the reversed prefixes before it, by passes over one byte
   (a radix digit) at a time, most significant first and THRESHOLD bytes deep at most.  Windows with equal
   groups on both sides are equal; all but the first are removed.
5. Texts meet what is removed.  Bytes travel in packed rows; each text is shuffled twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriptorium.llm.common import Written, partitions, releasing, table, text_bytes

THRESHOLD, GRAM = 100, 32
WINDOW = THRESHOLD - GRAM + 1
LEFT = WINDOW - 1
SLICE = 1 << 20
#: Anchors a task holds before it sends them, and bytes of text whose anchors an owner or bucket holds at a time.
HELD_ANCHORS, OWNED_BYTES = 1 << 19, 32 << 20
FIRST_ID = -(1 << 63)

_DOC = np.dtype([("id", "<i8"), ("th", "<i8"), ("bucket", "<i4")])
_ANCHOR = np.dtype([("h", "V6"), ("c", "<u8"), ("e", "<u8"), ("doc", "<u4"), ("pos", "<u4")])
_PLACE = np.dtype([("id", "<i8"), ("th", "<i8"), ("pos", "<u4"), ("h", "<u8")])
_RANGE = np.dtype([("id", "<i8"), ("th", "<i8"), ("start", "<u4"), ("stop", "<u4")])
_CONTEXT = np.dtype([("h", "<u8"), ("id", "<i8"), ("th", "<i8"), ("bucket", "<i4"), ("pos", "<u4"), ("left", "u1"), ("right", "u1"), ("bytes", "u1", LEFT + THRESHOLD)])
#: Kinds of packed rows: anchors for an owner; removed places, places to order, removed ranges for a bucket; a text.
_ANCHORS, _REMOVED, _ORDER, _RANGES, _TEXT = range(5)
_PACKED = "kind int, at int, data binary, docs binary"


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position, by doubling."""
    h = (b.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    n = 1
    while n < GRAM:
        h = h[: len(h) - n] * np.uint64(0xD6E8FEB86659FD93) + h[n:]
        h ^= h >> np.uint64(31)
        n *= 2
    return h


def _slide(x: np.ndarray, width: int, take) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        x = take(x[: len(x) - n], x[n:])
        n *= 2
    return take(x[: len(x) - (width - n)], x[width - n :]) if width > n else x


def anchors(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of grams that are smallest in some window of THRESHOLD bytes, and their hashes."""
    where, what = [], []
    for at in range(0, max(0, len(b) - THRESHOLD + 1), SLICE):
        h = gram_hashes(b[at : at + SLICE + THRESHOLD - 1])
        small = (h >> np.uint64(32)).astype(np.uint32)
        least = _slide(small, WINDOW, np.minimum)
        edge = np.zeros(WINDOW - 1, np.uint32)
        chosen = np.flatnonzero(_slide(np.concatenate([edge, least, edge]), WINDOW, np.maximum) == small)
        where.append(chosen + at)
        what.append(h[chosen])
    if not where:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    pos, first = np.unique(np.concatenate(where), return_index=True)
    return pos, np.concatenate(what)[first]


def _ranked(*keys: np.ndarray) -> np.ndarray:
    """Dense group numbers of equal key rows, in sorted order of the keys; rows must be sorted by them."""
    new = np.zeros(len(keys[0]), bool)
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new)


def _after_first(group: np.ndarray, ids: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Rows whose (id, pos) is beyond that of their group's first row; rows sorted by group, id, pos."""
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.empty(0, np.int64)
    lead = np.repeat(first, np.diff(np.append(first, len(group))))
    return (ids != ids[lead]) | (pos != pos[lead])


def _rows(found: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found) if found else [()] * 4, kinds)], names=["kind", "at", "data", "docs"])


def _split(kind: int, at: np.ndarray, data: np.ndarray) -> list[tuple]:
    """Packed rows of ``data``, one per value of ``at``."""
    order = np.argsort(at, kind="stable")
    at, data = at[order], data[order]
    cuts = np.flatnonzero(np.diff(at)) + 1
    return [(kind, int(at[s[0]]), data[s].tobytes(), None) for s in np.split(np.arange(len(at)), cuts)] if len(at) else []


def _find_anchors(docs: DataFrame, owners: int) -> DataFrame:
    def flush(held: list[tuple], keys: list[tuple]) -> list[tuple]:
        docs = np.array(keys, _DOC)
        which = np.repeat(np.arange(len(keys), dtype=np.uint32), [len(x[0]) for x in held])
        pos, h, c, e = (np.concatenate([x[k] for x in held]) for k in range(4))
        order = np.lexsort((pos, docs["id"][which], e, c, h))
        pos, h, c, e, which = pos[order], h[order], c[order], e[order], which[order]
        group = _ranked(h, c, e)
        again = _after_first(group, docs["id"][which], pos)
        gone = np.zeros(int(again.sum()), _RANGE)
        own = docs[which[again]]
        gone["id"], gone["th"] = own["id"], own["th"]
        gone["start"] = np.maximum(pos[again], LEFT) - LEFT
        gone["stop"] = pos[again] + THRESHOLD
        out = _split(_RANGES, own["bucket"], gone)
        sent = np.zeros(int((~again).sum()), _ANCHOR)
        sent["h"] = (h[~again] & np.uint64((1 << 48) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].copy().view("V6")[:, 0]
        sent["c"], sent["e"], sent["doc"], sent["pos"] = c[~again], e[~again], which[~again], pos[~again]
        owner = (h[~again] & np.uint64((1 << 48) - 1)) % np.uint64(owners)
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(owners + 1))
        for o in range(owners):
            part = sent[order[cuts[o] : cuts[o + 1]]]
            if len(part):
                used, at = np.unique(part["doc"], return_inverse=True)
                part["doc"] = at
                out.append((_ANCHORS, o, part.tobytes(), docs[used].tobytes()))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        keys: list[tuple] = []
        size = 0
        for batch in batches:
            for i, th, bucket, text in zip(*(x.to_pylist() for x in batch.columns)):
                pos, h = anchors(np.frombuffer(text, np.uint8))
                if not len(pos):
                    continue
                n, digest = len(text), xxhash.xxh3_128_digest
                both = b"".join([digest(text[max(0, p - LEFT) : p + THRESHOLD], min(p, LEFT) << 8 | min(n - p, THRESHOLD)) for p in pos.tolist()])
                c, e = np.frombuffer(both, "<u8").reshape(-1, 2).T
                held.append((pos, h, c, e))
                keys.append((i, th, bucket))
                size += len(pos)
                if size > HELD_ANCHORS:
                    yield _rows(flush(held, keys))
                    held, keys, size = [], [], 0
        if held:
            yield _rows(flush(held, keys))

    return docs.select("id", "th", "bucket", "text").mapInArrow(releasing(run), _PACKED)


def _meet_anchors(found: DataFrame, n: int) -> DataFrame:
    def decide(data: list[np.ndarray], keys: list[np.ndarray]) -> list[tuple]:
        a = np.concatenate(data)
        h = np.zeros((len(a), 8), np.uint8)
        h[:, :6] = a["h"].copy().view(np.uint8).reshape(-1, 6)
        h = h.view("<u8")[:, 0]
        doc = np.concatenate([k[d["doc"]] for k, d in zip(keys, data)])
        order = np.argsort(h, kind="stable")
        group = _ranked(h[order])
        order = order[np.bincount(group)[group] > 1]
        h, c, e, pos, doc = h[order], a["c"][order], a["e"][order], a["pos"][order], doc[order]
        order = np.lexsort((pos, doc["id"], e, c, h))
        h, c, e, pos, doc = h[order], c[order], e[order], pos[order], doc[order]
        if not len(h):
            return []
        group = _ranked(h, c, e)
        again = _after_first(group, doc["id"], pos)
        out = []
        own = doc[again]
        gone = np.zeros(len(own), _RANGE)
        gone["id"], gone["th"] = own["id"], own["th"]
        gone["start"], gone["stop"] = np.maximum(pos[again], LEFT) - LEFT, pos[again] + THRESHOLD
        out += _split(_RANGES, own["bucket"], gone)
        gram = _ranked(h)
        contexts = np.bincount(gram, np.concatenate([[1], (group[1:] != group[:-1])]))
        left = (contexts[gram] > 1) & ~again
        own = doc[left]
        place = np.zeros(len(own), _PLACE)
        place["id"], place["th"], place["pos"], place["h"] = own["id"], own["th"], pos[left], h[left]
        return out + _split(_ORDER, own["bucket"], place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, data, keys = None, [], []
        for batch in batches:
            out = []
            for kind, at, blob, docs in zip(*(x.to_pylist() for x in batch.columns)):
                if kind == _RANGES:
                    out.append((kind, at, blob, None))
                    continue
                if at != now:
                    if data:
                        out += decide(data, keys)
                    now, data, keys = at, [], []
                data.append(np.frombuffer(blob, _ANCHOR))
                keys.append(np.frombuffer(docs, _DOC))
            if out:
                yield _rows(out)
        if data and (out := decide(data, keys)):
            yield _rows(out)

    return found.repartition(n, "at").sortWithinPartitions("kind", "at").mapInArrow(releasing(run), _PACKED)


class _Meeting:
    """Packed rows of a bucket, then its texts: gives each text the rows that are its own."""

    def __init__(self, kind: np.dtype):
        self.kind, self.parts, self.sorted = kind, [], None

    def take(self, blob: bytes) -> None:
        self.parts.append(np.frombuffer(blob, self.kind))

    def of(self, doc_id: int, th: int) -> np.ndarray:
        if self.sorted is None:
            rows = np.concatenate(self.parts) if self.parts else np.empty(0, self.kind)
            order = np.lexsort((rows["th"], rows["id"]))
            self.sorted, self.ids = rows[order], rows["id"][order]
            self.parts = []
        lo, hi = np.searchsorted(self.ids, doc_id), np.searchsorted(self.ids, doc_id, "right")
        own = self.sorted[lo:hi]
        return own if not len(own) or (own["th"] == th).all() else own[own["th"] == th]


def _with_texts(packed: DataFrame, docs: DataFrame, n: int, more: list[str] = ()) -> DataFrame:
    """Packed rows and texts of a bucket in one partition, packed rows first."""
    nothing = [F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in ("id", "th", "text", *more)]
    left = packed.select("kind", F.col("at").alias("bucket"), "data", *nothing)
    right = docs.select(F.lit(_TEXT).alias("kind"), "bucket", F.lit(None).cast("binary").alias("data"), "id", "th", "text", *more)
    return left.union(right).repartition(n, "bucket").sortWithinPartitions("bucket", "kind")


def _send_contexts(places: DataFrame, docs: DataFrame, owners: int, n: int) -> DataFrame:
    def cut(doc_id: int, th: int, bucket: int, text: bytes, own: np.ndarray) -> np.ndarray:
        b, pos = np.frombuffer(text, np.uint8), own["pos"].astype(np.int64)
        out = np.zeros(len(own), _CONTEXT)
        out["h"], out["id"], out["th"], out["bucket"], out["pos"] = own["h"], doc_id, th, bucket, pos
        out["left"], out["right"] = np.minimum(pos, LEFT), np.minimum(len(b) - pos, THRESHOLD)
        at = pos[:, None] + np.arange(-LEFT, THRESHOLD)[None, :]
        out["bytes"] = np.where((at >= 0) & (at < len(b)), b[np.clip(at, 0, len(b) - 1)], 0)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, meeting, held, size = None, _Meeting(_PLACE), [], 0
        for batch in batches:
            out = []
            for kind, bucket, data, doc_id, th, text in zip(*(x.to_pylist() for x in batch.columns)):
                if bucket != now:
                    now, meeting = bucket, _Meeting(_PLACE)
                if kind != _TEXT:
                    meeting.take(data)
                elif len(own := meeting.of(doc_id, th)):
                    held.append(cut(doc_id, th, bucket, text, own))
                    size += len(own)
                if size > 100_000:
                    a = np.concatenate(held)
                    out += _split(_ORDER, (a["h"] % np.uint64(owners)).astype(np.int64), a)
                    held, size = [], 0
            if out:
                yield _rows(out)
        if held:
            a = np.concatenate(held)
            yield _rows(_split(_ORDER, (a["h"] % np.uint64(owners)).astype(np.int64), a))

    return _with_texts(places.filter(F.col("kind") == _ORDER), docs, n).mapInArrow(releasing(run), _PACKED)


def repeated_windows(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of contexts: the rows with windows that occur in an earlier row of the same gram, and the smallest and
    largest distance of such a window's start before the anchor."""
    a = a[np.lexsort((a["pos"], a["id"]))]
    bytes_, n = a["bytes"], len(a)

    def refine(group: np.ndarray, digit: np.ndarray) -> np.ndarray:
        return np.unique(group * 256 + digit, return_inverse=True)[1]

    group = np.unique(a["h"], return_inverse=True)[1]
    for k in range(GRAM):  # equal hashes are not equal grams
        digit = bytes_[:, LEFT + k]
        if (digit[1:] != digit[:-1]).any():
            group = refine(group, digit)
    keep = np.bincount(group)[group] > 1
    a, group = a[keep], group[keep]
    bytes_, n = a["bytes"], len(a)
    if not n:
        return a, np.empty(0, np.int64), np.empty(0, np.int64)
    ahead = [group]
    for k in range(GRAM, THRESHOLD):  # suffixes from the anchor, deeper by one digit each
        ahead.append(refine(ahead[-1], bytes_[:, LEFT + k]))
    back = np.zeros(n, np.int64)
    least, most = np.full(n, LEFT + 1), np.full(n, -1)
    ids, pos = a["id"], a["pos"]
    for d in range(LEFT + 1):  # reversed prefixes before the anchor
        if d:
            back = refine(back, bytes_[:, LEFT - d])
        whole = np.flatnonzero((a["left"] >= d) & (a["right"] >= THRESHOLD - d))
        key = back[whole] * (n + 1) + ahead[THRESHOLD - d - GRAM][whole]
        _, first, at = np.unique(key, return_index=True, return_inverse=True)
        lead = whole[first[at]]
        later = whole[(ids[whole] != ids[lead]) | (pos[whole] != pos[lead])]
        least[later] = np.minimum(least[later], d)
        most[later] = d
    hit = np.flatnonzero(most >= 0)
    return a[hit], least[hit], most[hit]


def _order(contexts: DataFrame, n: int) -> DataFrame:
    def decide(parts: list[np.ndarray]) -> list[tuple]:
        a, least, most = repeated_windows(np.concatenate(parts))
        gone = np.zeros(len(a), _RANGE)
        gone["id"], gone["th"] = a["id"], a["th"]
        gone["start"], gone["stop"] = a["pos"] - most, a["pos"] - least + THRESHOLD
        return _split(_RANGES, a["bucket"], gone)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            out = []
            for at, data in zip(*(x.to_pylist() for x in batch.columns)):
                if at != now:
                    if parts:
                        out += decide(parts)
                    now, parts = at, []
                parts.append(np.frombuffer(data, _CONTEXT))
            if out:
                yield _rows(out)
        if parts and (out := decide(parts)):
            yield _rows(out)

    return contexts.select("at", "data").repartition(n, "at").sortWithinPartitions("at").mapInArrow(releasing(run), _PACKED)


def spans(own: np.ndarray, n: int) -> np.ndarray:
    """Maximal runs of the union of ranges, clipped to n bytes, as rows (start, stop)."""
    if not len(own):
        return np.empty((0, 2), np.int64)
    start = own["start"].astype(np.int64)
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(np.minimum(own["stop"].astype(np.int64), n)[order])
    new = np.concatenate([[True], start[1:] > stop[:-1]])
    first = np.flatnonzero(new)
    return np.stack([start[first], stop[np.append(first[1:], len(start)) - 1]], axis=1)


def _places(docs: DataFrame, owners: int) -> DataFrame:
    """Adds what is removed: ``docs`` has ``row`` (anything), ``id, th, bucket, text``; gives ``row, spans, text``."""
    spark = docs.sparkSession
    n = partitions(spark)
    narrow = docs.select("id", "th", "bucket", "text")
    met = Written(_meet_anchors(_find_anchors(narrow, owners), n), "anchors")
    ordered = Written(_order(_send_contexts(met.df, narrow, owners, n), n), "ordered")
    ranges = met.df.filter(F.col("kind") == _RANGES).union(ordered.df)
    return _with_texts(ranges, docs, n, ["row"])


def _owners(docs: DataFrame, text: str) -> int:
    """Owners of grams, and buckets of texts; a task goes through several, one after the other, where there are more than tasks."""
    return max(partitions(docs.sparkSession), -(-text_bytes(docs, text) // OWNED_BYTES))


def _prepared(docs: DataFrame, row, id_column: str, text: str, owners: int) -> DataFrame:
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")
    base = docs.select(row.alias("row"), F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(FIRST_ID)).alias("id"), body.alias("text"))
    base = base.withColumn("th", F.xxhash64("text"))
    return base.withColumn("bucket", F.pmod(F.xxhash64("id", "th"), F.lit(owners)).cast("int"))


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[tuple]]]:
    """Per batch the ``row`` column of its texts, and (text, spans) of each."""
    now, meeting = None, _Meeting(_RANGE)
    for batch in batches:
        found, at = [], []
        for i, (kind, bucket, data, doc_id, th, text) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(6)))):
            if bucket != now:
                now, meeting = bucket, _Meeting(_RANGE)
            if kind != _TEXT:
                meeting.take(data)
            else:
                found.append((text, spans(meeting.of(doc_id, th), len(text))))
                at.append(i)
        if found:
            yield batch.column(6).take(pa.array(at)), found


def kept_bytes(text: bytes, removed: np.ndarray) -> bytes:
    ends = [0, *removed[:, 1].tolist()]
    starts = [*removed[:, 0].tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(ends, starts))


def repeated_bytes(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans``.

    Null texts count as empty.  A null id comes before every number.  Rows of one id are one document as to
    order: a string is removed if it also starts at a smaller (id, position), so equal rows of one id are
    treated alike.  Texts below the threshold lose nothing; empty tables give no row; other columns are not
    read.
    """
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,stop:long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in _each(batches):
            sha = [hashlib.sha256(kept_bytes(t, s)).hexdigest() for t, s in found]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            places = pa.array([[{"start": int(a), "stop": int(b)} for a, b in s] for _, s in found], kind)
            numbers = [pa.array(x, pa.int64()) for x in zip(*((len(t), int((s[:, 1] - s[:, 0]).sum()), len(s)) for t, s in found))]
            yield pa.RecordBatch.from_arrays([ids, *numbers, pa.array(sha), places], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    owners = _owners(docs, text)
    return _places(_prepared(docs, F.col(f"`{id_column}`").cast("long"), id_column, text, owners), owners).mapInArrow(releasing(run), schema)


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with removed bytes cut out of the text; all columns stay.

    A cut inside a multi-byte character drops the rest of that character.  Null texts stay null.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    row = F.struct(F.struct(*others).alias("others"), F.col(f"`{text}`").isNull().alias("none"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, found in _each(batches):
            texts = [kept_bytes(t, s).decode("utf-8", "ignore") for t, s in found]
            yield pa.RecordBatch.from_arrays([rows, pa.array(texts, pa.string())], names=["row", "text"])

    owners = _owners(docs, text)
    prepared = _prepared(docs, row, id_column, text, owners)
    out = _places(prepared, owners).mapInArrow(releasing(run), T.StructType([prepared.schema["row"], T.StructField("text", T.StringType())]))
    kept = F.when(~F.col("row.none"), F.col("text"))
    return out.select(*[kept.alias(c) if c == text else F.col(f"row.others.`{c}`").alias(c) for c in docs.columns])


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents"))
