"""Operator 6: language-model scoring by prediction by partial matching, with a unigram base score.

Training pass (one shuffle): byte grams of the context tree and word counts of the training texts.
Scoring pass: texts are scored in chunks of a partition's documents.  Neither all contexts nor all word counts
are sent to the executors: only contexts and words that make up at least 1/FREQUENT_SHARE of all bytes or tokens
are (at most that many), which also takes every hot one out of the exchange.  All other words go, packed, to the
owner of their hash, meet their counts there and return as partial sums to their chunk; so do the bytes in all
other contexts, as grams, to the owner of the context's last two bytes, who holds every gram that ends in these.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import ppm
from scriptorium.llm.common import Written, partitions, releasing, table, text_bytes

#: Words and contexts rarer than one in so many tokens or bytes are not sent to all executors.
FREQUENT_SHARE = 1 << 16
#: Distinct grams of documents that a scoring chunk has at most, but for its last batch.
HELD_GRAMS = 1 << 18
#: Bytes of text that a task takes out of an Arrow batch at a time.
TAKEN_BYTES = 1 << 21
#: Distinct words a task holds before it hands their counts on, and documents a scoring chunk has at most.
HELD_WORDS, CHUNK_DOCS = 100_000, 4096
#: Bytes of text to an owner of words and grams; a task goes through its owners one after the other.
OWNED_BYTES = 32 << 20
SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_WORD, _GRAM, _DOCS = 0, 1, 2


def _is_held_out(doc_id: int | None, parts: int = 5) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % parts == 1


def _texts(column: pa.Array) -> list[bytes]:
    return [b.lower() for b in column.fill_null(b"").to_pylist()]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """Ids and lower-cased texts, of bounded size but for a single text."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // TAKEN_BYTES)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, b.num_rows]):
            yield b.column(0).slice(lo, hi - lo).to_pylist(), _texts(b.column(1).slice(lo, hi - lo))


def _train(docs: DataFrame) -> DataFrame:
    """``kind, item, n``: counts of words, of byte grams and of documents, over the training rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[bytes] = Counter()
        grams: list = []
        n_docs = 0

        def rows(kind: int, items: list[bytes], n: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([kind] * len(items), pa.int32()), pa.array(items, pa.binary()), pa.array(n, pa.int64())], names=["kind", "item", "n"])

        for ids, texts in _slices(batches):
            texts = [t for d, t in zip(ids, texts) if not _is_held_out(d)]
            n_docs += len(texts)
            for t in texts:
                words.update(t.split())
                if len(words) > HELD_WORDS:
                    yield rows(_WORD, list(words), list(words.values()))
                    words.clear()
            grams.append(ppm.gram_counts(texts))
            if len(grams) > 8:
                grams = [ppm.merge_counts(grams)]
        yield rows(_WORD, list(words), list(words.values()))
        yield rows(_DOCS, [b""], [n_docs])
        keys, n = ppm.merge_counts(grams)
        for at in range(0, len(keys), 1 << 16):
            part = keys[at : at + (1 << 16)]
            raw = part.astype(">u4").tobytes()
            yield rows(_GRAM, [raw[i : i + 4] for i in range(0, len(raw), 4)], n[at : at + (1 << 16)].tolist())

    return docs.mapInArrow(releasing(run), "kind int, item binary, n long").groupBy("kind", "item").agg(F.sum("n").alias("n"))


def _tree(counts: DataFrame) -> tuple[ppm.Model, np.ndarray, np.ndarray]:
    """The tree of frequent contexts (each has every suffix in it, so its symbols' code lengths are whole), and all counts of orders 1 and 0."""
    grams = counts.filter(F.col("kind") == _GRAM).select(F.conv(F.hex("item"), 16, 10).cast("long").alias("gram"), "n")
    total = grams.agg(F.sum("n")).first()[0] or 0
    orders = []
    for k in range(ppm.ORDER + 1):
        own = grams.groupBy(F.col("gram").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("gram")).agg(F.sum("n").alias("n"))
        if k >= 2:
            context = F.floor(F.col("gram") / 256)
            many = own.groupBy(context.alias("context")).agg(F.sum("n").alias("whole")).filter(F.col("whole") * FREQUENT_SHARE >= total)
            own = own.withColumn("context", context).join(F.broadcast(many), "context").select("gram", "n")  # at most FREQUENT_SHARE rows
        got = own.toPandas()
        orders.append((got["gram"].to_numpy().astype(np.int64), got["n"].to_numpy().astype(np.float64)))
    singles, pairs = np.zeros(256), np.zeros(1 << 16)
    singles[orders[0][0]], pairs[orders[1][0]] = orders[0][1], orders[1][1]
    return ppm.build([ppm.Counts(orders)], FREQUENT_SHARE), pairs.reshape(256, 256), singles


def _gram_owner(gram, owners: int):
    """Owner of a gram, by the last two bytes of its context; the same of a column and of an array."""
    if isinstance(gram, Column):
        return F.shiftright(F.shiftright(gram, 8).bitwiseAND(0xFFFF) * F.lit(2654435761), 16).bitwiseAND(owners - 1).cast("int")
    return (gram >> 8 & 0xFFFF) * 2654435761 >> 16 & (owners - 1)


def _score(docs: DataFrame, model, frequent, owners: int) -> DataFrame:
    """Chunks: one ``base`` row each with what its documents have so far, and rows of rare words and (without words) of rare grams by owner."""
    names = ["chunk", "owner", "words", "a", "b", "c", "d", "e"]

    def blob(array, kind: str) -> bytes:
        return np.asarray(array, kind).tobytes()

    def rows(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.large_list(pa.binary()), *[pa.binary()] * 5]
        arrays = [pa.array(c, pa.list_(pa.binary()) if pa.types.is_large_list(k) else k) for c, k in zip(zip(*found), kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, known = model.value, frequent.value
        chunk = TaskContext.get().partitionId() << 32
        ids: list[int] = []
        local: dict[bytes, int] = {}
        docs_at: list[np.ndarray] = []
        n_tokens: list[int] = []
        bits: list[float] = []
        grams: list[np.ndarray] = []
        n_grams = 0

        class Local(dict):
            def __missing__(self, word: bytes) -> int:
                self[word] = n = len(self)
                return n

        local = Local()

        def flush() -> list[tuple]:
            nonlocal chunk, local, n_grams
            words = list(local)
            c = np.fromiter((known.get(w, 0) for w in words), np.float64, len(words))
            partial, hits, docs, items, times = np.zeros(len(ids)), np.zeros(len(ids), np.int64), [], [], []
            for i, (which, tf) in enumerate(docs_at):
                own = c[which]
                often = own > 0
                partial[i] = (tf[often] * np.log10(own[often] + 0.5)).sum()
                hits[i] = tf[often].sum()
                rare = ~often
                docs.append(np.full(int(rare.sum()), i, np.int32))
                items.append(which[rare])
                times.append(tf[rare])
            doc_ids = np.array([0 if d is None else d for d in ids], "<i8")
            nulls = np.array([d is None for d in ids])
            out = [(chunk, -1, [blob(nulls, "?")], doc_ids.tobytes(), blob(n_tokens, "<i8"), blob(hits, "<i8"), blob(partial, "<f8"), blob(bits, "<f8"))]
            docs, items, times = (np.concatenate(x) if x else np.empty(0, np.int32) for x in (docs, items, times))
            rare = np.flatnonzero(c == 0)
            owner = np.full(len(words), -1, np.int64)
            owner[rare] = [xxhash.xxh64_intdigest(words[i], 42) % owners for i in rare]
            order = np.argsort(owner[items], kind="stable")
            docs, items, times = docs[order], items[order], times[order]
            cuts = np.searchsorted(owner[items], np.arange(owners + 1))
            for o in range(owners):
                lo, hi = cuts[o], cuts[o + 1]
                if hi > lo:
                    distinct, at = np.unique(items[lo:hi], return_inverse=True)
                    out.append((chunk, o, [words[i] for i in distinct], blob(at, "<u4"), blob(docs[lo:hi], "<u4"), blob(times[lo:hi], "<u4"), None, None))
            docs, items, times = np.concatenate(grams, axis=1) if grams else np.empty((3, 0), np.int64)
            owner = _gram_owner(items, owners)
            order = np.argsort(owner, kind="stable")
            docs, items, times = docs[order], items[order], times[order]
            cuts = np.searchsorted(owner[order], np.arange(owners + 1))
            for o in range(owners):
                lo, hi = cuts[o], cuts[o + 1]
                if hi > lo:
                    distinct, at = np.unique(items[lo:hi], return_inverse=True)
                    out.append((chunk, o, None, blob(at, "<u4"), blob(docs[lo:hi], "<u4"), blob(times[lo:hi], "<u4"), blob(distinct, "<u4"), None))
            chunk += 1
            ids.clear(), docs_at.clear(), n_tokens.clear(), bits.clear(), grams.clear()
            local, n_grams = Local(), 0
            return out

        for own_ids, texts in _slices(batches):
            lengths, which, gram, times = tree.split(texts)
            cuts = np.searchsorted(which, np.arange(len(texts) + 1))
            for i, (d, t, n_bits) in enumerate(zip(own_ids, texts, lengths[:, 0])):
                lo, hi = cuts[i], cuts[i + 1]
                grams.append(np.stack([np.full(hi - lo, len(ids)), gram[lo:hi], times[lo:hi]]))
                n_grams += hi - lo
                words = t.split()
                which, tf = np.unique(np.fromiter(map(local.__getitem__, words), np.int32, len(words)), return_counts=True)
                ids.append(d)
                docs_at.append((which, tf))
                n_tokens.append(len(words) + 1)
                bits.append(n_bits)
                if len(ids) >= CHUNK_DOCS or len(local) > HELD_WORDS or n_grams > HELD_GRAMS:
                    yield rows(flush())
        if ids:
            yield rows(flush())

    return docs.mapInArrow(releasing(run), "chunk long, owner int, words array<binary>, a binary, b binary, c binary, d binary, e binary")


def _meet_counts(chunks: DataFrame, counts: DataFrame, owners: int) -> DataFrame:
    """At each owner, rare words of all chunks meet their counts; ``chunk`` and sparse partial sums go back."""
    own = F.pmod(F.xxhash64("item"), F.lit(owners)).cast("int")
    # pmod of the signed hash differs from the unsigned remainder unless owners divides 2^64, so it is a power of two.
    words = counts.filter(F.col("kind") == _WORD).select(F.lit(None).cast("long").alias("chunk"), own.alias("owner"), F.array("item").alias("words"), F.col("n"), *[F.lit(None).cast("binary").alias(x) for x in "abc"])
    asked = chunks.filter("owner >= 0 and words is not null").select("chunk", "owner", "words", F.lit(None).cast("long").alias("n"), "a", "b", "c")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known = None, {}
        for batch in batches:
            out = []
            for chunk, owner, words, n, a, b, c in zip(*(x.to_pylist() for x in batch.columns)):
                if owner != now:
                    now, known = owner, {}
                if chunk is None:
                    known[words[0]] = n
                    continue
                count = np.array([known.get(w, 0) for w in words], np.float64)[np.frombuffer(a, "<u4")]
                docs, tf = np.frombuffer(b, "<u4").astype(np.int64), np.frombuffer(c, "<u4").astype(np.float64)
                who, at = np.unique(docs, return_inverse=True)
                part = np.bincount(at, tf * np.log10(count + 0.5), len(who))
                hits = np.bincount(at, tf * (count > 0), len(who))
                out.append((chunk, who.astype("<u4").tobytes(), part.astype("<f8").tobytes(), hits.astype("<u4").tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), [pa.int64(), *[pa.binary()] * 3])], names=["chunk", "who", "part", "hits"])

    dealt = words.union(asked).repartition(partitions(counts.sparkSession), "owner").sortWithinPartitions("owner", F.col("chunk").asc_nulls_first())
    return dealt.mapInArrow(releasing(run), "chunk long, who binary, part binary, hits binary")


def _meet_grams(chunks: DataFrame, counts: DataFrame, low, owners: int) -> DataFrame:
    """At each owner, rare grams of all chunks meet the counts; ``chunk`` and sparse bits go back, without ``hits``."""
    gram = F.conv(F.hex("item"), 16, 10).cast("long")
    nothing = [F.lit(None).cast("binary").alias(x) for x in "abcd"]
    known = counts.filter(F.col("kind") == _GRAM).select(F.lit(None).cast("long").alias("chunk"), _gram_owner(gram, owners).alias("owner"), gram.alias("gram"), "n", *nothing)
    asked = chunks.filter("owner >= 0 and words is null").select("chunk", "owner", F.lit(None).cast("long").alias("gram"), F.lit(None).cast("long").alias("n"), *"abcd")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, code = None, [], None
        for batch in batches:
            out = []
            owner = batch.column(1).to_numpy()
            is_count = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((np.diff(owner) != 0) | np.diff(is_count)) + 1
            for lo, hi in zip([0, *turns], [*turns, len(owner)]):
                if hi == lo:
                    continue
                if owner[lo] != now:
                    now, held, code = owner[lo], [], None
                if is_count[lo]:
                    held.append([batch.column(k).slice(lo, hi - lo).to_numpy() for k in (2, 3)])
                    continue
                if code is None:
                    grams, n = np.concatenate(held, axis=1) if held else np.empty((2, 0), np.int64)
                    held, code = [], ppm.Grams(grams, n, *low.value)
                for chunk, a, b, c, d in zip(*(batch.column(k).slice(lo, hi - lo).to_pylist() for k in (0, 4, 5, 6, 7))):
                    bits = code.bits(np.frombuffer(d, "<u4").astype(np.int64))[np.frombuffer(a, "<u4")]
                    who, at = np.unique(np.frombuffer(b, "<u4"), return_inverse=True)
                    part = np.bincount(at, np.frombuffer(c, "<u4") * bits, len(who))
                    out.append((chunk, who.astype("<u4").tobytes(), part.astype("<f8").tobytes(), None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), [pa.int64(), *[pa.binary()] * 3])], names=["chunk", "who", "part", "hits"])

    dealt = known.union(asked).repartition(partitions(counts.sparkSession), "owner").sortWithinPartitions("owner", F.col("chunk").asc_nulls_first())
    return dealt.mapInArrow(releasing(run), "chunk long, who binary, part binary, hits binary")


def _gather(chunks: DataFrame, parts: DataFrame, n_train: int, n_all: int, n_distinct: int, n: int) -> DataFrame:
    base = chunks.filter("owner < 0").select("chunk", F.element_at("words", 1).alias("nulls"), *"abcde", *[F.lit(None).cast("binary").alias(x) for x in ("who", "part", "hits")])
    back = parts.select("chunk", *[F.lit(None).cast("binary").alias(x) for x in ("nulls", *"abcde")], "who", "part", "hits")
    end = math.log10(n_train + 0.5)
    share = math.log10(n_all + 0.5 * (n_distinct + 1))

    def rows(held: tuple) -> pa.RecordBatch:
        nulls, ids, n_tokens, hits, partial, bits = held
        null = np.frombuffer(nulls, "?")
        doc_ids = [None if x else int(d) for d, x in zip(np.frombuffer(ids, "<i8"), null)]
        n_tokens = np.frombuffer(n_tokens, "<i8")
        score = bits * -math.log10(2)
        arrays = [pa.array(doc_ids, pa.int64()), pa.array([_is_held_out(d) for d in doc_ids]), pa.array(n_tokens), pa.array(hits + (n_train > 0)), pa.array(np.full(len(null), n_all)), pa.array(partial + end - n_tokens * share), pa.array(score)]
        return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in SCHEMA.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for chunk, nulls, a, b, c, d, e, who, part, hits in zip(*(x.to_pylist() for x in batch.columns)):
                if who is None:
                    if held:
                        yield rows(held)
                    held = (nulls, a, b, np.frombuffer(c, "<i8").copy(), np.frombuffer(d, "<f8").copy(), np.frombuffer(e, "<f8").copy())
                elif hits is None:
                    held[5][np.frombuffer(who, "<u4")] += np.frombuffer(part, "<f8")
                else:
                    at = np.frombuffer(who, "<u4")
                    held[3][at] += np.frombuffer(hits, "<u4")
                    held[4][at] += np.frombuffer(part, "<f8")
        if held:
            yield rows(held)

    dealt = base.union(back).repartition(n, "chunk").sortWithinPartitions("chunk", F.col("who").isNotNull(), F.xxhash64("who", "part"))
    return dealt.mapInArrow(releasing(run), SCHEMA)


def score_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Null texts count as empty (the end token alone, score 0); null ids count as the empty text where rows
    are held out; repeated rows are rows of their own, in training too; with no training row all counts are
    0 (base_score is then 0 / nothing known); empty tables give none; other columns are not read.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    owners = 1 << max(0, max(partitions(spark), -(-text_bytes(base) // OWNED_BYTES)) - 1).bit_length()
    counts = Written(_train(base), "counts")
    words = counts.df.filter(F.col("kind") == _WORD)
    n_train = counts.df.filter(F.col("kind") == _DOCS).agg(F.sum("n")).first()[0] or 0
    n_words, n_distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    n_all, n_distinct = n_words + n_train, n_distinct + (n_train > 0)
    model, *low = _tree(counts.df)
    often = words.filter(F.col("n") * FREQUENT_SHARE >= n_all).select("item", "n").collect()  # at most FREQUENT_SHARE rows
    sc = spark.sparkContext
    chunks = Written(_score(base, sc.broadcast(model), sc.broadcast({bytes(r["item"]): r["n"] for r in often}), owners), "chunks")
    parts = _meet_counts(chunks.df, counts.df, owners).union(_meet_grams(chunks.df, counts.df, sc.broadcast(low), owners))
    return _gather(chunks.df, parts, n_train, n_all, n_distinct, partitions(spark))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
