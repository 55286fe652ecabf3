"""Which of many phrases stand in which texts.

Phrases make one automaton, so a text is read once however many phrases there are.  It is sent to all tasks if the
phrases were measured small; else they are dealt to shards of that size by hash, and a task has one shard and a share of
the texts.  Only (text, phrase) pairs come out, or the least values
of a text's phrases.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from scriptorium.operators import runs
from scriptorium.operators.stored import Stored

#: Bytes of phrases, as measured, in one automaton.
SHARD_BYTES = 4 << 20
#: Pairs that a task sends at once; bytes it takes to remember pairs, one for each, to leave out copies.
PAIRS, SEEN = 1 << 12, 1 << 23
_WORD = re.compile(r"\w")


class Search(NamedTuple):
    """What finds values in a text, what makes a column of them, and how many phrases are searched for."""

    find: Callable
    column: Callable
    size: int


def automaton(phrases):
    """Each phrase is found as its place among them, so none of them stays as an object."""
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k, p in enumerate(phrases):
        if p:
            found.add_word(p, k)
    if len(found):
        found.make_automaton()
    return found


def hits(text: str, machine, lengths: list[int] | None = None) -> list[int]:
    """Places of the distinct phrases in a text, in order; with their ``lengths`` no word character stands before or behind one."""
    if not len(machine):
        return []
    if lengths is None:
        return sorted({k for _, k in machine.iter(text)})
    out: set[int] = set()
    for end, k in machine.iter(text):
        if k in out:
            continue
        start = end + 1 - lengths[k]
        if not (start and _WORD.match(text[start - 1])) and not (end + 1 < len(text) and _WORD.match(text[end + 1])):
            out.add(k)
    return sorted(out)


def least(text: str, machine, values: list[list[int]], n: int) -> list[int]:
    """The n least values of the phrases in a text; a phrase is found as its place in ``values``, which are in order of their first."""
    if not len(machine):
        return []
    ids = sorted({k for _, k in machine.iter(text)})[:n]  # those behind begin beyond the n-th first value
    if len(ids) == n:
        most = values[ids[-1]][0]
        return sorted(v for k in ids for v in values[k][: bisect.bisect_right(values[k], most)])[:n]
    return sorted(v for k in ids for v in values[k])[:n]


def _searched(rows: DataFrame, key: str, read, out: StructField, few_keys: bool) -> DataFrame:
    """``key`` and what is found, from batches; ``read`` gives (key column, texts, their search) of a batch.

    Texts are taken one by one and pairs go out as they come, so a task never holds those of a batch.
    """

    def run(batches):
        seen: dict = {}  # a byte for each phrase of a key
        last = None
        for batch in batches:
            for keys, texts, search in read(batch):
                if last is not search:
                    seen, last = {}, search
                at, found = [], []
                for i, text in enumerate(texts):
                    own = search.find(text.as_py()) if text.is_valid else ()
                    if few_keys and own:
                        k = keys[i].as_py()
                        if k not in seen:
                            if (len(seen) + 1) * search.size > SEEN:
                                seen.clear()
                            seen[k] = bytearray(search.size)
                        known = seen[k]
                        own = [p for p in own if not known[p]]
                        for p in own:
                            known[p] = 1
                    at += [i] * len(own)
                    found += own
                    if len(found) >= PAIRS:
                        yield pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int64())), search.column(found)], names=[key, out.name])
                        at, found = [], []
                if found:
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int64())), search.column(found)], names=[key, out.name])

    return rows.mapInArrow(run, StructType([rows.schema[key], out]))


def _found(rows: DataFrame, key: str, known: Stored, out: StructField, finder, few_keys: bool = False) -> DataFrame:
    """``key`` and what the search of ``finder(phrases)`` finds in each ``body``; ``known``: ``phrase`` and, if they have them, ``values``.

    A finder gets the columns of ``known`` as Arrow arrays, so a worker holds no object for each phrase.
    """
    spark = rows.sparkSession
    entries = known.df.select(F.struct(*known.df.columns).alias("entry"))
    bytes_ = F.octet_length("phrase") + (8 * F.size("values") if "values" in known.df.columns else 0)
    size = known.df.agg(F.sum(bytes_)).first()[0] or 0
    if size <= SHARD_BYTES:
        shared = spark.sparkContext.broadcast([c.combine_chunks() for c in known.df.toArrow().columns])  # SHARD_BYTES at most
        finders: dict = {}

        def read(batch):
            if not finders:
                finders[0] = finder(*shared.value)
            yield batch.column(0), batch.column(1), finders[0]

        return _searched(rows, key, read, out, few_keys)
    # a task gets one shard and a share of the texts, so texts are sent once a shard and no task reads them all
    n, shares = -(-size // SHARD_BYTES), max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    each = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    shard = F.pmod(F.xxhash64("entry.phrase"), F.lit(n)).cast("int").alias("shard")
    shards = entries.groupBy(shard).agg(F.collect_list("entry").alias("phrases")).select("shard", "phrases", each(shares).alias("share"))

    def read_shards(batch):
        # rows come sorted by shard and share; the phrases come first
        for i, shard in enumerate(batch.column(2).to_pylist()):
            own = batch.column(3)[i]
            if own.is_valid:
                held[0], held[1] = shard, finder(*[pa.concat_arrays([c]) for c in own.values.flatten()])  # copied, so the batch can go
            elif held[0] == shard:
                yield batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), held[1]

    held = [None, None]
    share = F.pmod(F.xxhash64(key, "body"), F.lit(shares)).cast("int").alias("share")
    sent = rows.select(key, "body", each(n).alias("shard"), F.lit(None).cast(shards.schema["phrases"].dataType).alias("phrases"), share)
    lead = shards.select(F.lit(None).cast(rows.schema[key].dataType).alias(key), F.lit(None).cast("string").alias("body"), "shard", "phrases", "share")
    dealt = lead.unionByName(sent).withColumn("later", F.col("phrases").isNull()).repartition(n * shares, "shard", "share").sortWithinPartitions("shard", "share", "later")
    return _searched(dealt, key, read_shards, out, few_keys)


def phrase_hits(texts: DataFrame, key: str, text: str, phrases: DataFrame, phrase: str, whole_words: bool, fold_case: bool = True, few_keys: bool = False) -> DataFrame:
    """``key, phrase`` (lower-cased with ``fold_case``) for every distinct phrase in each text.

    Null and empty texts and phrases meet nothing; rows of one key each give their own pairs.  With ``few_keys`` a task
    leaves out most of the pairs that it gave before, so pairs may come once or more for all rows of a key.
    """
    fold = F.lower if fold_case else lambda c: c
    rows = texts.select(key, fold(F.col(text)).alias("body"))
    known = Stored(phrases.select(fold(F.col(phrase)).alias("phrase")).filter("phrase <> ''").distinct())

    def finder(own):
        machine, lengths = automaton(p.as_py() for p in own), pc.utf8_length(own).to_pylist() if whole_words else None
        return Search(lambda text: hits(text, machine, lengths), lambda found: own.take(pa.array(found, pa.int64())), len(own))

    return _found(rows, key, known, StructField("phrase", rows.schema["body"].dataType), finder, few_keys)


def least_values(texts: DataFrame, key: str, text: str, phrases: DataFrame, phrase: str, value: str, n: int, fold_case: bool = True) -> DataFrame:
    """``key, values``: the n least values of the phrases that stand in a text, in order; no row without one.

    A value (a long) must be that of one phrase only; a phrase may have many.  Texts that are read in several shards give a row each
    time, so rows of a key are still to be merged.  However many phrases a text holds, n values of it leave its task.
    """
    fold = F.lower if fold_case else lambda c: c
    rows = texts.select(key, fold(F.col(text)).alias("body"))
    own = phrases.select(fold(F.col(phrase)).alias("phrase"), F.col(value).cast("long").alias("value")).filter("phrase <> '' and value is not null")
    own = runs.first_rows(own, ["phrase"], ["value"], n)
    known = Stored(own.groupBy("phrase").agg(F.array_sort(F.collect_list("value")).alias("values")))

    out = StructField("values", ArrayType(LongType()))
    kind = to_arrow_type(out.dataType)

    def finder(own, values):
        own = sorted(zip(own.to_pylist(), values.to_pylist()), key=lambda x: x[1][0])
        machine, values = automaton(p for p, _ in own), [v for _, v in own]
        return Search(lambda text: [v] if (v := least(text, machine, values, n)) else (), lambda found: pa.array(found, kind), len(own))

    return _found(rows, key, known, out, finder)
