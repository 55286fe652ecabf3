"""Ordered operators: islands, carried values, greedy bins, first rows (``scans`` has those for keys of any size)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def ordered(keys: list[str], order: list[Column | str]):
    return Window.partitionBy(*keys).orderBy(*order)


def islands(df: DataFrame, keys: list[str], order: list[Column | str], breaks: Column, name: str = "island") -> DataFrame:
    """Numbers runs from 0: a row where ``breaks`` is true (or the first) begins a new one."""
    w = ordered(keys, order)
    first = F.row_number().over(w) == 1
    return df.withColumn(name, F.sum(F.when(first | ~F.coalesce(breaks, F.lit(False)), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))


def carried(value: Column, keys: list[str], order: list[Column | str]) -> Column:
    """The last non-null value up to and with the row."""
    return F.last(value, ignorenulls=True).over(ordered(keys, order).rowsBetween(Window.unboundedPreceding, 0))


def touching(df: DataFrame, keys: list[str], start: str, stop: str, rows: int = 1 << 20) -> DataFrame:
    """``keys, start, stop``: ranges of one length that touch, or are equal, as one.

    A task gets about ``rows`` rows, however many there are, and sorts them; nothing is hashed.  Rows of a range
    without a start are one row.
    """
    w, x, y = ordered(keys, [start]), F.col(start), F.col(stop)
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))
    has = lambda c: F.coalesce(c, F.lit(False))
    marked = df.select(*keys, start, stop).repartition(n, *keys).select("*", F.lag(F.struct(stop)).over(w).alias("__a"), F.lead(F.struct(start)).over(w).alias("__b"))
    before, behind = F.col("__a")[stop], F.col("__b")[start]
    marked = marked.withColumn("__first", F.col("__a").isNull() | (before.isNull() != x.isNull()) | has(before < x))
    marked = marked.withColumn("__last", F.col("__b").isNull() | (behind.isNull() != x.isNull()) | has(behind > y))
    ends = marked.filter("__first or __last").withColumn(stop, F.when(F.col("__last"), y).otherwise(F.lead(stop).over(w)))
    return ends.filter("__first").select(*keys, start, stop)


def _by_key(rows: DataFrame, keys: list[str], numbers: list[str], fresh: Callable[[], tuple], number: Callable[[np.ndarray, tuple], tuple[np.ndarray, tuple]], name: str) -> DataFrame:
    """Adds a long to sorted rows; ``number`` gives it to a key's rows of a batch, a matrix of ``numbers`` (null: 0), and the state it goes on with.

    Sorted rows stream through as Arrow batches, and what is carried from one to the next is the state of one key, so a
    key with a third of all rows needs no more memory than any other.
    """
    key_at, at = ([rows.columns.index(c) for c in names] for names in (keys, numbers))

    def run(batches):
        last = state = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k) for k in key_at]
            values = np.stack([pc.fill_null(batch.column(k).cast(pa.int64()), 0).to_numpy() for k in at], axis=1)
            new = np.zeros(batch.num_rows, bool)
            for c in columns:
                code = c.dictionary_encode(null_encoding="encode").indices.to_numpy()
                new[1:] |= code[1:] != code[:-1]
            starts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            out = []
            for start, end in zip(starts, starts[1:]):
                key = tuple(c[start].as_py() for c in columns)
                if state is None or key != last:
                    last, state = key, fresh()
                found, state = number(values[start:end], state)
                out.append(found)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out))], names=[*batch.schema.names, name])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(name, LongType())]))


def greedy_bins(df: DataFrame, keys: list[str], order: str, size: str, limit: int) -> DataFrame:
    """Consecutive rows in bins whose sizes sum to ``limit`` at most (a larger row is alone but for zeros before it); a null size is 0.

    Sizes must not be negative.  A bin is one search in the prefix sums of a batch.
    """

    def bins(values: np.ndarray, state: tuple[int, int]) -> tuple[np.ndarray, tuple[int, int]]:
        number, used = state
        sums = np.concatenate([[0], np.cumsum(values[:, 0])])
        out, at = np.empty(len(values), np.int64), 0
        while at < len(values):
            end = max(at, int(np.searchsorted(sums, limit - used + sums[at], "right")) - 1)  # rows at .. end fit
            while end < len(values) and used + sums[end] - sums[at] == 0:
                end += 1  # nothing is used, so a row goes in whatever its size
            out[at:end] = number
            used += int(sums[end] - sums[at])
            if end < len(values):
                number, used = number + 1, 0
            at = end
        return out, (number, used)

    rows = df.select(*keys, order, size).repartition(*keys).sortWithinPartitions(*keys, order)
    return _by_key(rows, keys, [size], lambda: (0, 0), bins, "bin").drop(size)


def page_bins(df: DataFrame, keys: list[str], order: str, limits: dict[str, int], least: int, most: int) -> DataFrame:
    """Consecutive pages in bins: the first ``least`` pages whatever they hold, then more while no sum passes its limit, ``most`` in all.

    The rest at the end of a key may be shorter than ``least``.  A null count is 0; counts must not be negative.  A bin
    is one search for each limit in the prefix sums of a batch.
    """
    bounds = np.array(list(limits.values()), np.int64)

    def bins(values: np.ndarray, state: tuple) -> tuple[np.ndarray, tuple]:
        number, pages, held = state
        sums = np.concatenate([np.zeros((1, len(bounds)), np.int64), np.cumsum(values, axis=0)])
        out, at = np.empty(len(values), np.int64), 0
        while at < len(values):
            room = bounds - held + sums[at]
            fits = min(int(np.searchsorted(sums[:, k], room[k], "right")) - 1 for k in range(len(bounds)))
            end = min(max(at, fits, at + least - pages), at + most - pages, len(values))
            out[at:end] = number
            if end < len(values):
                number, pages, held = number + 1, 0, np.zeros(len(bounds), np.int64)
            else:
                pages, held = pages + end - at, held + sums[end] - sums[at]
            at = end
        return out, (number, pages, held)

    rows = df.repartition(*keys).sortWithinPartitions(*keys, order)
    return _by_key(rows, keys, list(limits), lambda: (0, 0, np.zeros(len(bounds), np.int64)), bins, "bin")


def first_rows(df: DataFrame, keys: list[str], order: list[Column | str], n: int, name: str = "rank") -> DataFrame:
    """The first n rows per key; Spark keeps n per task before the shuffle."""
    return df.withColumn(name, F.row_number().over(ordered(keys, order))).filter(F.col(name) <= n)


def with_dialogue(df: DataFrame, keys: list[str], order: list[Column | str], kind: str, indented: Column) -> DataFrame:
    """Turns ``action`` and ``format_marker`` into ``dialogue`` in runs of such indented rows and parentheticals that a ``character`` opens.

    The kind of a row rests on the row before it; in closed form, the last row that cannot belong to such a run decides.
    """
    flows = (F.col(kind) == "parenthetical") | (F.col(kind).isin("action", "format_marker") & indented)
    opener = carried(F.when(~flows, F.col(kind)), keys, order)
    spoken = F.col(kind).isin("action", "format_marker") & indented & (F.col("__opener") == "character")
    return df.withColumn("__opener", opener).withColumn(kind, F.when(spoken, "dialogue").otherwise(F.col(kind))).drop("__opener")
