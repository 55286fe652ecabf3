"""Ordered scans over keys of any size.

A window holds all rows of a key in one task.  Here the rows of a large key are cut, in order, into cells of bounded
size; every cell is summed up in one row, a scan over these rows says what comes before each cell, and a second pass
over the cells adds it.  Keys below ``LARGE_KEY`` rows take Spark's window: which way a key goes is measured, and
both give the same rows.  ``order`` must be a total order within a key, ascending, nulls first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.operators.stored import Stored

LARGE_KEY, CELL_ROWS = 1 << 20, 1 << 17
_CELL = "__cell"


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    met = F.lit(True)
    for n in names:
        met = met & left[n].eqNullSafe(right[n])
    return met


def cells(df: DataFrame, keys: list[str], order: list[str], rows: int | None = None) -> DataFrame:
    """``df`` with a cell number that grows with the key and the order; written, so that numbers stay what they are."""
    source = Stored(df).df
    n = max(1, -(-source.count() // (rows or CELL_ROWS)))
    return Stored(source.repartitionByRange(n, *keys, *order).withColumn(_CELL, F.spark_partition_id())).df


def _before(celled: DataFrame, keys: list[str], own: Column, scan: Callable[[Column], Column]) -> DataFrame:
    """``keys, cell, before``: a scan over one summary a cell and key; a row for each, so no more than cells and keys."""
    earlier = Window.partitionBy(*keys).orderBy(_CELL).rowsBetween(Window.unboundedPreceding, -1)
    sums = celled.groupBy(*keys, _CELL).agg(own.alias("own"))
    return sums.select(*keys, _CELL, scan(F.col("own")).over(earlier).alias("before"))


def _with_before(celled: DataFrame, before: Stored, keys: list[str]) -> DataFrame:
    side = before.side().select(*[F.col(c).alias(f"__{k}") for k, c in enumerate([*keys, _CELL])], "before")
    met = F.lit(True)
    for k, c in enumerate([*keys, _CELL]):
        met = met & celled[c].eqNullSafe(side[f"__{k}"])
    return celled.join(side, met).select(*celled.columns, F.col("before").alias("__before"))


def _each_way(df: DataFrame, keys: list[str], plain: Callable[[DataFrame], DataFrame], large: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Keys of at least LARGE_KEY rows (so at most one in LARGE_KEY of all rows, and few) by ``large``, others by ``plain``."""
    if not keys:
        return large(df)
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= LARGE_KEY).select(*keys)
    if hot.isEmpty():
        return plain(df)
    side = F.broadcast(Stored(hot).df)
    return plain(df.join(side, _same(df, side, keys), "left_anti")).unionByName(large(df.join(side, _same(df, side, keys), "left_semi")))


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """Adds the sum of ``value`` (null: 0) over the rows up to and with each row."""
    rows = df.withColumn("__v", F.coalesce(value.cast("long"), F.lit(0)))
    up_to = lambda *more: F.sum("__v").over(Window.partitionBy(*keys, *more).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def large(part: DataFrame) -> DataFrame:
        celled = cells(part, keys, order)
        before = Stored(_before(celled, keys, F.sum("__v"), F.sum))
        return _with_before(celled, before, keys).withColumn(name, up_to(_CELL) + F.coalesce("__before", F.lit(0))).drop(_CELL, "__before")

    return _each_way(rows, keys, lambda part: part.withColumn(name, up_to()), large).drop("__v")


def carried(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """Adds the last value that is not null, up to and with each row."""
    rows = df.withColumn("__v", F.when(value.isNotNull(), F.struct(value.alias("v"))))
    up_to = lambda *more: F.last("__v", ignorenulls=True).over(Window.partitionBy(*keys, *more).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def large(part: DataFrame) -> DataFrame:
        celled = cells(part, keys, order)
        latest = F.max_by("__v", F.when(F.col("__v").isNotNull(), F.struct(*order)))
        before = Stored(_before(celled, keys, latest, lambda c: F.last(c, ignorenulls=True)))
        return _with_before(celled, before, keys).withColumn(name, F.coalesce(up_to(_CELL), F.col("__before"))["v"]).drop(_CELL, "__before")

    return _each_way(rows, keys, lambda part: part.withColumn(name, up_to()["v"]), large).drop("__v")


def lagged(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """Adds the value of the row before, null at a key's first."""
    rows = df.withColumn("__v", F.struct(value.alias("v")))
    back = lambda *more: F.lag("__v").over(Window.partitionBy(*keys, *more).orderBy(*order))

    def large(part: DataFrame) -> DataFrame:
        celled = cells(part, keys, order)
        before = Stored(_before(celled, keys, F.max_by("__v", F.struct(*order)), F.last))
        return _with_before(celled, before, keys).withColumn(name, F.coalesce(back(_CELL), F.col("__before"))["v"]).drop(_CELL, "__before")

    return _each_way(rows, keys, lambda part: part.withColumn(name, back()["v"]), large).drop("__v")


def islands(df: DataFrame, keys: list[str], order: list[str], value: Column, breaks: Callable[[Column, Column], Column], name: str = "island") -> DataFrame:
    """Numbers runs from 0: a row begins a new one where ``breaks(value, value before)`` is true."""
    rows = lagged(df.withColumn("__now", value), keys, order, F.col("__now"), "__then")
    new = F.coalesce(breaks(F.col("__now"), F.col("__then")), F.lit(False))
    return running_sum(rows, keys, order, F.when(new, 1).otherwise(0), name).drop("__now", "__then")


def within_budget(df: DataFrame, keys: list[str], order: list[str], spends: Column, budget: int) -> DataFrame:
    """Rows before which less than ``budget`` was spent, so the one that reaches it is the last.

    Whatever a key holds, its cells are summed up first and those that begin beyond the budget are not walked.
    """
    rows = df.withColumn("__v", F.coalesce(spends.cast("long"), F.lit(0)))
    earlier = lambda *more: F.coalesce(F.sum("__v").over(Window.partitionBy(*keys, *more).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    def large(part: DataFrame) -> DataFrame:
        celled = cells(part, keys, order)
        before = Stored(_before(celled, keys, F.sum("__v"), F.sum).filter(F.coalesce("before", F.lit(0)) < budget))
        open_ = _with_before(celled, before, keys).withColumn("__spent", F.coalesce("__before", F.lit(0)) + earlier(_CELL))
        return open_.filter(F.col("__spent") < budget).drop(_CELL, "__before", "__spent")

    plain = lambda part: part.withColumn("__spent", earlier()).filter(F.col("__spent") < budget).drop("__spent")
    return _each_way(rows, keys, plain, large).drop("__v")


def as_of(left: DataFrame, right: DataFrame, keys: list[str], left_at: str, right_at: str, value: str, name: str) -> DataFrame:
    """For each left row the right value of the latest time strictly before, by one merge of both sides per key; ties: the largest value."""
    a = left.select("*", F.col(left_at).alias("__at"), F.lit(0).alias("__side"), F.lit(None).cast(right.schema[value].dataType).alias("__right"), F.struct(*left.columns).alias("__row"))
    b = right.select(*keys, F.col(right_at).alias("__at"), F.lit(1).alias("__side"), F.col(value).alias("__right"))
    both = a.unionByName(b, allowMissingColumns=True)
    # strictly before: at one time, left rows come first
    met = carried(both, keys, ["__at", "__side", "__right", "__row"], F.when(F.col("__side") == 1, F.col("__right")), name)
    return met.filter("__side = 0").select(*left.columns, name)


def number_runs(rows: DataFrame, keys: list[str], value: str, block: str) -> DataFrame:
    """``keys, lo, hi``: maximal runs of distinct whole numbers.

    Runs are found within blocks of values and then stitched where they touch a block's end, so no task holds more of a
    key than a block and the pieces of its runs.
    """
    run = F.col(value) - F.row_number().over(Window.partitionBy(*keys, block).orderBy(value))
    pieces = rows.withColumn("__run", run).groupBy(*keys, block, "__run").agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    joined = islands(pieces, keys, ["lo"], F.struct("lo", "hi"), lambda now, then: now["lo"] > then["hi"] + 1, "__part")
    return joined.groupBy(*keys, "__part").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("__part")
