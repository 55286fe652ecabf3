"""Sets of whole numbers as ranges ``lo, hi`` per key: union, difference, holes.  No series is ever written out.

Everything is a sweep over the ends of ranges: scans that count what is open, so ranges may overlap and repeat, span
any length, and a key may hold any number of them.  Ranges with a null end or with ``hi`` below ``lo`` are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.operators import scans


def of_values(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Maximal ranges of the distinct values."""
    v, block = F.col(value).cast("long"), F.floor(F.col(value) / scans.CELL_ROWS)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, v.alias("v"), block.alias("block")).distinct()
    return scans.number_runs(rows, keys, "v", "block")


def _ends(ranges: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``keys, at`` and how much opens there less what closes."""
    real = ranges.filter("lo <= hi").select(*keys, F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi"))
    opens = real.select(*keys, F.col("lo").alias("at"), F.lit(1).alias(column))
    return opens.unionAll(real.select(*keys, (F.col("hi") + 1).alias("at"), F.lit(-1).alias(column)))


def _sweep(ends: DataFrame, keys: list[str], columns: list[str], inside: Column) -> DataFrame:
    """Maximal ranges where ``inside`` holds for what is open, from ``keys, at`` and changes in ``columns``."""
    zero = F.lit(0)
    rows = ends.groupBy(*keys, "at").agg(*[F.sum(F.coalesce(c, zero)).alias(c) for c in columns])
    for c in columns:
        rows = scans.running_sum(rows, keys, ["at"], F.col(c), f"open_{c}")
    rows = rows.withColumn("inside", inside)
    # what changes nothing splits no range; the next end that does is one behind what is inside
    turned = scans.lagged(rows.select(*keys, "at", "inside"), keys, ["at"], F.col("inside"), "was").filter(F.col("inside") != F.coalesce("was", F.lit(False)))
    closed = scans.lagged(turned.select(*keys, "at", "inside"), keys, ["at"], F.col("at"), "lo")
    return closed.filter(~F.col("inside")).select(*keys, "lo", (F.col("at") - 1).alias("hi"))


def union(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Maximal ranges that the ranges cover together; those that touch are one."""
    return _sweep(_ends(ranges, keys, "a"), keys, ["a"], F.col("open_a") > 0)


def difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Maximal ranges of numbers that are in a left range and in no right one."""
    ends = _ends(left, keys, "a").unionByName(_ends(right, keys, "b"), allowMissingColumns=True)
    return _sweep(ends, keys, ["a", "b"], (F.col("open_a") > 0) & (F.col("open_b") == 0))


def hull(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the range from the smallest to the largest number."""
    return ranges.filter("lo <= hi").groupBy(*keys).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def holes(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Maximal ranges between the numbers of a key that no range covers."""
    return difference(hull(ranges, keys), ranges, keys)


def compact(ranges: DataFrame, keys: list[str], name: str = "pages") -> DataFrame:
    """Disjoint ranges as text like ``1-3,5`` per key, and how many numbers they hold."""
    text = F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("string")).otherwise(F.concat_ws("-", "lo", "hi"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("lo", text.alias("t")))), lambda x: x["t"])
    return ranges.groupBy(*keys).agg(F.array_join(listed, ",").alias(name), F.sum(F.col("hi") - F.col("lo") + 1).alias(f"n_{name}"))
