"""Scans over cells against a walk of each key, with one key cut over several cells."""

import random

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import intervals, runs, scans, stored

SCHEMA = "k string, at int, v int"


def table(n=900):
    rnd = random.Random(2)
    rows = [("hot", i, rnd.choice([None, 1, 2, 3, 7])) for i in range(n)] + [(None, i, rnd.choice([None, 4])) for i in range(300)]
    rows += [(f"k{i % 20}", i, i % 5) for i in range(200)] + [("one", None, 3), ("none", 5, None)]
    rnd.shuffle(rows)
    return rows


def walk(rows):
    keys = {}
    for k, at, v in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        keys.setdefault(k, []).append((at, v))
    return keys


@pytest.fixture(params=["window", "cells"])
def few(request, monkeypatch):
    if request.param == "cells":
        monkeypatch.setattr(scans, "LARGE_KEY", 250)
        monkeypatch.setattr(scans, "CELL_ROWS", 160)
        monkeypatch.setattr(stored, "SMALL_SIDE", 0)


def got(df, *names):
    return sorted((tuple(r) for r in df.select("k", "at", *names).collect()), key=str)


def test_scans_equal_a_walk(spark, few):
    rows = table()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    total, last, before, number, spent = [], [], [], [], []
    for k, own in walk(rows).items():
        s, kept, prev, run, used = 0, None, None, 0, 0
        for at, v in own:
            if used < 90:
                spent.append((k, at))
            used += v or 0
            s += v or 0
            kept = v if v is not None else kept
            run += prev is not None and v is not None and v < prev
            total.append((k, at, s))
            last.append((k, at, kept))
            before.append((k, at, prev))
            number.append((k, at, run))
            prev = v
    v = F.col("v")
    assert got(scans.running_sum(df, ["k"], ["at"], v, "s"), "s") == sorted(total, key=str)
    assert got(scans.carried(df, ["k"], ["at"], v, "s"), "s") == sorted(last, key=str)
    assert got(scans.lagged(df, ["k"], ["at"], v, "s"), "s") == sorted(before, key=str)
    assert got(scans.islands(df, ["k"], ["at"], v, lambda now, then: now < then, "s"), "s") == sorted(number, key=str)
    assert got(scans.within_budget(df, ["k"], ["at"], v, 90)) == sorted(spent, key=str)


def test_no_key_at_all(spark, few):
    df = spark.range(0, 700).select(F.lit("x").alias("k"), F.col("id").cast("int").alias("at"), F.lit(1).alias("v")).repartition(4)
    assert got(scans.within_budget(df, [], ["at"], F.col("v"), 333)) == sorted((("x", i) for i in range(333)), key=str)
    assert got(scans.running_sum(df, [], ["at"], F.col("v"), "s"), "s") == sorted((("x", i, i + 1) for i in range(700)), key=str)


def test_as_of_and_ranges(spark, few):
    rows = table()
    left = spark.createDataFrame([r for r in rows if r[1] is not None and r[1] % 3], SCHEMA)
    right = spark.createDataFrame([r for r in rows if r[1] is not None and r[1] % 3 != 1], SCHEMA)
    want = []
    for k, at, _ in left.collect():
        earlier = [(a, v) for kk, a, v in right.collect() if kk == k and a < at and v is not None] if len(want) < 60 else None
        want.append((k, at, max(earlier)[1] if earlier else None) if earlier is not None else None)
    out = {(r.k, r.at): r.s for r in scans.as_of(left, right, ["k"], "at", "at", "v", "s").collect()}
    assert len(out) == left.count() and all(out[k, at] == s for k, at, s in filter(None, want))
    values = [("hot", i) for i in range(-300, 700) if i % 97] + [("hot", 5)] + [("b", 9), (None, 1), (None, 2), ("b", None)]
    text = {r.k: r.ranges for r in intervals.compact(intervals.of_values(spark.createDataFrame(values, "k string, x int"), ["k"], "x"), ["k"], "ranges").collect()}
    runs_of = []
    for i in sorted({i for k, i in values if k == "hot"}):
        if runs_of and runs_of[-1][1] == i - 1:
            runs_of[-1][1] = i
        else:
            runs_of.append([i, i])
    assert text == {"hot": ",".join(f"{a}-{b}" if a < b else f"{a}" for a, b in runs_of), "b": "9", None: "1-2"}


def test_sets_of_ranges(spark, few):
    rnd = random.Random(6)
    some = lambda n, k: [("hot" if i % 3 else f"k{i % 7}", a, a + rnd.randint(-1, 9)) for i, a in enumerate(rnd.choices(range(k), k=n))] + [("k1", None, 3), ("k1", 3, None)]
    left, right = some(700, 9000), some(600, 9000)
    schema = "k string, lo int, hi int"
    whole = {}
    for side, rows in enumerate((left, right)):
        for k, lo, hi in rows:
            if lo is not None and hi is not None:
                whole.setdefault(k, (set(), set()))[side].update(range(lo, hi + 1))

    def ranges(values):
        out = []
        for v in sorted(values):
            if out and out[-1][1] == v - 1:
                out[-1][1] = v
            else:
                out.append([v, v])
        return out

    a, b = (spark.createDataFrame(rows, schema).repartition(4) for rows in (left, right))
    rows = lambda df: sorted((r.k, r.lo, r.hi) for r in df.collect())
    want = lambda pick: sorted((k, *r) for k, sides in whole.items() for r in ranges(pick(*sides)))
    assert rows(intervals.union(a, ["k"])) == want(lambda x, y: x)
    assert rows(intervals.difference(a, b, ["k"])) == want(lambda x, y: x - y)
    assert rows(intervals.holes(a, ["k"])) == want(lambda x, y: set(range(min(x), max(x) + 1)) - x if x else set())
    assert intervals.difference(a.limit(0), b, ["k"]).collect() == []


def test_empty(spark, few):
    df = spark.createDataFrame([], SCHEMA)
    assert scans.within_budget(df, ["k"], ["at"], F.col("v"), 9).collect() == [] == scans.running_sum(df, [], ["at"], F.col("v"), "s").collect()


def test_bins_equal_a_walk(spark):
    rnd = random.Random(4)
    rows = [(f"k{i % 7}", i, rnd.choice([None, 0, 0, 1, 40, 99, 100, 101, 350])) for i in range(900)]
    want = []
    for k, own in walk(rows).items():
        number = used = 0
        for at, v in own:
            n = v or 0
            if used > 0 and used + n > 100:
                number, used = number + 1, 0
            used += n
            want.append((k, at, number))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")  # bins go on from batch to batch
    out = got(runs.greedy_bins(spark.createDataFrame(rows, SCHEMA).repartition(5), ["k"], "at", "v", 100), "bin")
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert out == sorted(want, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_page_bins_equal_a_walk(spark, seed):
    rnd = random.Random(seed)
    rows = [(f"k{i % 5}", i, rnd.choice([None, 0, 2, 9, 30]), rnd.choice([0, 1, 5])) for i in range(700)]
    want = []
    for k in {r[0] for r in rows}:
        number, pages, sums = 0, 0, [0, 0]
        for _, at, *counts in sorted((r for r in rows if r[0] == k), key=lambda r: r[1]):
            counts = [c or 0 for c in counts]
            grown = [x + c for x, c in zip(sums, counts)]
            if pages >= 3 and (pages >= 8 or grown[0] > 40 or grown[1] > 12):
                number, pages, grown = number + 1, 0, counts
            pages, sums = pages + 1, grown
            want.append((k, at, number))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "29")
    df = spark.createDataFrame(rows, "k string, at int, a int, b int").repartition(4)
    out = got(runs.page_bins(df, ["k"], "at", {"a": 40, "b": 12}, 3, 8), "bin")
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert out == sorted(want, key=str)


def test_touching_equals_loops(spark, monkeypatch):
    """Ranges that touch are one, with copies and without a start; tasks grow in number with the rows and none hashes them."""
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 6), rnd.choice([None, "a", "b"]), v, v + 1) for v in (rnd.randint(1, 12) for _ in range(120))] + [(1, "a", None, None)] * 2
    df = spark.createDataFrame(rows, "k int, s string, start int, stop int")
    want = set()
    for key in {r[:2] for r in rows}:
        own = {r[2] for r in rows if r[:2] == key}
        if None in own:
            want.add((*key, None, None))
            own.discard(None)
        for v in own:
            if v - 1 not in own:
                want.add((*key, v, next(e for e in range(v + 1, 99) if e not in own)))
    out = runs.touching(df, ["k", "s"], "start", "stop", rows=9)
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert out.rdd.getNumPartitions() == -(-len(rows) // 9) and "HashAggregate" not in out._jdf.queryExecution().toString()
