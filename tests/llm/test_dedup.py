import hashlib
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from scriptorium.llm import common, exact_dedup, simhash


def test_golomb_round_trip():
    rnd = np.random.default_rng(1)
    for bits in (1, 8, 20, 40, 63):
        for n in (0, 1, 2, 1000):
            v = np.unique(rnd.integers(0, 1 << bits, n, dtype=np.uint64))
            code = exact_dedup.golomb_encode(v, bits)
            assert (exact_dedup.golomb_decode(code) == v).all()
    v = np.unique(rnd.integers(0, 1 << 30, 10_000, dtype=np.uint64))
    assert len(exact_dedup.golomb_encode(v, 30)) < 2.5 * len(v)


def test_exact_duplicates(docs, none, rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    want = []
    for r in rows:
        ids = groups[r[1] or ""]
        keep = max((i for i in ids if i is not None), default=None)
        want.append((r[0], keep, len(ids), r[0] == keep, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert sorted(map(tuple, exact_dedup.exact_duplicates(docs).collect()), key=str) == sorted(want, key=str)
    assert exact_dedup.exact_duplicates(none).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_exact_duplicates_without_broadcast(docs, monkeypatch):
    want = sorted(map(str, exact_dedup.exact_duplicates(docs).collect()))
    for module in (exact_dedup, common):
        monkeypatch.setattr(module, "BROADCAST_LIMIT", -1)
    monkeypatch.setattr(common, "HOT_CLASSES", 12)  # some classes are hot, others not
    assert sorted(map(str, exact_dedup.exact_duplicates(docs).collect())) == want


def test_only_suspects_leave_their_task(spark, docs, monkeypatch):
    """Beyond what may be broadcast, the bitmap sifts texts below the exchange, and loses no suspect."""
    monkeypatch.setattr(exact_dedup, "BROADCAST_LIMIT", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("body")).withColumn("h", F.xxhash64("body"))
        suspects = common.Written(base.groupBy("h").count().filter("count > 1").select("h"), "test")
        found = exact_dedup.suspicious(base, suspects)
        plan = plan_of(found)
        left = plan[plan.index("LeftSemi") :]
        assert left.index("Exchange hashpartitioning(h") < left.index("ArrowEvalPython") < left.rindex("Exchange hashpartitioning(h")
        want = base.groupBy("h").count().filter("count > 1").agg(F.sum("count")).first()[0]
        assert found.count() == want > 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_near_duplicates_without_broadcast(docs, monkeypatch):
    want = sorted(map(str, simhash.near_duplicates(docs).collect()))
    monkeypatch.setattr(common, "BROADCAST_LIMIT", -1)
    monkeypatch.setattr(common, "HOT_CLASSES", 12)
    assert sorted(map(str, simhash.near_duplicates(docs).collect())) == want


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def plain_components(prints):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_fingerprints_in_blocks(monkeypatch):
    text = "One two\tthree  four FIVE six seven\x0beight nine ten " * 9
    want = plain_fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 7)
    assert simhash.fingerprint(text) == want
    assert [simhash.fingerprint(t) for t in (None, "", " \n", "a", "a B")] == [plain_fingerprint(t) for t in (None, "", " \n", "a", "a B")]


def test_near_duplicates(docs, none, rows):
    prints = [plain_fingerprint(r[1]) for r in rows]
    of = plain_components(prints)
    least = {}
    for r, c in zip(rows, of):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    want = sorted((str(r[0]), f"{p:016x}", least.get(c)) for r, p, c in zip(rows, prints, of))
    got = sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    assert got == want
    assert simhash.near_duplicates(none).count() == 0


def test_links_and_components_of_planted_chains(spark):
    rnd = random.Random(2)
    prints = {rnd.getrandbits(64) for _ in range(300)}
    for start in [rnd.getrandbits(64) for _ in range(6)]:
        for _ in range(60):
            start ^= 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64)
            prints.add(start)
    base = rnd.getrandbits(64)
    prints |= {base ^ (x << 16) for x in range(0, 60_000, 7)}  # one posting with thousands of entries
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"))
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    v = np.array(prints, np.uint64)
    label = np.arange(len(v))
    while True:
        new = label.copy()
        for at in range(0, len(v), 512):
            near = np.bitwise_count(v[at : at + 512, None] ^ v[None, :]) <= 2
            new[at : at + 512] = np.where(near, label[None, :], len(v)).min(axis=1)
        if (new == label).all():
            break
        label = new
    mine = [roots.get(s, s) for s in signed]
    assert len(set(zip(mine, label.tolist()))) == len(set(mine)) == len(set(label.tolist()))
