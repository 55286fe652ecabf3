"""The filter audit against filters applied one after the other, order by order."""

import itertools
import random
import re
from collections import Counter

import pytest

from scriptorium.llm import common
from scriptorium.llm.filter_audit import audit

LABELS = "doc_id long, quality int, toxic int, bits int, part string"


def plain(rows, labels):
    """Rows as tuples (doc_id, text, source): every order walked, document by document."""
    docs = [(i, t or "", s or "") for i, t, s in rows]
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t] = min(first.get(t, i), i)
    good = {i for i, q, *_ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x, *_ in labels if x == 1 and i is not None}

    def fails(i, t):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        hit = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and t in first and i > first[t]}
        return {k for k, v in hit.items() if v}

    out, shapley = {}, Counter()
    for i, t, part in docs:
        failed = fails(i, t)
        for order in itertools.permutations("ABCDE"):
            gone = False
            for step, f in enumerate(order):
                own = out.setdefault((part, "".join(order), step + 1), [0] * 6)
                own[3] += failed == {f}
                if f in failed and gone:
                    own[2] += 1
                elif f in failed:
                    own[1] += 1
                    own[4] += i in good
                    own[5] += i in toxic
                    shapley[part, f] += 1
                    gone = True
                elif not gone:
                    own[0] += 1
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def texts():
    rnd = random.Random(11)
    words = [f"w{k}" for k in range(400)]
    long = " ".join(words[:230])
    rows = [(k, " ".join(rnd.choices(words if k % 3 else words[:60], k=rnd.choice([30, 210, 260]))) + rnd.choice(["", "", " AB CD " * 20, " # | "]), f"s{k % 3}") for k in range(60)]
    rows += [(k, long, "s0") for k in range(100, 190)]  # one group of copies holds a third of all rows
    rows += [(200, None, None), (201, "", "s1"), (202, " \t\r\n\v\f", ""), (203, "É" * 99 + "ABZ", "s1"), (204, "a b " * 300, "s2"), (None, long, "s2"), (None, "alone # " * 3, None)]
    rows += [(100, long, "s1"), (150, long, "s0"), (150, long, "s0"), (300, "x y" * 200_000, "s9"), (7, "other text of id 7", "s0")]
    labels = [(k, k % 2, (k // 2) % 2) for k in range(0, 200, 3)] + [(6, 1, 1), (6, 0, None), (9, None, None), (None, 1, 1), (999, 1, 1)]
    return rows, labels


@pytest.mark.parametrize("limit", [common.BROADCAST_LIMIT, 0])
def test_equals_orders_walked_one_by_one(spark, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_LIMIT", limit)
    rows, labels = texts()
    docs = spark.createDataFrame([(*r, True, 1, "x") for r in rows], "doc_id long, text string, source string, good boolean, bits int, sha string").repartition(6)
    marks = spark.createDataFrame([(*r, 3, "p") for r in labels], LABELS)
    got = sorted(tuple(r) for r in audit(docs, marks).collect())
    assert got == plain(rows, labels)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id int, text string, source string")
    marks = spark.createDataFrame([], LABELS)
    assert audit(docs, marks).collect() == []
    one = spark.createDataFrame([(1, "a", None)], "doc_id int, text string, source string")
    got = [tuple(r) for r in audit(one, marks).collect()]
    assert sorted(got) == plain([(1, "a", None)], []) and len(got) == 600


def test_one_of_many_partitions_is_enough(spark):
    rows, labels = texts()
    make = lambda n: sorted(tuple(r) for r in audit(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(n), spark.createDataFrame([(*r, 0, "") for r in labels], LABELS)).collect())
    assert make(1) == make(17)
