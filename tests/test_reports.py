"""Report operators that SQL cannot express, and edge cases, against plain Python."""

import random

from scriptorium.plans import reports, summaries


def test_parenthesis_groups_match_a_loop(spark):
    rng = random.Random(7)
    rows = [(k, i, rng.choice(["a", "(a", "b)", "(c)", "((", "))", "（x", "", None])) for k in range(20) for i in range(30)]
    want = []
    for k in range(20):
        open_, groups = 0, []
        for i, text in [(i, x) for kk, i, x in rows if kk == k]:
            if open_ > 0:
                groups[-1][1] += 1
            else:
                groups.append([i, 1])
            b = (text or "").count("(") + (text or "").count("（") - (text or "").count(")") - (text or "").count("）")
            open_ = max(open_ + b, 0)
        want += [(k, a, n) for a, n in groups]
    df = spark.createDataFrame(rows, "k long, i long, text string").fillna("", ["text"])
    got = reports.parenthesis_groups(df, ["k"], "i", "text").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_uncovered_with_short_and_empty_items(spark):
    items = spark.createDataFrame([(1, "a b"), (2, "one two  three four"), (3, "zz"), (4, ""), (5, None), (6, "x"), (7, "two three four five six")], "id int, text string")
    texts = spark.createDataFrame([("none two three",), ("xone two three\nfourth, a b c",), ("",), (None,)], "text string")
    got = {r.id for r in summaries.uncovered(items, "id", texts).collect()}
    assert got == {3, 7}
