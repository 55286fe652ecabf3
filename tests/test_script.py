"""Kinds and signals of script lines against plain Python, and what long lines cost."""

import re

from pyspark.sql import functions as F

from scriptorium.functions import script as s
from scriptorium.functions import text as t


def test_kinds_of_odd_lines(spark):
    lines = ["", " ", "MARY", "MARY" + "Y" * 40, "CUT TO", "Cut to", "CUT TO " + "A" * 60, "all:", "ALL LIGHTS ON UNTIL THE NIGHT IS OVER AND BEYOND:", "12.", "INT. X", "(x", "ÄÖ", "ABCDe", "ABCDEf", "\t" * 90 + "A1", "A " * 60, "1 " * 24, "1 " * 26, "ß1" * 12]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k int, x string")
    share = lambda x: None if not (own := re.sub("[^A-Za-z]", "", x)) else len(re.sub("[^A-Z]", "", own)) / len(own)

    def kind(x, place):
        x = x.strip(" ")
        upper = (share(x) or 0) > s.UPPER_SHARE
        if re.search("^\\d{1,9}\\.?$", x):
            return "page_heading"
        if re.search(s.HEADING, x):
            return "scene_heading"
        if x.startswith("("):
            return "parenthetical"
        if upper and re.search(s.TRANSITION.replace("[^\\p{L}\\p{N}_]", "\\W"), x):
            return "transition"
        if upper and len(x) <= s.CUE_LENGTH:
            return "character" if place >= s.CUE_X else "format_marker"
        return "action"

    for place in (0.0, 300.0):
        got = [r[1:] for r in sorted(rows.select("k", t.upper_share(F.col("x")), s.entry_kind(F.col("x"), F.lit(place))).collect())]
        assert got == [(share(x), kind(x, place)) for x in lines]
    short = [len(re.sub(r"\s+", " ", x).strip(" ")) <= s.SHAPE_LENGTH and re.sub(r"\s+", " ", x).strip(" ") for x in lines]
    got = [r[1] for r in sorted(rows.select("k", s.structural_shape(F.col("x"))).collect())]
    assert [bool(x and re.search(s.SHAPE, x)) for x in short] == [g and bool(x and re.search(s.SHAPE, x)) for g, x in zip(got, short)]
    assert got[15] and not got[16]


def test_letters_are_counted_by_runs_and_last(spark):
    plan = spark.range(1).select(s.entry_kind(F.col("id").cast("string"), F.lit(1.0)).alias("k"))._jdf.queryExecution().analyzed().toString()
    assert "[^A-Z]+" in plan and plan.index("CUT TO") < plan.index("[^A-Z]")
