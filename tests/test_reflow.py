"""Display units on a small script: which entries merge, which keep their line."""

from pyspark.sql import functions as F

from scriptorium.operators import reflow as r

FIELDS = "doc int, at int, id string, kind string, source string, translation string, label string, page int, n_markers int, preserve_line_breaks boolean, reflow boolean, has_layout boolean, hidden boolean"


def entry(at, kind, translation="t", source="s", label=None, page=12, markers=0, keep=None, reflow=None, layout=None, hidden=None):
    return (1, at, f"r{at:03d}", kind, source, translation, label, page, markers, keep, reflow, layout, hidden)


def units(spark, rows):
    df = spark.createDataFrame(rows, FIELDS)
    df = df.withColumn("kept", r.protected({c: F.col(c) for c in df.columns}))
    return [(u.type, u.ids, u.text) for u in r.display_units(df, ["doc"], "at").orderBy("first").collect()]


def test_what_merges(spark):
    rows = [
        entry(0, "scene_heading"), entry(1, "action", "一个《"), entry(2, "action", "检查》 "), entry(3, "character"), entry(4, "dialogue", "甲", label="字幕匹配"),
        entry(5, "dialogue", "乙", label="字幕匹配"), entry(6, "character"), entry(7, "dialogue", "丙", label="字幕差异"), entry(8, "dialogue", "丁", label="字幕未见"),
        entry(9, "action", "- 一"), entry(10, "action", "二"), entry(11, "action", "三", page=13),
    ]
    got = units(spark, rows)
    assert [u[1] for u in got] == ["r000", "r001,r002", "r003", "r004,r005", "r006", "r007", "r008", "r009,r010", "r011"]
    assert got[1] == ("prose", "r001,r002", "一个《检查》") and got[3] == ("dialogue", "r004,r005", "甲乙")


def test_each_of_the_eight_tests_keeps_a_line(spark):
    odd = [
        entry(1, "note"), entry(1, "action", markers=2), entry(1, "action", "x [[*]] "), entry(1, "action", keep=True), entry(1, "action", reflow=False),
        entry(1, "action", "1) x"), entry(1, "dialogue", "- x"), entry(1, "action", source="Title: x"), entry(1, "action", "on screen"), entry(1, "action", "♪ la"), entry(1, "action", "a\nb"), entry(1, "action", layout=True),
    ]
    for e in odd:
        got = units(spark, [entry(0, "action"), e, entry(2, "action")])
        assert [u[0] for u in got] == ["prose", "protected", "prose"], e
    for e in (entry(1, "action", "- x"), entry(1, "action", "Titled x", "subtitled"), entry(1, "action", reflow=True), entry(1, "action", "a \n"), entry(1, "action", None, None), entry(1, "action", hidden=True)):
        assert len(units(spark, [entry(0, "action"), e, entry(2, "action")])) == 1, e
    assert units(spark, []) == []
