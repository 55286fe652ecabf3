"""Caption, term, report and configuration sources on small files of our own."""

import pytest

from pyspark.sql import functions as F

from scriptorium.functions import script
from scriptorium.sources import captions

SRT = "1\r\n00:00:01,500 --> 00:00:02,000\r\n<i>First</i>\r\nline\r\n\r\n2\r\n00:00:03,000 --> 00:00:04,000\r\nSecond\r\n"
VTT = "WEBVTT\n\nNOTE a remark\n\n01:02.500 --> 01:03.000 align:left\nShort form\n\n00:01:04.000 --> 00:01:05.000\n\n"
ASS = """[Script Info]
Title: own

[V4+ Styles]
Format: Name, Fontname, Alignment
Style: Default,Sans,2
Style: Top,Sans,8

[Events]
Format: Layer, Start, End, Style, Name, MarginV, Text
Dialogue: 0,0:00:01.00,0:00:02.50,Default,,0,Hello\\Nthere, {\\b1}you
Dialogue: 0,0:00:03.00,0:00:04.00,Top,,0,Sign
Dialogue: 0,0:00:05.00,0:00:06.00,Default,,30,Low sign
Comment: 0,0:00:05.00,0:00:06.00,Default,,0,not spoken
"""


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("captions")
    for name, text in (("a.srt", SRT), ("b.vtt", VTT), ("c.ass", ASS), ("d.txt", "not read")):
        (path / name).write_bytes(text.encode())
    return str(path)


def test_captions(spark, folder):
    rows = captions.read_captions(spark, folder).orderBy("path", "event_index").collect()
    got = [(r["path"][-5:], r["event_index"], r["start"], r["end"], r["text"], r["annotation"]) for r in rows]
    assert got == [
        ("a.srt", 0, 1.5, 2.0, "First line", False),
        ("a.srt", 1, 3.0, 4.0, "Second", False),
        ("b.vtt", 0, 62.5, 63.0, "Short form", False),
        ("b.vtt", 1, 64.0, 65.0, "", False),
        ("c.ass", 0, 1.0, 2.5, "Hello there, you", False),
        ("c.ass", 1, 3.0, 4.0, "Sign", True),
        ("c.ass", 2, 5.0, 6.0, "Low sign", True),
    ]


def test_file_sizes_and_ranges(spark, folder):
    assert {r["path"][-5:]: r["bytes"] for r in captions.file_sizes(spark, folder, "*.srt").collect()} == {"a.srt": len(SRT)}
    paths = spark.createDataFrame([("x/translated-p001-012.json",), ("x/translated-p013.json",), ("x/other.json",)], "path string")
    assert sorted((r["start"], r["stop"]) for r in captions.page_ranges(paths).collect()) == [(1, 12), (13, 13)]


def test_terms(spark):
    text = "# Terms\n| Source | Target | Notes |\n| --- | :-: | --- |\n| lamp | Lampe | |\n| sea | Meer |\ntext"
    rows = captions.parse_terms(spark.createDataFrame([("a", text)], "path string, text string")).orderBy("line_no").collect()
    assert [(r["source"], r["target"], r["notes"]) for r in rows] == [("lamp", "Lampe", ""), ("sea", "Meer", "")]


def test_config(spark):
    text = "title: 'A # B'\nplain: x # remark\ninputs:\n  pdf: a.pdf\n  none: null\n"
    rows = captions.parse_config(spark.createDataFrame([("a", text)], "path string, text string")).collect()
    got = {(r["section"], r["key"]): r["value"] for r in rows}
    assert got[(None, "plain")] == "x" and got[("inputs", "pdf")] == "a.pdf" and got[("inputs", "none")] is None


def test_findings_and_glyphs(spark):
    row = spark.createDataFrame([("FAIL a.b some  message", "ÕtisÉ")], "l string, g string").select(captions.parse_findings(F.col("l")).alias("f"), script.repair_glyphs(F.col("g")).alias("g")).first()
    assert tuple(row["f"]) == ("FAIL", "a.b", "some  message") and row["g"] == "’tis..."
