"""Batch files through the sources, the rules and the renderer."""

import json

from scriptorium.plans import rendering, rules
from scriptorium.sources import batches


def entry(k, **other):
    return {"id": f"e{k}", "type": "action", "pdf_page": 1, "display_page": 1, "source": f"source {k}", "translation": f"译文{k} __name__"} | other


def folder(tmp_path):
    good = {"version": 1, "batch_id": "good", "source_pages": {"start": 1, "end": 2}, "has_subtitles": True, "title": "A & B", "front_matter": [entry(0, type="note")], "entries": [entry(1, type="scene_heading", markers=[{"type": "scene_no", "text": "1", "scene_no": "1"}]), entry(2, type="dialogue", subtitle_label="字幕匹配", display_page=2)]}
    bad = {"version": 2, "batch_id": " ", "source_pages": {"start": 3, "end": 2}, "has_subtitles": False, "entries": [
        entry(1, type="odd"), entry(1, subtitle_label="字幕未见", subtitle_start=-1.0, subtitle_end=-2.0, type="dialogue"), entry(3, markers=[{"type": "scene_no", "text": ""}, {"type": "x", "text": "y"}]),
        entry(4, translation="待译对白：x"), entry(5, translation="abc CUT TO: def", source="s *"), entry(6, translation="same same same", source="s *"), entry(7, translation="same  samesame", source="x" * 90 + " *"), entry(8, layout={"type": "parallel_dialogue", "source_entry_ids": ["e1"], "columns": [{"speaker": "", "lines": ["a", " "]}]}),
    ]}
    for name, doc in (("translated-p001-002", good), ("translated-p003", bad), ("translated-p009", {"batch_id": "none", "version": 1, "source_pages": {"start": 1, "end": 1}, "entries": []})):
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, ensure_ascii=False))
    (tmp_path / "translated-p010.json").write_text("{not json")
    return str(tmp_path)


def test_rules(spark, tmp_path):
    read = batches.read_batches(spark, folder(tmp_path), "translated-*.json")
    assert read.filter("damaged is not null").count() == 1
    found = {}
    for r in rules.validate(read, True, "path").collect():
        found.setdefault(r.path.rsplit("/", 1)[1][:-5], set()).add((r.code.removeprefix("batch."), r.message))
    assert found["translated-p001-002"] == {("final.subtitle_labels", "字幕匹配=1")}
    assert {c for c, _ in found["translated-p009"]} == {"entries"}
    assert found["translated-p003"] == {
        ("version", "version must be 1"), ("batch_id", "batch_id missing"), ("source_pages_range", "start=3 end=2"), ("entry_kind", "e1"), ("entry_id_duplicate", "e1"), ("subtitle_without_source", "e1"), ("subtitle_timestamp_without_source", "e1"),
        ("subtitle_timestamp_unseen", "e1"), ("subtitle_start", "e1"), ("subtitle_end", "e1"), ("subtitle_time_range", "e1"), ("marker_text", "e3"), ("marker_type", "e3"), ("marker_scene_no", "e3"), ("final.placeholder_translation", "e4"), ("final.raw_format_marker", "e5"),
        ("final.revision_asterisk_missing", "e5"), ("final.revision_asterisk_missing", "e6"), ("final.revision_asterisk_missing", "e7"), ("final.adjacent_duplicate_translation", "e1,e1"), ("final.adjacent_duplicate_translation", "e6,e7"), ("final.short_action_translation", "e7"), ("final.subtitle_labels", "字幕未见=1"),
        ("layout_parallel_columns", "e8"), ("layout_parallel_speaker", "e8"), ("layout_parallel_line", "e8"),
    }
    assert {r.state for r in rules.severity(rules.validate(read, True, "path"), "path").collect()} == {"FAIL", "PASS"}
    assert batches.has_failures(rules.validate(read, False, "path"))


def test_render_and_sinks(spark, tmp_path):
    read = batches.read_batches(spark, folder(tmp_path), "translated-p001-002.json")
    rows = batches.entries(read).crossJoin(read.select("title"))
    html = rendering.documents(rows, "batch_id", "title").head().html
    assert html.startswith("<!DOCTYPE html>") and "<title>A &amp; B</title>" in html
    assert '<li><a href="#e1">译文1 __name__</a></li>' in html
    assert html.index('id="e0"') < html.index('id="e1"') < html.index('id="page-2"') < html.index('id="e2"')
    assert '<span class="marker scene-no">1</span>译文1 <span class="proper-name">name</span>' in html and '<span class="label match">' in html
    found = rules.validate(read, True)
    batches.write_report(found, str(tmp_path / "report"))
    assert [r.value for r in spark.read.text(str(tmp_path / "report")).collect()] == ["INFO batch.final.subtitle_labels 字幕匹配=1"]
    batches.write_json(found, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 1


def test_markdown_and_other_sources(spark, tmp_path):
    text = "# T & x\n\none **two**\nthree\n- a\n- b\n\n| A | B |\n|---|---|\n| 1 | 2 |\n1. n"
    got = {r.k: r.html for r in rendering.markdown(spark.createDataFrame([(1, text), (2, ""), (3, None)], "k int, m string"), "k", "m").collect()}
    assert got == {1: "<h1>T &amp; x</h1><p>one <strong class=\"emphasis\">two</strong> three</p><ul><li>a</li><li>b</li></ul><table><tr><td>A</td><td>B</td></tr><tr><td>1</td><td>2</td></tr></table><ol><li>n</li></ol>", 2: "", 3: ""}
    (tmp_path / "source-markers.json").write_text(json.dumps({"version": 1, "known_markers": [{"type": "more", "text": "(MORE)"}]}))
    (tmp_path / "source-lines.json").write_text(json.dumps({"version": 1, "rows": [{"pdf_page": 1, "text": "a"}, {"pdf_page": 1, "text": "b", "x": 3}]}))
    events = [{"start": 0, "end": 1, "text": "t", "type": "Note"}, {"start": 1, "end": 2, "text": "u", "annotation": " v "}, {"start": 2, "end": 3, "text": "w"}]
    (tmp_path / "subtitles.json").write_text(json.dumps({"version": 1, "events": events}))
    at = str(tmp_path)
    assert [r.type for r in batches.read_markers(spark, at).collect()] == ["more"]
    assert [(r.line_no, r.text, r.x) for r in batches.read_lines(spark, at).orderBy("line_no").collect()] == [(0, "a", None), (1, "b", 3.0)]
    assert sorted(r.text for r in batches.annotations(batches.read_events(spark, at)).collect()) == ["t", "v"]
    (tmp_path / "modes.md").write_text("## FM-001 x\ntext\n## FM-002\n### FM-003\n## FM-001")
    assert sorted(r.failure_mode for r in batches.failure_modes(batches.files(spark, at, "*.md")).collect()) == ["FM-001", "FM-002"]
