"""Parsers of the sources as queries: files are written as text from the tables, then read back by the parsers."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import text as t
from scriptorium.sources import batches, captions, pdf
from scriptorium.sources.tables import LINES, lines, table

QUERIES, SQL = {}, {}


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return register


def _files(rows, key: str, order: str, line, glue: str, head: str = ""):
    """One text file per key, its rows in order."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct(order, line.alias("line")))), lambda x: x["line"])
    return rows.groupBy(F.col(key).cast("string").alias("path")).agg(F.concat(F.lit(head), F.array_join(parts, glue)).alias("text"))


_CLEAN = "trim(regexp_replace(regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '\\{[^}]*\\}|<[^>]*>', '', 'g'), '\\s+', ' ', 'g'))"


@query("S10_cues", f"SELECT CAST(conv_id AS VARCHAR) AS path, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS event_index, CAST(turn AS DOUBLE) AS start_s, turn + 10.5e0 AS end_s, {_CLEAN} AS text FROM conversations")
def s10(spark, d):
    at = F.lpad(F.col("turn").cast("string"), 2, "0")
    until = F.lpad((F.col("turn") + 10).cast("string"), 2, "0")
    cue = F.concat(F.col("turn").cast("string"), F.lit("\n00:00:"), at, F.lit(",000 --> 00:00:"), until, F.lit(",500\n"), t.collapse_space(F.col("text")))
    events = captions.parse_cues(_files(table(spark, d, "conversations"), "conv_id", "turn", cue, "\n\n", "WEBVTT\n\n"))
    return events.select("path", "event_index", F.col("start").alias("start_s"), F.col("end").alias("end_s"), "text")


@query("S09_ass_events", f"SELECT CAST(conv_id AS VARCHAR) AS path, CAST(turn AS DOUBLE) AS start_s, turn + 10.5e0 AS end_s, {_CLEAN} AS text, role = 'system' AS annotation FROM conversations")
def s09(spark, d):
    style = F.when(F.col("role") == "system", "Notes").otherwise("Main")
    event = F.concat(F.lit("Dialogue: 0:00:"), F.lpad(F.col("turn").cast("string"), 2, "0"), F.lit(".00,0:00:"), (F.col("turn") + 10).cast("string"), F.lit(".50,"), style, F.lit(","), t.collapse_space(F.col("text")))
    events = captions.parse_ass(_files(table(spark, d, "conversations"), "conv_id", "turn", event, "\n", "[Script Info]\nTitle: x\n[Events]\nFormat: Start, End, Style, Text\n"))
    return events.select("path", F.col("start").alias("start_s"), F.col("end").alias("end_s"), "text", "annotation")


@query("S16_terms", "SELECT CAST(n_regionkey AS VARCHAR) AS path, n_name AS source, CAST(n_nationkey AS VARCHAR) AS target FROM nation")
def s16(spark, d):
    row = F.concat(F.lit("| "), F.col("n_name"), F.lit(" | "), F.col("n_nationkey").cast("string"), F.lit(" |"))
    return captions.parse_terms(_files(table(spark, d, "nation"), "n_regionkey", "n_nationkey", row, "\n", "# Terms\n| English | Chinese |\n| --- | --- |\n")).select("path", "source", "target")


@query("S18_config", "SELECT CAST(n_regionkey AS VARCHAR) AS path, 'names' AS section, 'n' || n_nationkey AS key, n_name AS value FROM nation")
def s18(spark, d):
    line = F.concat(F.lit("  n"), F.col("n_nationkey").cast("string"), F.lit(": '"), F.col("n_name"), F.lit("' # a name"))
    return captions.parse_config(_files(table(spark, d, "nation"), "n_regionkey", "n_nationkey", line, "\n", "# made\nnames:\n"))


@query("S21_page_ranges", "SELECT 'translated-p' || printf('%03d', conv_id) || CASE WHEN turn > 0 THEN '-' || printf('%03d', conv_id + turn) ELSE '' END || '.json' AS path, CAST(conv_id AS INTEGER) AS start, CAST(conv_id + turn AS INTEGER) AS stop FROM conversations")
def s21(spark, d):
    pad = [F.format_string("%03d", c) for c in (F.col("conv_id"), F.col("conv_id") + F.col("turn"))]
    name = F.concat(F.lit("translated-p"), pad[0], F.when(F.col("turn") > 0, F.concat(F.lit("-"), pad[1])).otherwise(""), F.lit(".json"))
    return captions.page_ranges(table(spark, d, "conversations").select(name.alias("path")))


@query("S26_report_lines", f"SELECT level, count(*) AS n FROM (SELECT regexp_extract(trim(line), '^[^\\s]*') AS level FROM {LINES}) GROUP BY level")
def s26(spark, d):
    found = lines(spark, d).select(captions.parse_findings(F.col("line")).alias("f"))
    return found.groupBy(F.col("f.level").alias("level")).agg(F.count("*").alias("n"))


@query("S28_annotations", "SELECT CAST(conv_id AS VARCHAR) AS path, turn AS event_index, trim(text) AS text FROM conversations WHERE role = 'system' AND trim(text) <> '' UNION ALL SELECT CAST(conv_id AS VARCHAR), turn, 'noted' FROM conversations WHERE role <> 'system' AND turn = 1")
def s28(spark, d):
    kind = F.when(F.col("role") == "system", "Note")
    noted = F.when((F.col("role") != "system") & (F.col("turn") == 1), " noted ")
    events = table(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("path"), F.col("turn").alias("event_index"), kind.alias("type"), "text", noted.alias("annotation"))
    return batches.annotations(events)


@query("S08_pdf_lines", "SELECT path, CAST(k // 40 + 1 AS INTEGER) AS pdf_page, CAST(k % 40 AS INTEGER) AS line_no, w AS text FROM (SELECT CAST(item_id AS VARCHAR) AS path, unnest(range(len(x))) AS k, unnest(x) AS w FROM (SELECT item_id, regexp_extract_all(text, '[A-Za-z]{2,}') AS x FROM benchmark))")
def s08(spark, d):
    """A file per item with one word a line and a new page after 40 lines (what a page holds)."""
    words = F.regexp_extract_all("text", F.lit("[A-Za-z]{2,}"), F.lit(0))
    pages = F.sequence(F.lit(0), F.greatest(F.lit(0), F.expr("(size(words) - 1) div 40").cast("int")))

    def page(p):
        shown = F.transform(F.slice(F.col("words"), p * 40 + 1, 40), lambda w: F.concat(F.lit("("), w, F.lit(") Tj 0 -12 Td")))
        head = F.format_string("%d 0 obj << /Type /Page /Contents %d 0 R >> endobj\n%d 0 obj << >>\nstream\nBT 1 0 0 1 100 700 Tm ", 2 * p + 1, 2 * p + 2, 2 * p + 2)
        return F.concat(head, F.array_join(shown, " "), F.lit(" ET\nendstream\nendobj\n"))

    items = table(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("path"), words.alias("words"))
    files = items.select("path", F.concat(F.lit("%PDF-1.4\n"), F.array_join(F.transform(pages, page), ""), F.lit("%%EOF")).cast("binary").alias("content"))
    return pdf.source_lines(pdf.text_rows(pdf.parse(files))).select("path", "pdf_page", "line_no", "text")


def caption_artifacts(events: DataFrame) -> DataFrame:
    """Events of each caption file as one JSON text, in their order: ``path, json``."""
    event = F.struct("event_index", F.struct("start", "end", "text").alias("event"))
    listed = F.transform(F.array_sort(F.collect_list(event)), lambda x: x["event"])
    return events.groupBy("path").agg(listed.alias("events")).select("path", F.to_json(F.struct(F.lit(1).alias("version"), F.col("path").alias("source"), "events")).alias("json"))


@query("O07_stored_captions", f"SELECT CAST(conv_id AS VARCHAR) AS path, '{{\"version\":1,\"source\":\"' || conv_id || '\",\"events\":[' || string_agg('{{\"start\":' || CAST(turn AS DOUBLE) || ',\"end\":' || (turn + 10.5e0) || ',\"text\":' || to_json({_CLEAN}) || '}}', ',' ORDER BY turn) || ']}}' AS json FROM conversations GROUP BY conv_id")
def o07(spark, d):
    at, until = (F.lpad(x.cast("string"), 2, "0") for x in (F.col("turn"), F.col("turn") + 10))
    cue = F.concat(F.col("turn").cast("string"), F.lit("\n00:00:"), at, F.lit(",000 --> 00:00:"), until, F.lit(",500\n"), t.collapse_space(F.col("text")))
    return caption_artifacts(captions.parse_cues(_files(table(spark, d, "conversations"), "conv_id", "turn", cue, "\n\n", "WEBVTT\n\n")))


_SUFFIX = "CASE conv_id % 5 WHEN 0 THEN '.ass' WHEN 1 THEN '.SRT' WHEN 2 THEN '.vtt' WHEN 3 THEN '.txt' ELSE '' END"


@query("S11_caption_files", f"SELECT path, count(*) AS n_events, CAST(NULL AS VARCHAR) AS unsupported FROM (SELECT conv_id || {_SUFFIX} AS path, conv_id FROM conversations) WHERE conv_id % 5 < 3 GROUP BY path UNION ALL SELECT DISTINCT conv_id || {_SUFFIX}, 0, lower({_SUFFIX}) FROM conversations WHERE conv_id % 5 >= 3")
def s11(spark, d):
    """Captions in three formats, told by the suffix of their files; other files are named and give no event."""
    rows = table(spark, d, "conversations").withColumn("is_ass", F.col("conv_id") % 5 == 0)
    at = F.lpad(F.col("turn").cast("string"), 2, "0")
    until = F.lpad((F.col("turn") + 10).cast("string"), 2, "0")
    cue = F.concat(F.lit("00:00:"), at, F.lit(".000 --> 00:00:"), until, F.lit(".500\n"), t.collapse_space(F.col("text")))
    event = F.concat(F.lit("Dialogue: 0:00:"), at, F.lit(".00,0:00:"), until, F.lit(".50,Main,"), t.collapse_space(F.col("text")))
    files = _files(rows.filter("is_ass"), "conv_id", "turn", event, "\n", "[Events]\nFormat: Start, End, Style, Text\n").unionAll(_files(rows.filter(~F.col("is_ass")), "conv_id", "turn", cue, "\n\n", "WEBVTT\n\n"))
    named = files.withColumn("path", F.concat("path", F.expr(_SUFFIX.replace("conv_id", "cast(path as bigint)"))))
    events = captions.parse_captions(named).groupBy("path").agg(F.count("*").alias("n_events"), F.lit(None).cast("string").alias("unsupported"))
    return events.unionByName(captions.unsupported(named).select("path", F.lit(0).cast("long").alias("n_events"), F.col("suffix").alias("unsupported")))


@query(
    "P13_annotation",
    f"SELECT CAST(conv_id AS VARCHAR) AS path, CAST(turn AS DOUBLE) AS start_s, turn % 7 IN (1, 2, 3, 4, 5) AS annotation, {_CLEAN} AS text FROM conversations",
)
def p13(spark, d):
    """An event is an annotation by its style's name, its own name, its style's alignment, its margin, or a mark in its text."""
    n = F.col("turn") % 7
    at = F.lpad(F.col("turn").cast("string"), 2, "0")
    style = F.when(n == 1, "Margin Notes").when(n == 2, "Top").otherwise("Main")
    name = F.when(n == 3, "comment").otherwise("ANNA")
    margin = F.when(n == 4, "20").when(n == 6, "19").otherwise("0")
    mark = F.when(n == 5, "{\\an8}").otherwise("{\\an2}")
    event = F.concat(F.lit("Dialogue: 0:00:"), at, F.lit(".00,0:01:00.00,"), style, F.lit(","), name, F.lit(","), margin, F.lit(","), mark, t.collapse_space(F.col("text")))
    head = "[V4+ Styles]\nFormat: Name, Alignment\nStyle: Main,2\nStyle: Top,8\nStyle: Margin Notes,2\n[Events]\nFormat: Start, End, Style, Name, MarginV, Text\n"
    events = captions.parse_ass(_files(table(spark, d, "conversations"), "conv_id", "turn", event, "\n", head))
    return events.select("path", F.col("start").alias("start_s"), "annotation", "text")
