"""JSON and markdown artifacts as queries: made as texts from the tables, then read by the sources or shown by the renderer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import render
from scriptorium.plans import rendering
from scriptorium.sources import batches, books, captions
from scriptorium.sources.tables import table

QUERIES, SQL = {}, {}


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return register


def _json_files(rows, key: str, order: str, item, array) -> DataFrame:
    """A JSON text per key whose array (named by a column) holds its rows in order; every seventh text is damaged."""
    items = F.transform(F.array_sort(F.collect_list(F.struct(order, item.alias("item")))), lambda x: x["item"])
    body = F.concat(F.lit('{"version": 1, "source": "made", "'), array, F.lit('": '), F.to_json("items"), F.lit("}"))
    grouped = rows.groupBy(key).agg(items.alias("items"))
    return grouped.select(F.col(key).cast("string").alias("path"), F.when(F.col(key) % 7 == 0, "{not json").otherwise(body).alias("text"))


_NUMBER = "CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER)"


@query("S12_event_files", f"SELECT CAST(conv_id AS VARCHAR) AS path, {_NUMBER} AS event_index, CAST(turn AS DOUBLE) AS start_s, turn + 0.5e0 AS end_s, text, role AS type FROM conversations WHERE conv_id % 7 <> 0")
def s12(spark, d):
    event = F.struct(F.col("turn").cast("double").alias("start"), (F.col("turn") + 0.5).alias("end"), "text", F.col("role").alias("type"))
    events = batches.parse_events(_json_files(table(spark, d, "conversations"), "conv_id", "turn", event, F.lit("events")))
    return events.select("path", "event_index", F.col("start").alias("start_s"), F.col("end").alias("end_s"), "text", "type")


@query("S13_line_files", f"SELECT CAST(conv_id AS VARCHAR) AS path, {_NUMBER} AS line_no, CAST(turn + 1 AS INTEGER) AS pdf_page, text, turn * 36e0 AS x, CASE WHEN role = 'system' THEN 'margin' ELSE 'body' END AS zone FROM conversations WHERE conv_id % 7 <> 0")
def s13(spark, d):
    zone = F.when(F.col("role") == "system", "margin").otherwise("body")
    line = F.struct((F.col("turn") + 1).alias("pdf_page"), "text", (F.col("turn") * 36.0).alias("x"), zone.alias("zone"))
    return batches.parse_lines(_json_files(table(spark, d, "conversations"), "conv_id", "turn", line, F.lit("rows"))).select("path", "line_no", "pdf_page", "text", "x", "zone")


@query("S14_marker_files", f"SELECT CAST(conv_id AS VARCHAR) AS path, {_NUMBER} AS marker_no, 'scene_no' AS type, CAST(turn AS VARCHAR) AS scene_no, CAST(turn AS INTEGER) AS pdf_page FROM conversations WHERE conv_id % 7 <> 0")
def s14(spark, d):
    """Even files name their markers as older ones do."""
    marker = F.struct(F.lit("scene_no").alias("type"), F.col("turn").cast("string").alias("scene_no"), F.col("turn").alias("pdf_page"))
    name = F.when(F.col("conv_id") % 2 == 0, "known_markers").otherwise("markers")
    return batches.parse_markers(_json_files(table(spark, d, "conversations"), "conv_id", "turn", marker, name)).select("path", "marker_no", "type", "scene_no", "pdf_page")


@query("S15_optional_events", "SELECT role AS type, count(*) AS n FROM conversations WHERE conv_id % 7 <> 0 GROUP BY role")
def s15(spark, d):
    """Events of files that are there, and of none: the same columns either way."""
    event = F.struct("text", F.col("role").alias("type"))
    made = _json_files(table(spark, d, "conversations"), "conv_id", "turn", event, F.lit("events"))
    absent = batches.parse_events(made.filter("false"))
    return batches.parse_events(made).unionByName(absent).groupBy("type").agg(F.count("*").alias("n"))


@query("S20_batch_files", f"SELECT CAST(conv_id AS VARCHAR) AS path, conv_id % 7 = 0 AS is_damaged, CASE WHEN conv_id % 7 = 0 THEN 0 ELSE count(*) END AS n_entries FROM conversations GROUP BY conv_id")
def s20(spark, d):
    entry = F.struct(F.concat(F.lit("e"), F.col("turn").cast("string")).alias("id"), F.col("text").alias("source"))
    read = batches.parse_batches(_json_files(table(spark, d, "conversations"), "conv_id", "turn", entry, F.lit("entries")))
    return read.select("path", F.col("damaged").isNotNull().alias("is_damaged"), F.coalesce(F.size("entries"), F.lit(0)).cast("long").alias("n_entries"))


@query("P26_front_and_body", "SELECT CAST(conv_id AS VARCHAR) AS path, CASE WHEN role = 'system' THEN 'front' ELSE 'body' END AS part, row_number() OVER (PARTITION BY conv_id, role = 'system' ORDER BY turn) - 1 AS ordinal, text AS source FROM conversations")
def p26(spark, d):
    entry = F.struct(F.col("turn"), F.from_json(F.to_json(F.struct(F.col("text").alias("source"))), batches.ENTRY).alias("entry"))

    def own(condition):
        return F.transform(F.array_sort(F.collect_list(F.when(condition, entry)), lambda a, b: (a["turn"] - b["turn"]).cast("int")), lambda x: x["entry"])

    system = F.col("role") == "system"
    made = table(spark, d, "conversations").groupBy("conv_id").agg(own(system).alias("front_matter"), own(~system).alias("entries"))
    rows = batches.entries(made.select(F.col("conv_id").cast("string").alias("path"), F.lit(False).alias("has_subtitles"), "front_matter", "entries"), "path")
    return rows.select("path", "part", F.col("ordinal").cast("long").alias("ordinal"), "source")


_TERM_ROWS = "SELECT n_regionkey, n_nationkey // 2 AS term, n_name, row_number() OVER (PARTITION BY n_regionkey, n_nationkey // 2 ORDER BY n_nationkey DESC) AS k FROM nation"


@query("S17_first_terms", f"SELECT CAST(n_regionkey AS VARCHAR) AS path, 'term ' || term AS source, n_name AS target FROM ({_TERM_ROWS}) WHERE k = 1")
def s17(spark, d):
    """Two tables in a file, and a first table without the heading; terms come twice in some."""
    row = F.struct("n_nationkey", F.concat(F.lit("| term "), F.expr("n_nationkey div 2").cast("string"), F.lit(" | "), F.col("n_name"), F.lit(" |")).alias("row"))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["row"]), "\n")
    text = F.concat(F.lit("# Names\n| Other | Column |\n| --- | --- |\n| a | b |\n\n| English | Chinese |\n| --- | --- |\n"), rows, F.lit("\nafter\n| English | Chinese |\n| --- | --- |\n| late | row |\n"))
    return captions.parse_first_terms(table(spark, d, "nation").groupBy(F.col("n_regionkey").cast("string").alias("path")).agg(text.alias("text")))


@query("S25_failure_modes", "SELECT DISTINCT CAST(n_regionkey AS VARCHAR) AS path, 'FM-' || printf('%03d', n_nationkey // 2) AS failure_mode FROM nation")
def s25(spark, d):
    line = F.format_string("## FM-%03d %s\n### FM-999 no heading of this level\n", F.expr("n_nationkey div 2"), F.col("n_name"))
    texts = table(spark, d, "nation").groupBy(F.col("n_regionkey").cast("string").alias("path")).agg(F.array_join(F.collect_list(line), "").alias("text"))
    return batches.failure_modes(texts)


_TEXT = rendering._MARKED.format("text", "turn")


@query("R03_parallel", f"""SELECT conv_id, '<div class="grid">' || string_agg('<div><b>' || role || '</b>' || {rendering._paragraph('text')} || '</div>', '' ORDER BY turn) || '</div>' AS html FROM (SELECT conv_id, turn, role, {_TEXT} AS text FROM conversations) GROUP BY conv_id""")
def r03(spark, d):
    column = F.struct("turn", F.col("role").alias("speaker"), F.array(rendering.marked("text", "turn")).alias("lines"))
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(column)).alias("columns"))
    return rows.select("conv_id", render.parallel(F.col("columns")).alias("html"))


_SCENE_MARK = """'<span class="marker scene-no">' || turn || '</span>'"""


@query("R04_entry", f"""SELECT conv_id, turn, CASE WHEN role = 'system' THEN '' ELSE '<div class="entry ' || role || '" id="e' || turn || '">' || {rendering._paragraph('text', _SCENE_MARK)} || CASE WHEN turn = 1 THEN '<span class="label match">字幕匹配</span>' ELSE '' END || '</div>' END AS html FROM (SELECT conv_id, turn, role, CASE WHEN turn % 2 = 0 THEN {_TEXT} ELSE 'source' END AS text FROM conversations)""")
def r04(spark, d):
    """Odd entries have no translation and show their source; system entries are hidden."""
    marker = F.struct(F.lit("scene_no").alias("type"), F.col("turn").cast("string").alias("text"))
    row = {
        "id": F.concat(F.lit("e"), F.col("turn").cast("string")),
        "type": F.col("role"),
        "translation": F.when(F.col("turn") % 2 == 0, rendering.marked("text", "turn")).otherwise(" "),
        "source": F.lit("source"),
        "markers": F.array(marker),
        "subtitle_label": F.when(F.col("turn") == 1, "字幕匹配"),
        "layout": F.lit(None).cast(batches._LAYOUT),
        "layout_hidden": F.col("role") == "system",
    }
    return table(spark, d, "conversations").select("conv_id", "turn", render.entry(row).alias("html"))


@query("R09_markdown", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '<h2>' || p_name || '</h2>' WHEN 1 THEN '<ul><li>' || p_name || '</li><li>' || p_type || '</li></ul>' WHEN 2 THEN '<table><tr><td>' || p_name || '</td><td>' || p_brand || '</td></tr><tr><td>' || p_type || '</td><td>x</td></tr></table>' ELSE '<p>' || p_name || ' ' || p_type || '</p>' END AS html FROM part")
def r09(spark, d):
    kind = F.element_at(F.array(*map(F.lit, ("heading", "list", "table", "paragraph"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    part = table(spark, d, "part")
    bars = [F.concat(F.lit("| "), a, F.lit(" | "), b, F.lit(" |")) for a, b in ((F.col("p_name"), F.col("p_brand")), (F.col("p_type"), F.lit("x")))]
    lines = (
        F.when(kind == "heading", F.array(F.concat(F.lit("## "), "p_name")))
        .when(kind == "list", F.array(F.concat(F.lit("- "), "p_name"), F.concat(F.lit("2. "), "p_type")))
        .when(kind == "table", F.array(bars[0], F.lit("| --- | :-: |"), bars[1]))
        .otherwise(F.array("p_name", "p_type"))
    )
    return part.select("p_partkey", render.markdown_block(kind, lines).alias("html"))


_SCENE = "CASE WHEN turn % 2 = 0 THEN ' scene ' || turn ELSE '' END"


@query(
    "K04_epub",
    "SELECT CAST(conv_id AS VARCHAR) AS book, 'ok' AS state, 'cover.xhtml' || CASE WHEN min(turn) = 0 THEN ' reader-notes.xhtml' ELSE '' END || coalesce(string_agg(' chapter-' || printf('%03d', r), '.xhtml' ORDER BY r) FILTER (turn > 0) || '.xhtml', '') AS spine,"
    f" '封面' || CASE WHEN min(turn) = 0 THEN ' notes' ELSE '' END || coalesce(string_agg(' 原剧本第 ' || turn || ' 页' || ({_SCENE}), '' ORDER BY turn) FILTER (turn > 0), '') AS contents FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn = 0 ORDER BY turn) AS r FROM conversations) GROUP BY conv_id",
)
def k04(spark, d):
    """A book per conversation, whose first turn is the reader's note: written, read again and checked."""
    head, turn = F.lit('<h3 id="s">scene '), F.col("turn").cast("string")
    scene = F.when(F.col("turn") % 2 == 0, F.concat(head, turn, F.lit("</h3>"))).otherwise("")
    page = F.concat(F.lit('<p class="page">原剧本第 '), turn, F.lit(" 页</p>"), scene, render.paragraph(F.col("text")))
    rows = table(spark, d, "conversations").select(
        F.col("conv_id").cast("string").alias("book"), F.lit("made").alias("title"), F.lit("made").alias("source_title"), F.lit("zh-CN").alias("language"), "turn",
        F.when(F.col("turn") == 0, "reader-notes").otherwise("chapter").alias("kind"), F.lit("notes").alias("heading"), F.when(F.col("turn") > 0, page).otherwise(render.paragraph(F.col("text"))).alias("html"),
    )
    rows = rows.withColumn("scenes", F.when(F.col("kind") == "chapter", books.scene_links(F.col("html"))))
    files = books.checked(books.epub_files(books.sections(rows, "turn")))
    return files.select("book", F.coalesce("wrong", F.lit("ok")).alias("state"), F.array_join("spine", " ").alias("spine"), F.array_join("contents", " ").alias("contents"))
