"""Protected entries, display units and reflow, as queries over the lines of documents as translated entries."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.operators import reflow as r
from scriptorium.plans import script

QUERIES, SQL = {}, {}


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return register


#: What is put before a line and behind it, by its number, so that every test has hits and misses.
_BEFORE = "CASE line_no % 19 WHEN 1 THEN '1. ' WHEN 3 THEN '- ' WHEN 6 THEN 'Super: ' WHEN 9 THEN 'Titles of' WHEN 11 THEN '• ' WHEN 14 THEN 'on screen ' ELSE '' END"
_BEHIND = "CASE line_no % 16 WHEN 2 THEN ' ♪' WHEN 7 THEN ' [[*]] ' WHEN 12 THEN chr(10) || 'more' ELSE '' END"
_LABELS = "CASE line_no % 23 WHEN 4 THEN '字幕差异' WHEN 5 THEN '字幕差异' WHEN 8 THEN '字幕匹配' END"
_FIELDS = f"""{_BEFORE} || line || {_BEHIND} AS translation, {_LABELS} AS label, CASE WHEN line_no % 29 = 9 THEN 1 ELSE 0 END AS n_markers,
  line_no % 31 = 10 AS preserve_line_breaks, CASE WHEN line_no % 13 = 1 THEN doc_id % 2 = 0 END AS reflow, line_no % 37 = 18 AS has_layout, line_no % 17 = 13 AS hidden"""
_ENTRIES = f"(SELECT doc_id, line_no, printf('e%d', line_no) AS id, kind, line AS source, line_no // 10 AS page, {_FIELDS} FROM {script.DIALOGUE})"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_TRIMMED = f"trim(translation, {_SPACE})"
_KEPT = f"""(kind IN ('page_heading', 'scene_heading', 'character', 'parenthetical', 'transition', 'format_marker', 'note') OR n_markers > 0 OR regexp_matches(translation, '{r.REVISED}')
  OR preserve_line_breaks OR NOT coalesce(reflow, true) OR (regexp_matches({_TRIMMED}, '{r.LIST_MARK}') AND NOT (kind = 'action' AND regexp_matches({_TRIMMED}, '^\\s*-\\s+')))
  OR regexp_matches(source, '{r.SCREEN_TEXT}') OR regexp_matches({_TRIMMED}, '{r.SCREEN_TEXT}') OR contains({_TRIMMED}, '♪') OR contains({_TRIMMED}, chr(10)) OR has_layout)"""
_JUDGED = f"(SELECT *, {_KEPT} AS kept FROM {_ENTRIES})"
_Z = "(PARTITION BY doc_id ORDER BY line_no)"
_MERGES = f"coalesce(page = lag(page) OVER {_Z} AND NOT kept AND NOT lag(kept) OVER {_Z} AND kind = lag(kind) OVER {_Z} AND (kind = 'action' OR (kind = 'dialogue' AND coalesce(label, '') = coalesce(lag(label) OVER {_Z}, ''))), false)"


def entries(spark, d):
    """Lines with what a translated entry has; ``kept`` says whether one is protected."""
    rows = script.dialogues(spark, d)
    made = rows.select("doc_id", "line_no", F.format_string("e%d", "line_no").alias("id"), "kind", F.col("line").alias("source"), F.expr("cast(line_no div 10 as int)").alias("page"), *[F.expr(x).alias(n) for n, x in _EXPRESSIONS.items()])
    named = ("kind", "source", "translation", "n_markers", "preserve_line_breaks", "reflow", "has_layout")
    return made.withColumn("kept", r.protected({n: F.col(n) for n in named}))


_EXPRESSIONS = {
    "translation": f"{_BEFORE} || line || {_BEHIND}",
    "label": _LABELS,
    "n_markers": "CASE WHEN line_no % 29 = 9 THEN 1 ELSE 0 END",
    "preserve_line_breaks": "line_no % 31 = 10",
    "reflow": "CASE WHEN line_no % 13 = 1 THEN doc_id % 2 = 0 END",
    "has_layout": "line_no % 37 = 18",
    "hidden": "line_no % 17 = 13",
}


@query("P16_protected", f"SELECT doc_id, line_no FROM {_JUDGED} WHERE kept")
def p16(spark, d):
    return entries(spark, d).filter("kept").select("doc_id", "line_no")


@query("P22_display_unit", f"SELECT unit, count(*) AS n FROM (SELECT CASE WHEN kept THEN 'protected' WHEN kind = 'dialogue' THEN 'dialogue' WHEN kind = 'action' THEN 'prose' ELSE 'protected' END AS unit FROM {_JUDGED}) GROUP BY unit")
def p22(spark, d):
    unit = F.when(F.col("kept"), "protected").otherwise(r.unit_type(F.col("kind")))
    return entries(spark, d).groupBy(unit.alias("unit")).agg(F.count("*").alias("n"))


@query("P17_mergeable", f"SELECT doc_id, line_no FROM (SELECT doc_id, line_no, {_MERGES} AS merges FROM {_JUDGED}) WHERE merges")
def p17(spark, d):
    return r.mergeable(entries(spark, d), ["doc_id"], "line_no").filter("merges").select("doc_id", "line_no")


@query(
    "W07_reflow",
    f"SELECT doc_id, island, min(line_no) AS first_line, count(*) AS n, CASE WHEN arg_min(kept, line_no) THEN 'protected' WHEN arg_min(kind, line_no) = 'dialogue' THEN 'dialogue' WHEN arg_min(kind, line_no) = 'action' THEN 'prose' ELSE 'protected' END AS type, string_agg(id, ',' ORDER BY line_no) AS ids, trim(string_agg({_TRIMMED}, '' ORDER BY line_no), {_SPACE}) AS text"
    f" FROM (SELECT *, CAST(sum(CASE WHEN merges OR first THEN 0 ELSE 1 END) OVER {_Z} AS BIGINT) AS island FROM (SELECT *, {_MERGES} AS merges, row_number() OVER {_Z} = 1 AS first FROM (SELECT * FROM {_JUDGED} WHERE NOT hidden))) GROUP BY doc_id, island",
)
def w07(spark, d):
    units = r.display_units(entries(spark, d), ["doc_id"], "line_no")
    return units.select("doc_id", F.col("unit").alias("island"), F.col("first").alias("first_line"), "n", "type", "ids", "text")
