"""Draft entries from lines and markers, as a query."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import script as s
from scriptorium.functions import text as t
from scriptorium.operators import drafting
from scriptorium.operators.stored import Stored
from scriptorium.plans import layout, script

QUERIES, SQL = {}, {}


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return register


#: Labels of placed lines as markers, a little or a lot above their line, some on the other side too; every 13th line has a marker of another type.
_UP = "CASE line_no % 4 WHEN 0 THEN 2 WHEN 1 THEN 5 WHEN 2 THEN 3 ELSE 7 END"
_MARKERS = (
    f"(SELECT doc_id, page + 1 AS page, line_no * 4 AS marker_no, type, scene_no AS text, x, 700 - line_no % 10 * 12 + {_UP} AS y FROM {layout._MARKS}"
    f" UNION ALL SELECT doc_id, page + 1, line_no * 4 + 1, type, scene_no, 612 - x, 700 - line_no % 10 * 12 + {_UP} + 1 FROM {layout._MARKS} WHERE doc_id % 2 = 0"
    f" UNION ALL SELECT doc_id, line_no // 10 + 1, line_no * 4 + 2, 'contd', 'CONT', x, 700 - line_no % 10 * 12 + {_UP} FROM {script.PLACED} WHERE line_no % 13 = 3)"
)
_PLACEHOLDER = "CASE kind " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in drafting.PLACEHOLDERS.items()) + f" ELSE '{drafting.OTHER}' END"
_LIST = "string_agg(type || '=' || text, ' ' ORDER BY y DESC, x, marker_no)"


@query(
    "O02_drafted_lines",
    f"WITH l AS MATERIALIZED (SELECT doc_id, line_no // 10 + 1 AS page, line_no, kind, line AS text, 700 - line_no % 10 * 12 AS y, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS k, count(*) OVER (PARTITION BY doc_id) AS n FROM {script.DIALOGUE}), m AS MATERIALIZED (SELECT * FROM {_MARKERS}),"
    " a AS (SELECT l.doc_id, l.line_no, m.marker_no, m.type, m.text, m.x, m.y FROM l JOIN m ON m.doc_id = l.doc_id AND m.page = l.page AND abs(m.y - l.y) <= 3),"
    f" o AS (SELECT doc_id, line_no, {_LIST} AS marks FROM a GROUP BY doc_id, line_no),"
    " f AS (SELECT *, CASE WHEN type IN ('scene_no', 'split_scene') THEN text ELSE '#' || marker_no END AS of_key, round_even(y / 3, 0) AS cell FROM m WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.doc_id = m.doc_id AND a.marker_no = m.marker_no)),"
    f" g AS (SELECT doc_id, page, type, {_LIST} AS marks, string_agg(text, ' / ' ORDER BY y DESC, x, marker_no) AS texts, min(marker_no) AS first_no, arg_min(x, marker_no) AS first_x, arg_min(y, marker_no) AS first_y FROM f GROUP BY doc_id, page, type, of_key, cell),"
    " e AS (SELECT g.doc_id, g.page, printf('p%03d-m%03d', g.page, n + row_number() OVER (PARTITION BY g.doc_id ORDER BY g.page, first_y DESC, first_x, first_no)) AS id, CASE WHEN type IN ('scene_no', 'split_scene') THEN 'scene_heading' ELSE 'format_marker' END AS kind, texts, marks FROM g JOIN (SELECT doc_id, max(n) AS n FROM l GROUP BY doc_id) c ON c.doc_id = g.doc_id)"
    f" SELECT l.doc_id, page, printf('p%03d-e%03d', page, k) AS id, kind, text AS source, {_PLACEHOLDER} || '：' || text AS translation, coalesce(marks, '') AS markers FROM l LEFT JOIN o ON o.doc_id = l.doc_id AND o.line_no = l.line_no"
    f" UNION ALL SELECT doc_id, page, id, kind, 'STRUCTURE MARKER: ' || texts, {_PLACEHOLDER} || '：' || texts, marks FROM e",
)
def o02(spark, d):
    rows = Stored(script.dialogues(spark, d)).df
    n = F.col("line_no")
    page, y = F.expr("line_no div 10 + 1"), 700 - n % 10 * 12
    lines = rows.select("doc_id", page.alias("page"), n.alias("at"), "kind", F.col("line").alias("text"), y.alias("y"))
    high = y + F.expr(_UP)
    placed = rows.select("doc_id", "line_no", "line", "x", page.alias("page"), high.alias("y"), s.scene_label(F.col("line")).alias("type"))
    label = F.upper(t.collapse_space(F.col("line")))
    labels = placed.filter("type is not null").select("doc_id", "page", (n * 4).alias("marker_no"), "type", label.alias("text"), "x", "y")
    other = labels.filter("doc_id % 2 = 0").select("doc_id", "page", (F.col("marker_no") + 1).alias("marker_no"), "type", "text", (612 - F.col("x")).alias("x"), (F.col("y") + 1).alias("y"))
    more = placed.filter("line_no % 13 = 3").select("doc_id", "page", (n * 4 + 2).alias("marker_no"), F.lit("contd").alias("type"), F.lit("CONT").alias("text"), "x", "y")
    markers = Stored(labels.unionAll(other).unionAll(more).withColumn("scene_key", F.col("text"))).df
    out = drafting.draft_entries(lines, markers, ["doc_id"])
    marks = F.array_join(F.transform("markers", lambda m: F.concat_ws("=", m["type"], m["text"])), " ")
    return out.select("doc_id", "page", "id", "kind", "source", "translation", F.coalesce(marks, F.lit("")).alias("markers"))
