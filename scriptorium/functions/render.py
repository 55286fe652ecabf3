"""HTML of entries as column expressions: markers, labels, paragraphs, grids, pages, index, document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptorium.functions import script
from scriptorium.functions import text as t

# The class of each caption label.
LABEL_CLASS = {"字幕匹配": "match", "字幕差异": "diff", "字幕未见": "unseen"}
STYLE = "body{max-width:46em;margin:auto;font-family:serif}.dialogue{margin-left:6em}.character{margin-left:12em}.marker{color:#777}.grid{display:grid;grid-auto-flow:column;gap:2em}"


def _joined(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts])


def marker(m: Column) -> Column:
    """A span for one marker; its class is its type."""
    return _joined('<span class="marker ', F.regexp_replace(F.lower(m["type"]), "_", "-"), '">', t.escape_html(m["text"]), "</span>")


def label(c: Column) -> Column:
    """A span for a caption label; empty for none and for unknown ones."""
    kind = F.create_map(*[F.lit(x) for pair in LABEL_CLASS.items() for x in pair])[c]
    return F.when(kind.isNotNull(), _joined('<span class="label ', kind, '">', c, "</span>")).otherwise("")


def paragraph(text: Column, prefix: Column | str = "") -> Column:
    """Escaped text with inline marks; a final revision mark becomes an element of its own."""
    parts = script.split_asterisk(text)
    star = F.when(parts["revised"], '<span class="revision">*</span>').otherwise("")
    return _joined("<p>", prefix, t.inline_markup(t.escape_html(parts["body"])), star, "</p>")


def parallel(columns: Column) -> Column:
    """Speakers side by side, each with its lines."""

    def one(x: Column) -> Column:
        lines = F.array_join(F.transform(x["lines"], lambda line: paragraph(line)), "")
        return _joined("<div><b>", t.escape_html(x["speaker"]), "</b>", lines, "</div>")

    return _joined('<div class="grid">', F.array_join(F.transform(columns, one), ""), "</div>")


def entry(row: dict[str, Column]) -> Column:
    """One entry: ``id, type, translation, source, markers, subtitle_label, layout`` as columns; a hidden entry gives nothing."""
    marks = F.array_join(F.transform(row["markers"], marker), "")
    text = F.coalesce(F.nullif(F.trim(row["translation"]), F.lit("")), row["source"])
    body = F.when(F.coalesce(row["layout"]["type"] == "parallel_dialogue", F.lit(False)), parallel(row["layout"]["columns"])).otherwise(paragraph(text, marks))
    out = _joined('<div class="entry ', row["type"], '" id="', t.escape_html(row["id"]), '">', body, label(row["subtitle_label"]), "</div>")
    return F.when(F.coalesce(row["layout_hidden"], F.lit(False)), "").otherwise(out)


def page(number: Column, parts: Column) -> Column:
    return _joined('<section id="page-', number.cast("string"), '">', F.array_join(parts, ""), "</section>")


def index(links: Column) -> Column:
    """Navigation from ``array<struct<id, title>>``; empty without links."""
    items = F.transform(links, lambda x: _joined('<li><a href="#', t.escape_html(x["id"]), '">', t.escape_html(x["title"]), "</a></li>"))
    return F.when(F.size(links) > 0, _joined("<nav><ol>", F.array_join(items, ""), "</ol></nav>")).otherwise("")


def document(title: Column, navigation: Column, pages: Column) -> Column:
    return _joined('<!DOCTYPE html><html><head><meta charset="utf-8"><title>', t.escape_html(title), f"</title><style>{STYLE}</style></head><body><h1>", t.escape_html(title), "</h1>", navigation, F.array_join(pages, ""), "</body></html>")


def markdown_block(kind: Column, lines: Column) -> Column:
    """HTML of a block of lines by its kind: ``heading``, ``list``, ``table`` or ``paragraph``."""

    def inline(line: Column) -> Column:
        return t.inline_markup(t.escape_html(F.trim(line)))

    first = F.get(lines, 0)
    level = F.least(F.length(F.regexp_extract(first, "^(#*)", 1)), F.lit(6)).cast("string")
    heading = _joined("<h", level, ">", inline(F.regexp_replace(first, "^#+", "")), "</h", level, ">")
    points = F.transform(lines, lambda x: _joined("<li>", inline(F.regexp_replace(x, "^\\s*([-*]|[0-9]+[.)])\\s+", "")), "</li>"))
    tag = F.when(first.rlike("^\\s*[0-9]"), "ol").otherwise("ul")
    rows = F.filter(F.transform(lines, script.table_cells), lambda c: ~script.is_table_rule(c))
    cells = F.transform(rows, lambda c: _joined("<tr>", F.array_join(F.transform(c, lambda x: _joined("<td>", inline(x), "</td>")), ""), "</tr>"))
    return (
        F.when(kind == "heading", heading)
        .when(kind == "list", _joined("<", tag, ">", F.array_join(points, ""), "</", tag, ">"))
        .when(kind == "table", _joined("<table>", F.array_join(cells, ""), "</table>"))
        .otherwise(_joined("<p>", F.array_join(F.transform(lines, inline), " "), "</p>"))
    )
