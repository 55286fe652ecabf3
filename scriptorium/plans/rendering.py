"""Entries to pages to one HTML document per batch, and markdown notes to HTML, as queries and operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import render
from scriptorium.functions import text as t
from scriptorium.operators import runs
from scriptorium.sources.tables import LINES, lines, table

QUERIES, SQL = {}, {}
FIELDS = ("id", "type", "translation", "source", "markers", "subtitle_label", "layout", "layout_hidden")


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return register


def documents(entries: DataFrame, key: str, title: str) -> DataFrame:
    """``key, html``: a document per batch, from rows of ``sources.batches.entries`` with ``display_page`` and a title.

    Pages are made first and then joined, so that a task holds a page, and a document only where it is written.
    A batch is one document by definition, which bounds what a task holds.
    """
    rows = entries.select(key, title, "ordinal", "part", F.coalesce("display_page", F.lit(0)).alias("page"), F.when(F.col("type") == "scene_heading", F.struct("part", "ordinal", "id", F.coalesce(F.nullif(F.trim("translation"), F.lit("")), "source").alias("title"))).alias("heading"), render.entry({f: F.col(f) for f in FIELDS}).alias("html"))
    front = F.col("part") != "front"  # front matter comes before the body
    order = F.struct(front.alias("a"), "ordinal", "html")
    pages = rows.groupBy(key, title, "page").agg(F.array_sort(F.collect_list(order)).alias("e"), F.collect_list("heading").alias("h"))
    made = pages.select(key, title, "page", render.page(F.col("page"), F.transform("e", lambda x: x["html"])).alias("html"), "h")
    whole = made.groupBy(key).agg(F.first(title).alias(title), F.array_sort(F.collect_list(F.struct("page", "html"))).alias("p"), F.flatten(F.collect_list("h")).alias("h"))
    links = F.transform(F.array_sort(F.transform("h", lambda x: F.struct(x["part"] != "front", x["ordinal"], x["id"], x["title"]))), lambda x: F.struct(x["id"].alias("id"), x["title"].alias("title")))
    return whole.select(key, render.document(F.col(title), render.index(links), F.transform("p", lambda x: x["html"])).alias("html"))


def markdown(texts: DataFrame, key: str, column: str) -> DataFrame:
    """``key, html`` of markdown texts: headings, lists, tables and paragraphs; blank texts give an empty string."""
    rows = texts.select(key, F.posexplode_outer(F.split(column, "\n")).alias("line_no", "line"))
    line = F.coalesce("line", F.lit(""))
    kind = F.when(line.rlike("^\\s*$"), "blank").when(line.rlike("^\\s*([-*]|[0-9]+[.)])\\s"), "list").when(line.rlike("^#+\\s"), "heading").when(line.rlike("^\\|.*\\|$"), "table").otherwise("paragraph")
    rows = rows.withColumn("kind", kind)
    breaks = (F.col("kind") != F.lag("kind").over(runs.ordered([key], ["line_no"]))) | (F.col("kind") == "heading")
    rows = runs.islands(rows.withColumn("breaks", breaks), [key], ["line_no"], F.col("breaks"))
    blocks = rows.groupBy(key, "island", "kind").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", line.alias("line")))), lambda x: x["line"]).alias("lines"))
    html = F.when(F.col("kind") == "blank", "").otherwise(render.markdown_block(F.col("kind"), F.col("lines")))
    made = blocks.select(key, "island", html.alias("html"))
    return made.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("island", "html"))), lambda x: x["html"]), "").alias("html"))


def _escaped(x: str) -> str:
    for plain, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;")):
        x = f"replace({x}, '{plain}', '{code}')"
    return x


@query("R01_marker", f"""SELECT event_id, '<span class="marker ' || event_type || '">' || {_escaped('props')} || '</span>' AS html FROM events""")
def r01(spark, d):
    return table(spark, d, "events").select("event_id", render.marker(F.struct(F.col("event_type").alias("type"), F.col("props").alias("text"))).alias("html"))


def _inline(x: str) -> str:
    """Inline marks in SQL, which knows no lookaround: runs of stars are set aside, so that those left stand alone."""
    for mark, element, kind in (("\\[\\[(.+?)\\]\\]", "span", "reader-annotation"), ("__(.+?)__", "span", "proper-name"), ("\\*\\*(.+?)\\*\\*", "strong", "emphasis")):
        x = f"regexp_replace({x}, '{mark}', '<{element} class=\"{kind}\">\\1</{element}>', 'g')"
    x = f"replace(replace({x}, '**', repeat(chr(1), 2)), chr(1) || '*', repeat(chr(1), 2))"
    return f"""replace(regexp_replace({x}, '\\*(.+?)\\*', '<em class="term">\\1</em>', 'g'), chr(1), '*')"""


def _paragraph(x: str, prefix: str = "''") -> str:
    body = f"regexp_replace({x}, '\\s*\\[\\[\\*\\]\\]\\s*$', '')"
    return f"""'<p>' || {prefix} || {_inline(_escaped(body))} || CASE WHEN regexp_matches({x}, '\\[\\[\\*\\]\\]\\s*$') THEN '<span class="revision">*</span>' ELSE '' END || '</p>'"""


#: Marks put behind a text, by a number, so that each kind is met beside those that texts hold.
_MARKS = ("", " **strong** *term* *two*", " __Name__ [[note]]", " *open **both** x*", " x [[*]] ")
_MARKED = "{0} || [" + ", ".join(f"'{m}'" for m in _MARKS) + f"][{{1}} % {len(_MARKS)} + 1]"


def marked(text: str, number: str):
    return F.concat(text, F.element_at(F.array(*map(F.lit, _MARKS)), (F.col(number) % len(_MARKS) + 1).cast("int")))


@query("R02_paragraph", f"SELECT doc_id, line_no, {_paragraph('line')} AS html FROM (SELECT doc_id, line_no, {_MARKED.format('line', 'line_no')} AS line FROM {LINES})")
def r02(spark, d):
    return lines(spark, d).select("doc_id", "line_no", render.paragraph(marked("line", "line_no")).alias("html"))


@query("R05_label", """SELECT doc_id, CASE WHEN toxic = 1 THEN '<span class="label unseen">字幕未见</span>' WHEN quality = 0 THEN '<span class="label diff">字幕差异</span>' ELSE '' END AS html FROM labels""")
def r05(spark, d):
    label = F.when(F.col("toxic") == 1, "字幕未见").when(F.col("quality") == 0, "字幕差异")
    return table(spark, d, "labels").select("doc_id", render.label(label).alias("html"))


@query("R07_pages", f"""SELECT conv_id, page, '<section id="page-' || page || '">' || string_agg(html, '' ORDER BY turn) || '</section>' AS html FROM (SELECT conv_id, turn, turn // 3 AS page, {_paragraph('text')} AS html FROM (SELECT conv_id, turn, {_MARKED.format('text', 'turn')} AS text FROM conversations)) GROUP BY conv_id, page""")
def r07(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", F.floor(F.col("turn") / 3).alias("page"), F.struct("turn", render.paragraph(marked("text", "turn")).alias("html")).alias("e"))
    pages = rows.groupBy("conv_id", "page").agg(F.array_sort(F.collect_list("e")).alias("e"))
    return pages.select("conv_id", "page", render.page(F.col("page"), F.transform("e", lambda x: x["html"])).alias("html"))


@query("O19_section_parts", "SELECT page_id, regexp_extract(html, '(?s)^(<[^>]*>)', 1) AS open_tag, length(regexp_extract(html, '(?s)^<[^>]*>(.*)$', 1)) AS n_inner FROM pages")
def o19(spark, d):
    html = F.col("html")
    return table(spark, d, "pages").select("page_id", F.regexp_extract(html, "(?s)^(<[^>]*>)", 1).alias("open_tag"), F.length(F.regexp_extract(html, "(?s)^<[^>]*>(.*)$", 1)).alias("n_inner"))


def sections(pages: DataFrame, key: str = "page_id", column: str = "html") -> DataFrame:
    """Sections that headings open: ``key, section, title, text``; scripts, styles and comments go.

    What stands before the first heading is section 0, without a title.
    """
    clean = F.regexp_replace(column, "(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>", " ")
    parts = pages.select(key, F.posexplode(F.split(clean, "(?i)(?=<h[1-6][ >])")).alias("section", "part"))
    title = t.collapse_space(t.strip_tags(F.regexp_extract("part", "(?is)^<h[1-6][^>]*>(.*?)</h[1-6]\\s*>", 1)))
    return parts.select(key, "section", F.nullif(title, F.lit("")).alias("title"), t.collapse_space(t.strip_tags(F.regexp_replace("part", "(?i)<(br|/p|/div|/li|/h[1-6])\\b[^>]*>", "\n"))).alias("text"))


@query("S24_section_titles", """SELECT page_id, trim(regexp_replace(regexp_replace(unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', ' ', 'g'), '(?is)<h[1-6][^>]*>(.*?)</h[1-6]\\s*>', 1)), '<[^>]+>', '', 'g'), '\\s+', ' ', 'g')) AS title FROM pages""")
def s24(spark, d):
    return sections(table(spark, d, "pages").select("page_id", "html")).filter("title is not null").select("page_id", "title")
