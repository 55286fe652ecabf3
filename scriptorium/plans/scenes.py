"""Scenes: their summaries and index, and the cover with its front matter, as queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions import script as s
from scriptorium.functions import text as t
from scriptorium.plans import rendering, script
from scriptorium.sources.tables import table

QUERIES, SQL = {}, {}
# Labels of lines that differ from the film, and texts that a reader sees.
DIFFERS, UNSEEN = "字幕差异", "字幕未见"
INDEX, NAVIGATION, FILTER, UNKNOWN_PAGES = "场次索引", "场景导航", "只看分歧", "原剧本页数未知"
KICKER, RIGHTS = "中文剧本学习版", "本中文剧本学习版仅供个人学习与研究使用，请勿商用或公开传播。"


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return register


def scenes(entries: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each scene heading: ``key, order, id, number, title, page, time, diff, unseen``.

    ``entries``: ``key, order, id, kind, number, title, page, label, start``.  Dialogue up to the next heading counts; the time is
    that of the first which has one.  What stands before the first heading belongs to no scene.
    """
    w = Window.partitionBy(key).orderBy(order)
    head = F.last(F.when(F.col("kind") == "scene_heading", F.struct(order, "id", "number", "title", "page")), ignorenulls=True).over(w)
    rows = entries.withColumn("head", head).filter("head is not null")
    spoken = F.col("kind") == "dialogue"
    time = t.format_timecode(F.col("start"))
    first = F.min(F.when(spoken & (time != ""), F.struct(order, time.alias("time"))))["time"]
    counts = [F.count_if(spoken & (F.col("label") == label)).alias(n) for n, label in (("diff", DIFFERS), ("unseen", UNSEEN))]
    return rows.groupBy(key, "head").agg(F.coalesce(first, F.lit("")).alias("time"), *counts).select(key, "head.*", "time", "diff", "unseen")


def _joined(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts])


def scene_meta(time: Column, divergence: Column) -> Column:
    """Time and divergence of a scene as a span; empty without either."""
    inner = _joined(F.when(time != "", _joined('<span class="time">~', time, "</span>")), F.when(divergence != "", _joined('<span class="divergence">', divergence, "</span>")))
    return F.when(inner != "", _joined('<span class="scene-meta">', inner, "</span>")).otherwise("")


def scene_index(found: DataFrame, key: str, order: str) -> DataFrame:
    """``key, html``: numbered scenes with time and divergence; where a key has none, all its headings without either.

    A scene without a number is not listed beside those that have one.  The filter is there only if a line differs.
    """
    numbered = F.max(F.col("number").isNotNull()).over(Window.partitionBy(key))
    rows = found.withColumn("numbered", numbered).filter(~F.col("numbered") | F.col("number").isNotNull())
    title = t.inline_markup(t.escape_html(F.coalesce("title", F.lit(""))))
    label = F.when(F.col("numbered"), _joined(t.escape_html(F.col("number")), " · ", title)).otherwise(title)
    page = F.coalesce(F.col("page").cast("string"), F.lit("?"))
    extra = F.when(F.col("numbered"), scene_meta(F.col("time"), s.divergence_label(F.col("diff"), F.col("unseen"))))
    item = _joined('<li><a href="#', t.escape_html(F.col("id")), '">', label, '</a> <span class="page">第 ', page, " 页</span>", extra, "</li>")
    lists = rows.groupBy(key).agg(F.max("numbered").alias("numbered"), F.max(F.col("numbered") & (F.col("diff") + F.col("unseen") > 0)).alias("differs"), F.array_sort(F.collect_list(F.struct(order, item.alias("html")))).alias("items"))
    head = _joined(F.when(F.col("numbered"), INDEX).otherwise(NAVIGATION), F.when(F.col("differs"), f'<button data-filter="divergence">{FILTER}</button>'))
    return lists.select(key, _joined("<nav><h2>", head, "</h2><ol>", F.array_join(F.transform("items", lambda x: x["html"]), ""), "</ol></nav>").alias("html"))


#: Lines as translated entries: some headings have a number, some dialogue a label and a time.
_NUMBER = "CASE WHEN doc_id % 3 <> 0 AND line_no % 4 <> 2 THEN concat(line_no % 40 + 1, CASE WHEN line_no % 5 = 0 THEN 'A' ELSE '' END) END"
_LABEL = f"CASE line_no % 3 WHEN 0 THEN '{DIFFERS}' WHEN 1 THEN '{UNSEEN}' END"
_START = "CASE WHEN line_no % 2 = 0 THEN line_no * 97.3 END"


def entries(spark, d):
    rows = script.dialogues(spark, d)
    return rows.select("doc_id", "line_no", F.format_string("e%d", "line_no").alias("id"), "kind", F.expr(_NUMBER).alias("number"), F.col("line").alias("title"), F.expr("line_no div 10 + 1").alias("page"), F.expr(_LABEL).alias("label"), F.expr(_START).cast("double").alias("start"))


_CLOCK = "CASE WHEN first < 3600 THEN printf('%02d:%02d', CAST(floor(first / 60) AS BIGINT), CAST(floor(first) AS BIGINT) % 60) ELSE printf('%02d:%02d:%02d', CAST(floor(first / 3600) AS BIGINT), CAST(floor(first / 60) AS BIGINT) % 60, CAST(floor(first) AS BIGINT) % 60) END"
_SCENES = f"""e AS (SELECT doc_id, line_no, kind, {_NUMBER} AS number, line AS title, {_LABEL} AS label, CAST({_START} AS DOUBLE) AS start FROM {script.DIALOGUE}),
h AS (SELECT *, last_value(CASE WHEN kind = 'scene_heading' THEN line_no END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS head FROM e),
g AS (SELECT doc_id, head, count(*) FILTER (kind = 'dialogue' AND label = '{DIFFERS}') AS diff, count(*) FILTER (kind = 'dialogue' AND label = '{UNSEEN}') AS unseen, arg_min(start, line_no) FILTER (kind = 'dialogue' AND start IS NOT NULL) AS first FROM h WHERE head IS NOT NULL GROUP BY doc_id, head),
c AS (
  SELECT g.doc_id, head AS line_no, number, title, head // 10 + 1 AS page, diff, unseen, CASE WHEN first IS NULL THEN '' ELSE {_CLOCK} END AS time,
         concat_ws('·', CASE WHEN diff > 0 THEN diff || '改' END, CASE WHEN unseen > 0 THEN unseen || '未见' END) AS divergence
  FROM g JOIN e ON e.doc_id = g.doc_id AND e.line_no = g.head
),
m AS (SELECT *, CASE WHEN time <> '' OR divergence <> '' THEN '<span class="scene-meta">' || CASE WHEN time <> '' THEN '<span class="time">~' || time || '</span>' ELSE '' END || CASE WHEN divergence <> '' THEN '<span class="divergence">' || divergence || '</span>' ELSE '' END || '</span>' ELSE '' END AS meta FROM c)"""


@query("R05_scene_meta", f"WITH {_SCENES} SELECT doc_id, line_no, meta AS html FROM m")
def r05(spark, d):
    found = scenes(entries(spark, d), "doc_id", "line_no")
    return found.select("doc_id", "line_no", scene_meta(F.col("time"), s.divergence_label(F.col("diff"), F.col("unseen"))).alias("html"))


_TITLE = rendering._inline(rendering._escaped("title"))


@query(
    "R06_index",
    f"WITH {_SCENES}, n AS (SELECT *, max(CASE WHEN number IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id) AS numbered FROM m), k AS (SELECT *, '<li><a href=\"#e' || line_no || '\">' || CASE WHEN numbered = 1 THEN number || ' · ' ELSE '' END || {_TITLE} || '</a> <span class=\"page\">第 ' || page || ' 页</span>' || CASE WHEN numbered = 1 THEN meta ELSE '' END || '</li>' AS item FROM n WHERE numbered = 0 OR number IS NOT NULL)"
    f" SELECT doc_id, '<nav><h2>' || CASE WHEN max(numbered) = 1 THEN '{INDEX}' ELSE '{NAVIGATION}' END || CASE WHEN max(numbered) = 1 AND sum(diff + unseen) > 0 THEN '<button data-filter=\"divergence\">{FILTER}</button>' ELSE '' END || '</h2><ol>' || string_agg(item, '' ORDER BY line_no) || '</ol></nav>' AS html FROM k GROUP BY doc_id",
)
def r06(spark, d):
    return scene_index(scenes(entries(spark, d), "doc_id", "line_no"), "doc_id", "line_no")


def cover(books: DataFrame, front: DataFrame, key: str) -> DataFrame:
    """``key, html`` of covers from ``key, title, chinese_title, source_title, pages`` and front matter ``key, at, translation``.

    The title is the Chinese one if there is one.  Without front matter that says something, the source's title stands
    in its place, beside the Chinese one if there is one; a null number of pages is said to be unknown.
    """
    said = front.filter(F.trim("translation") != "").groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", F.trim("translation").alias("x")))), lambda e: e["x"]).alias("items"))
    chinese = F.nullif(F.trim("chinese_title"), F.lit(""))
    own = F.when(chinese.isNotNull(), _joined("剧本名：__", chinese, "__（原文：", F.col("source_title"), "）")).otherwise(_joined("剧本名：__", F.col("source_title"), "__"))
    items = F.coalesce("items", F.when(F.col("source_title") != "", F.array(own)), F.array().cast("array<string>"))
    lines = F.array_join(F.transform(items, lambda x: _joined("<p>", t.inline_markup(t.escape_html(x)), "</p>")), "")
    pages = F.when(F.col("pages").isNotNull(), _joined("原剧本共 ", F.col("pages").cast("string"), " 页")).otherwise(UNKNOWN_PAGES)
    matter = F.when(F.size(items) > 0, _joined('<div class="front">', lines, "</div>"))
    html = _joined(f'<header><p class="kicker">{KICKER}</p><h1>', t.escape_html(F.coalesce(chinese, "title")), '</h1><p class="pages">', pages, f'</p><p class="rights">{RIGHTS}</p>', matter, "</header>")
    return books.join(said, key, "left").select(key, html.alias("html"))


_FIRST = "trim(string_split(text, chr(10))[1])"


@query(
    "R08_cover",
    f"WITH b AS (SELECT doc_id, {_FIRST} AS title, CASE doc_id % 3 WHEN 1 THEN '书名' || doc_id WHEN 2 THEN ' ' END AS chinese, CASE WHEN doc_id % 7 <> 0 THEN length(text) // 3000 + 1 END AS pages, text FROM documents),"
    f" f AS (SELECT doc_id, string_agg('<p>' || {rendering._inline(rendering._escaped('trim(line)'))} || '</p>', '' ORDER BY line_no) AS matter FROM {script.LINES} WHERE line_no IN (1, 2) AND doc_id % 4 = 0 AND trim(line) <> '' GROUP BY doc_id),"
    " o AS (SELECT b.*, CASE WHEN trim(coalesce(chinese, '')) <> '' THEN '剧本名：__' || trim(chinese) || '__（原文：' || title || '）' ELSE '剧本名：__' || title || '__' END AS own FROM b)"
    f" SELECT o.doc_id, '<header><p class=\"kicker\">{KICKER}</p><h1>' || {rendering._escaped('''CASE WHEN trim(coalesce(chinese, '')) <> '' THEN trim(chinese) ELSE title END''')} || '</h1><p class=\"pages\">' || CASE WHEN pages IS NULL THEN '{UNKNOWN_PAGES}' ELSE '原剧本共 ' || pages || ' 页' END || '</p><p class=\"rights\">{RIGHTS}</p>' ||"
    f" CASE WHEN matter IS NULL AND title = '' THEN '' ELSE '<div class=\"front\">' || coalesce(matter, '<p>' || {rendering._inline(rendering._escaped('own'))} || '</p>') || '</div>' END || '</header>' AS html FROM o LEFT JOIN f ON f.doc_id = o.doc_id",
)
def r08(spark, d):
    """A document as a book: its first line is the title; the two lines behind it are front matter in some."""
    title = F.trim(F.split("text", "\n")[0])
    chinese = F.when(F.col("doc_id") % 3 == 1, F.concat(F.lit("书名"), F.col("doc_id").cast("string"))).when(F.col("doc_id") % 3 == 2, " ")
    pages = F.when(F.col("doc_id") % 7 != 0, F.expr("length(text) div 3000 + 1"))
    books = table(spark, d, "documents").select("doc_id", title.alias("title"), chinese.alias("chinese_title"), title.alias("source_title"), pages.alias("pages"))
    front = script.lines(spark, d).filter("line_no in (1, 2) and doc_id % 4 = 0").select("doc_id", F.col("line_no").alias("at"), F.col("line").alias("translation"))
    return cover(books, front, "doc_id")
