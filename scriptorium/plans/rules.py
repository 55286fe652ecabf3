"""Validation rules over batches and their entries, as findings ``(level, code, message)``.

Rules of one entry are expressions in one array that is exploded, so all of them cost one scan; rules on
neighbours share one window, rules on a batch one aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import text as t
from scriptorium.operators import runs
from scriptorium.plans import script
from scriptorium.sources import batches as b
from scriptorium.sources.tables import table

QUERIES, SQL = {}, {}

# Allowed kinds, markers, labels and confidences, prefixes of drafts, words of raw format marks.
KINDS = ("page_heading", "scene_heading", "action", "character", "parenthetical", "dialogue", "transition", "format_marker", "note")
MARKERS = ("scene_no", "omitted", "contd", "more", "split_scene", "voice_or_position", "transition")
LABELS = ("字幕匹配", "字幕差异", "字幕未见")
CONFIDENCES = ("high", "low")
DRAFT_PREFIXES = ("待译场景标题：", "待译动作描写：", "待译角色提示：", "待译括号说明：", "待译对白：", "待译转场：", "待译格式标记：", "待处理页码：")
DRAFT = "^(" + "|".join(DRAFT_PREFIXES) + ")"
HEADINGS = ("INT", "EXT", "I/E")
RAW_MARK = "(?<![A-Za-z])(?:\\((?:CONT['’]D|MORE|O\\.S\\.|O\\.C\\.|V\\.O\\.)\\)|OMITTED|CONT['’]D|MORE|V\\.O\\.|O\\.S\\.|O\\.C\\.|INT\\.|EXT\\.|CUT TO:?|FADE IN:?|FADE OUT:?|DISSOLVE TO:?|SMASH CUT:?|MATCH CUT:?)(?![A-Za-z])"
MARKUP = "\\[\\[.+?\\]\\]|__.+?__|\\*\\*.+?\\*\\*|(?<!\\*)\\*(?!\\*).+?(?<!\\*)\\*(?!\\*)"
SHORT_SOURCE, SHORT_TARGET, DUPLICATE_LENGTH, PREVIEW, REVISIONS = 80, 8, 6, 12, 3


def finding(condition: Column, level: str, code: str, message: Column | None = None) -> Column:
    """The finding where the condition holds (null counts as false), else null."""
    said = F.lit("") if message is None else F.coalesce(message.cast("string"), F.lit(""))
    return F.when(F.coalesce(condition, F.lit(False)), F.struct(F.lit(level).alias("level"), F.lit(code).alias("code"), said.alias("message")))


def blank(c: Column) -> Column:
    return c.isNull() | c.rlike("^\\s*$")


def exploded(rows: DataFrame, keys: list[str], rules: list[Column]) -> DataFrame:
    return rows.select(*keys, F.inline(F.filter(F.array(*rules), lambda r: r.isNotNull())))


def entry_rules(rows: DataFrame, key: str = "batch_id") -> DataFrame:
    """Findings on the form of entries (rows of ``sources.batches.entries``)."""
    c = F.col
    stamped = c("subtitle_event_index").isNotNull() | c("subtitle_start").isNotNull() | c("subtitle_end").isNotNull() | c("subtitle_match_confidence").isNotNull()
    columns = c("layout.columns")
    rules = [
        finding(blank(c("id")), "FAIL", "batch.entry_id", F.concat(c("part"), F.lit("["), c("ordinal").cast("string"), F.lit("]"))),
        finding(c("type").isNull() | ~c("type").isin(*KINDS), "FAIL", "batch.entry_kind", c("id")),
        finding(c("pdf_page").isNull() | c("display_page").isNull(), "FAIL", "batch.page", c("id")),
        finding(blank(c("source")), "FAIL", "batch.source", c("id")),
        finding(blank(c("translation")), "FAIL", "batch.translation", c("id")),
        finding(c("subtitle_label").isNotNull() & ~c("subtitle_label").isin(*LABELS), "FAIL", "batch.subtitle_label", c("id")),
        finding(c("subtitle_label").isNotNull() & ~c("has_subtitles"), "FAIL", "batch.subtitle_without_source", c("id")),
        finding(F.exists("markers", lambda m: m["type"].isNull() | ~m["type"].isin(*MARKERS)), "FAIL", "batch.marker_type", c("id")),
        finding(F.exists("markers", lambda m: blank(m["text"])), "FAIL", "batch.marker_text", c("id")),
        finding(F.exists("markers", lambda m: (m["type"] == "scene_no") & blank(m["scene_no"])), "FAIL", "batch.marker_scene_no", c("id")),
        finding(stamped & ~c("has_subtitles"), "FAIL", "batch.subtitle_timestamp_without_source", c("id")),
        finding(stamped & (c("type") != "dialogue"), "FAIL", "batch.subtitle_timestamp_entry_type", c("id")),
        finding(stamped & (c("subtitle_label") == LABELS[2]), "FAIL", "batch.subtitle_timestamp_unseen", c("id")),
        finding(c("subtitle_event_index") < 0, "FAIL", "batch.subtitle_event_index", c("id")),
        finding(c("subtitle_start") < 0, "FAIL", "batch.subtitle_start", c("id")),
        finding(c("subtitle_end") < 0, "FAIL", "batch.subtitle_end", c("id")),
        finding(c("subtitle_end") < c("subtitle_start"), "FAIL", "batch.subtitle_time_range", c("id")),
        finding(~c("subtitle_match_confidence").isin(*CONFIDENCES), "FAIL", "batch.subtitle_match_confidence", c("id")),
        finding(c("layout").isNotNull() & ~F.coalesce(c("layout.type") == "parallel_dialogue", F.lit(False)), "FAIL", "batch.layout_type", c("id")),
        finding(c("layout").isNotNull() & (F.coalesce(F.size("layout.source_entry_ids"), F.lit(0)) <= 0), "FAIL", "batch.layout_source_entry_ids", c("id")),
        finding(c("layout").isNotNull() & (F.coalesce(F.size(columns), F.lit(0)) < 2), "FAIL", "batch.layout_parallel_columns", c("id")),
        finding(F.exists(columns, lambda x: blank(x["speaker"])), "FAIL", "batch.layout_parallel_speaker", c("id")),
        finding(F.exists(columns, lambda x: F.coalesce(F.size(x["lines"]), F.lit(0)) <= 0), "FAIL", "batch.layout_parallel_lines", c("id")),
        finding(F.exists(columns, lambda x: F.exists(x["lines"], blank)), "FAIL", "batch.layout_parallel_line", c("id")),
    ]
    again = F.row_number().over(runs.ordered([key, "id"], [F.desc("part"), "ordinal"])) > 1
    repeated = rows.filter(~blank(F.col("id"))).withColumn("again", again).filter("again")
    return exploded(rows, [key], rules).unionByName(repeated.select(key, F.lit("FAIL").alias("level"), F.lit("batch.entry_id_duplicate").alias("code"), F.col("id").alias("message")))


def final_rules(rows: DataFrame, key: str = "batch_id", revised: Column | None = None) -> DataFrame:
    """Findings on finished translations: drafts, raw marks, lost revision marks, repeats, short ones, labels."""
    c = F.col
    w = runs.ordered([key, "part"], ["ordinal"])
    bare = F.regexp_replace("translation", "\\s+", "")
    starred = c("source").rlike("(^|\\s)\\*\\s*$")
    rows = rows.withColumn("bare", bare).withColumn("before", F.lag("bare").over(w)).withColumn("before_id", F.lag("id").over(w))
    stars = F.sum(starred.cast("int")).over(runs.Window.partitionBy(key))
    rows = rows.withColumn("star_needed", (stars >= REVISIONS) | ((stars > 0) & (F.lit(False) if revised is None else revised)))
    n_cjk = F.length("translation") - F.length(F.regexp_replace("translation", "[\\x{3400}-\\x{9fff}]", ""))
    body = c("part") == "body"
    rules = [
        finding(F.trim("translation").rlike(DRAFT), "FAIL", "batch.final.placeholder_translation", c("id")),
        finding(c("translation").rlike(RAW_MARK), "FAIL", "batch.final.raw_format_marker", c("id")),
        finding(starred & c("star_needed") & ~c("translation").rlike("\\[\\[\\*\\]\\]\\s*$"), "FAIL", "batch.final.revision_asterisk_missing", c("id")),
        finding(body & (c("bare") == c("before")) & (F.length("bare") >= DUPLICATE_LENGTH), "WARN", "batch.final.adjacent_duplicate_translation", F.concat_ws(",", "before_id", "id")),
        finding(body & (c("type") == "action") & (F.length("source") >= SHORT_SOURCE) & (n_cjk < SHORT_TARGET), "WARN", "batch.final.short_action_translation", c("id")),
    ]
    unlabelled = body & c("has_subtitles") & (c("type") == "dialogue") & c("subtitle_label").isNull()
    # Counts and first ids only: no list of a batch's entries is made.
    place = F.row_number().over(runs.ordered([key, "unlabelled"], ["part", "ordinal"]))
    marked = rows.select(key, "part", "ordinal", "id", F.when(body, c("subtitle_label")).alias("label"), F.coalesce(unlabelled, F.lit(False)).alias("unlabelled"), F.coalesce(F.regexp_count("translation", F.lit(MARKUP)), F.lit(0)).alias("n_markup")).withColumn("place", place)
    per = marked.groupBy(key).agg(
        F.sum("n_markup").alias("n_markup"), F.count_if("unlabelled").alias("n_missing"), F.array_sort(F.collect_list(F.when(c("unlabelled") & (c("place") <= PREVIEW), F.struct("place", "id")))).alias("first"), *[F.count_if(c("label") == x).alias(x) for x in LABELS]
    )
    summary = F.concat_ws(" ", *[F.when(F.col(x) > 0, F.concat(F.lit(f"{x}="), F.col(x).cast("string"))) for x in sorted(LABELS)])
    preview = F.concat(F.array_join(F.transform("first", lambda x: x["id"]), ","), F.when(c("n_missing") > PREVIEW, F.concat(F.lit(" total="), c("n_missing").cast("string"))).otherwise(""))
    batch = [
        finding(c("n_markup") == 0, "WARN", "batch.final.no_inline_reader_markup"),
        finding(summary != "", "INFO", "batch.final.subtitle_labels", summary),
        finding(c("n_missing") > 0, "FAIL", "batch.final.missing_subtitle_labels", preview),
    ]
    return exploded(rows, [key], rules).unionByName(exploded(per, [key], batch))


def batch_rules(batches: DataFrame, key: str = "batch_id") -> DataFrame:
    """Findings on the head of batches (rows of ``sources.batches.read_batches``)."""
    c = F.col
    pages = F.concat(F.lit("start="), F.coalesce(c("source_pages.start").cast("string"), F.lit("")), F.lit(" end="), F.coalesce(c("source_pages.end").cast("string"), F.lit("")))
    rules = [
        finding(F.coalesce(c("version") != 1, F.lit(True)), "FAIL", "batch.version", F.lit("version must be 1")),
        finding(blank(c("batch_id")), "FAIL", "batch.batch_id", F.lit("batch_id missing")),
        finding(c("source_pages").isNull(), "FAIL", "batch.source_pages", F.lit("source_pages must be object")),
        finding(c("source_pages").isNotNull() & F.coalesce(c("source_pages.start") > c("source_pages.end"), F.lit(True)), "FAIL", "batch.source_pages_range", pages),
        finding(F.coalesce(F.size("entries"), F.lit(0)) <= 0, "FAIL", "batch.entries", F.lit("entries must be a non-empty list")),
    ]
    return exploded(batches, [key], rules)


def validate(batches: DataFrame, final: bool = False, key: str = "batch_id") -> DataFrame:
    """All findings of each batch; a batch without one is reported as valid.  ``key`` names a column without nulls, such as a path."""
    rows = b.entries(batches, key)
    found = batch_rules(batches, key).unionByName(entry_rules(rows, key))
    found = found.unionByName(final_rules(rows, key)) if final else found
    valid = batches.join(found.select(key).distinct(), key, "left_anti")
    return found.unionByName(valid.select(key, F.lit("INFO").alias("level"), F.lit("batch.valid").alias("code"), F.concat(F.lit("entries="), F.size("entries").cast("string")).alias("message")))


def draft_rules(rows: DataFrame, key: str = "batch_id") -> DataFrame:
    """Findings on drafts, from ``key, part, ordinal, id, type, source, translation, markers``.

    Counts of entries by type and of placeholders; dialogue without a cue, cues and headings without their markers, and
    parentheses that a run of parentheticals leaves open: the run's last one that opens or closes decides.
    """
    c = F.col
    order = runs.ordered([key, "part"], ["ordinal"])
    said = F.concat_ws(" source=", "id", "body")

    def without(kind: str) -> Column:
        return ~F.coalesce(F.exists("markers", lambda m: m["type"] == kind), F.lit(False))

    rows = rows.withColumn("body", F.trim(F.coalesce("source", F.lit("")))).withColumn("before", F.coalesce(F.lag("type").over(order), F.lit("")))
    heading = F.lit(False)
    for start in HEADINGS:
        heading = heading | c("body").startswith(start)
    rules = [
        finding((c("type") == "dialogue") & ~c("before").isin("character", "dialogue", "parenthetical"), "WARN", "draft.dialogue_without_character", said),
        finding((c("type") == "scene_heading") & heading & without("scene_no"), "WARN", "draft.scene_heading_without_scene_no", said),
        finding((c("type") == "character") & c("body").endswith("(CONT'D)") & without("contd"), "WARN", "draft.contd_text_without_marker", said),
    ]
    counts = rows.groupBy(key, F.coalesce("type", F.lit("None")).alias("type")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(key, F.lit("INFO").alias("level"), F.lit("draft.entry_count").alias("code"), F.concat_ws("=", "type", c("n").cast("string")).alias("message"))
    drafts = rows.groupBy(key).agg(F.count_if(F.trim("translation").rlike(DRAFT)).alias("n")).filter("n > 0")
    drafts = drafts.select(key, F.lit("INFO").alias("level"), F.lit("draft.placeholder_translations").alias("code"), F.concat(F.lit("count="), "n").alias("message"))
    wrylies = runs.islands(rows, [key, "part"], ["ordinal"], (c("type") == "parenthetical") != (c("before") == "parenthetical"), "run").filter("type = 'parenthetical'")
    closes = c("body").endswith(")")
    opens = c("body").startswith("(") & ~closes
    last = wrylies.groupBy(key, "part", "run").agg(F.max_by(F.struct(opens.alias("open"), "id"), F.when(opens | closes, c("ordinal"))).alias("last")).filter("last.open")
    unclosed = last.select(key, F.lit("WARN").alias("level"), F.lit("draft.parenthetical_unclosed").alias("code"), F.col("last.id").alias("message"))
    return exploded(rows, [key], rules).unionByName(counts).unionByName(drafts).unionByName(unclosed)


def severity(findings: DataFrame, key: str = "batch_id") -> DataFrame:
    """Counts per level and the gate's state of each batch."""
    n = findings.groupBy(key).agg(*[F.count_if(F.col("level") == x).alias(x.lower()) for x in ("FAIL", "WARN", "INFO")])
    return n.withColumn("state", F.when(F.col("fail") > 0, "FAIL").when(F.col("warn") > 0, "WARN").otherwise("PASS"))


# What a rendered page must not hold (level, pattern, hits allowed).
HTML_MARKS = {
    "html.task_label": ("FAIL", "任务\\s*\\d+|(?i:task)-\\d+", 0),
    "html.debug": ("FAIL", "(?i)DEBUG|TODO", 0),
    "html.generic_action": ("FAIL", "剧本在这一动作段落推进场面、人物位置和情绪状态", 0),
    "html.subtitle_labels_without_subtitles": ("FAIL", "字幕匹配|字幕差异|字幕未见", 0),
    "html.scene_index_titles": ("WARN", "场次索引", 1),
    "html.raw_parenthetical_markers": ("WARN", "\\((?:CONT'D|MORE|O\\.S\\.|O\\.C\\.|V\\.O\\.)\\)", 0),
}


def html_rules(pages: DataFrame, key: str = "page_id", column: str = "html") -> DataFrame:
    """Findings on rendered pages with how often each is hit: work notes, stock phrases, labels without captions, several scene indexes, raw marks."""
    text = t.strip_tags(F.col(column))

    def found(pattern: str, level: str, code: str, more_than: int = 0) -> Column:
        n = F.regexp_count(text, F.lit(pattern))
        return finding(n > more_than, level, code, F.concat(F.lit("hits="), n.cast("string")))

    rules = [found(pattern, level, code, more) for code, (level, pattern, more) in HTML_MARKS.items()]
    return exploded(pages, [key], rules)


def conversation_batches(spark, d) -> DataFrame:
    """Conversations as batches: a turn is an entry, a system turn a scene heading; some lack a translation or a page."""
    rows = table(spark, d, "conversations")
    kind = F.when(F.col("role") == "user", "dialogue").when(F.col("role") == "assistant", "action").otherwise("system")
    schema = spark.createDataFrame([], f"e {b.ENTRY}").schema["e"].dataType
    known = {
        "id": F.concat(F.lit("e"), (F.col("turn") - F.col("turn") % 3 % 2).cast("string")),
        "type": kind,
        "pdf_page": F.lit(1),
        "display_page": F.when(F.col("turn") != 4, F.lit(1)),
        "source": F.col("text"),
        "translation": F.when(F.col("turn") % 4 == 3, F.lit(" ")).otherwise(F.col("text")),
        "subtitle_label": F.when(F.col("turn") == 2, LABELS[0]),
    }
    entry = F.struct(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", entry.alias("entry")))).alias("e"))
    nothing = F.array().cast(f"array<{b.ENTRY}>")
    return grouped.select(F.col("conv_id").cast("string").alias("batch_id"), F.lit(1).alias("version"), (F.col("conv_id") % 2 == 0).alias("has_subtitles"), nothing.alias("front_matter"), F.transform("e", lambda x: x["entry"]).alias("entries"), F.struct((F.col("conv_id") % 5).cast("int").alias("start"), F.lit(3).alias("end")).alias("source_pages"))


_ENTRIES = f"(SELECT CAST(conv_id AS VARCHAR) AS batch_id, turn, conv_id % 2 = 0 AS subs, 'e' || (turn - turn % 3 % 2) AS id, CASE role WHEN 'user' THEN 'dialogue' WHEN 'assistant' THEN 'action' ELSE 'system' END AS type, CASE WHEN turn % 4 = 3 THEN ' ' ELSE text END AS translation, text AS source, CASE WHEN turn = 2 THEN '{LABELS[0]}' END AS label FROM conversations)"
_FOUND = f"""
SELECT batch_id, 'batch.entry_kind' AS code, id AS message FROM {_ENTRIES} WHERE type = 'system'
UNION ALL SELECT batch_id, 'batch.page', id FROM {_ENTRIES} WHERE turn = 4
UNION ALL SELECT batch_id, 'batch.source', id FROM {_ENTRIES} WHERE regexp_full_match(source, '\\s*')
UNION ALL SELECT batch_id, 'batch.translation', id FROM {_ENTRIES} WHERE regexp_full_match(translation, '\\s*')
UNION ALL SELECT batch_id, 'batch.subtitle_without_source', id FROM {_ENTRIES} WHERE label IS NOT NULL AND NOT subs
UNION ALL SELECT batch_id, 'batch.entry_id_duplicate', id FROM (SELECT batch_id, id, row_number() OVER (PARTITION BY batch_id, id ORDER BY turn) AS k FROM {_ENTRIES}) WHERE k > 1
UNION ALL SELECT DISTINCT CAST(conv_id AS VARCHAR), 'batch.source_pages_range', 'start=' || (conv_id % 5) || ' end=3' FROM conversations WHERE conv_id % 5 > 3"""


def _batch_findings(spark, d):
    return validate(conversation_batches(spark, d)).select("batch_id", "code", "message")


QUERIES["V01_batch_rules"] = _batch_findings
SQL["V01_batch_rules"] = f"WITH f AS ({_FOUND}) SELECT * FROM f UNION ALL SELECT CAST(conv_id AS VARCHAR), 'batch.valid', 'entries=' || count(*) FROM conversations WHERE CAST(conv_id AS VARCHAR) NOT IN (SELECT batch_id FROM f) GROUP BY conv_id"


def _severity(spark, d):
    return severity(validate(conversation_batches(spark, d))).select("batch_id", "fail", "state")


QUERIES["O09_batch_severity"] = _severity
SQL["O09_batch_severity"] = f"WITH f AS ({_FOUND}), n AS (SELECT batch_id, count(*) AS fail FROM f GROUP BY batch_id) SELECT c.batch_id, coalesce(fail, 0) AS fail, CASE WHEN fail > 0 THEN 'FAIL' ELSE 'PASS' END AS state FROM (SELECT DISTINCT CAST(conv_id AS VARCHAR) AS batch_id FROM conversations) c LEFT JOIN n USING (batch_id)"


def _html_findings(spark, d):
    noted = F.element_at(F.array(*map(F.lit, _NOTES)), (F.col("page_id") % len(_NOTES) + 1).cast("int"))
    return html_rules(table(spark, d, "pages").select("page_id", F.concat("html", noted).alias("html")))


QUERIES["V02_html_rules"] = _html_findings
#: What the query writes under its pages, so that every rule has hits and misses.
_NOTES = ("", "<p>任务 12, task-3</p>", "<p>Debug: todo</p>", "<b>字幕未见</b>", "<h2>场次索引</h2><h2>场次索引</h2>", "<h2>场次索引</h2>(MORE) (V.O.) (CONT'D)", "剧本在这一动作段落推进场面、人物位置和情绪状态")
_NOTED = "html || [" + ", ".join("'" + n.replace("'", "''") + "'" for n in _NOTES) + f"][page_id % {len(_NOTES)} + 1]"
SQL["V02_html_rules"] = " UNION ALL ".join(
    "SELECT page_id, '{0}' AS level, '{1}' AS code, 'hits=' || n AS message FROM (SELECT page_id, len(regexp_extract_all(regexp_replace({2}, '<[^>]+>', '', 'g'), '{3}')) AS n FROM pages) WHERE n > {4}".format(level, code, _NOTED, pattern.replace("'", "''"), more)
    for code, (level, pattern, more) in HTML_MARKS.items()
)


#: Lines as draft entries: some have markers, some a placeholder for a translation, some names go on.
_DRAFTED = {
    "id": "concat('e', cast(line_no AS STRING))",
    "source": "line || CASE line_no % 4 WHEN 1 THEN ' (CONT''D)' ELSE '' END",
    "translation": "CASE line_no % 11 WHEN 4 THEN '待译对白：' || line WHEN 7 THEN '__' || line || '__' ELSE line END || CASE WHEN line_no % 10 = 0 THEN ' [[*]]' ELSE '' END",
    "subtitle_label": "CASE line_no % 6 WHEN 1 THEN '字幕匹配' WHEN 2 THEN '字幕差异' WHEN 4 THEN '字幕未见' END",
}


def _drafted(spark, d):
    rows = script.dialogues(spark, d).select("doc_id", F.col("line_no").alias("ordinal"), F.lit("body").alias("part"), F.col("kind").alias("type"), "line", "line_no", *[F.expr(x).alias(n) for n, x in _DRAFTED.items()])
    marker = F.when(F.col("line_no") % 3 == 1, "contd").when(F.col("line_no") % 4 == 2, "scene_no")
    return rows.withColumn("markers", F.when(marker.isNotNull(), F.array(F.struct(marker.alias("type"))))).withColumn("has_subtitles", F.col("doc_id") % 2 == 0)


def _draft_findings(spark, d):
    return draft_rules(_drafted(spark, d), "doc_id").select("doc_id", "level", "code", "message")


_DRAFT_ROWS = (
    f"(SELECT *, trim(source) AS body, lag(type) OVER w AS before FROM (SELECT doc_id, line_no, kind AS type, line, 'e' || line_no AS id, {_DRAFTED['source']} AS source, {_DRAFTED['translation']} AS translation, {_DRAFTED['subtitle_label']} AS label, doc_id % 2 = 0 AS subs,"
    f" CASE WHEN line_no % 3 = 1 THEN 'contd' WHEN line_no % 4 = 2 THEN 'scene_no' END AS marker FROM {script.DIALOGUE}) WINDOW w AS (PARTITION BY doc_id ORDER BY line_no))"
)
QUERIES["V03_draft_rules"] = _draft_findings
SQL["V03_draft_rules"] = (
    f"WITH e AS MATERIALIZED (SELECT * FROM {_DRAFT_ROWS}), p AS (SELECT doc_id, line_no, id, type, starts_with(body, '(') AND NOT ends_with(body, ')') AS opens, ends_with(body, ')') AS closes, sum(CASE WHEN (type = 'parenthetical') <> coalesce(before = 'parenthetical', false) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS run FROM e)"
    " SELECT doc_id, 'INFO' AS level, 'draft.entry_count' AS code, type || '=' || count(*) AS message FROM e GROUP BY doc_id, type"
    f" UNION ALL SELECT doc_id, 'INFO', 'draft.placeholder_translations', 'count=' || count(*) FROM e WHERE regexp_matches(trim(translation), '{DRAFT}') GROUP BY doc_id"
    " UNION ALL SELECT doc_id, 'WARN', 'draft.dialogue_without_character', id || ' source=' || body FROM e WHERE type = 'dialogue' AND coalesce(before, '') NOT IN ('character', 'dialogue', 'parenthetical')"
    " UNION ALL SELECT doc_id, 'WARN', 'draft.scene_heading_without_scene_no', id || ' source=' || body FROM e WHERE type = 'scene_heading' AND regexp_matches(body, '^(INT|EXT|I/E)') AND coalesce(marker, '') <> 'scene_no'"
    " UNION ALL SELECT doc_id, 'WARN', 'draft.contd_text_without_marker', id || ' source=' || body FROM e WHERE type = 'character' AND ends_with(body, '(CONT''D)') AND coalesce(marker, '') <> 'contd'"
    " UNION ALL SELECT doc_id, 'WARN', 'draft.parenthetical_unclosed', id FROM (SELECT doc_id, run, arg_max(id, line_no) AS id, arg_max(opens, line_no) AS opens FROM p WHERE type = 'parenthetical' AND (opens OR closes) GROUP BY doc_id, run) WHERE opens"
)


def _final_findings(spark, d):
    return final_rules(_drafted(spark, d), "doc_id").select("doc_id", "level", "code", "message")


#: The same marks for SQL, which knows no lookaround: a match needs another character or an end on both sides.
_RAW_SQL = "(^|[^A-Za-z])" + RAW_MARK.removeprefix("(?<![A-Za-z])").removesuffix("(?![A-Za-z])").replace("'", "''") + "($|[^A-Za-z])"
_LONE = "replace(replace(translation, '**', repeat(chr(1), 2)), chr(1) || '*', repeat(chr(1), 2))"
_MARKED_UP = f"(regexp_matches(translation, '\\[\\[.+?\\]\\]|__.+?__|\\*\\*.+?\\*\\*') OR regexp_matches({_LONE}, '\\*.+?\\*'))"
QUERIES["V12_final_rules"] = _final_findings
SQL["V12_final_rules"] = (
    f"WITH e AS MATERIALIZED (SELECT *, regexp_replace(translation, '\\s+', '', 'g') AS bare, regexp_matches(source, '(^|\\s)\\*\\s*$') AS starred FROM {_DRAFT_ROWS}),"
    " f AS (SELECT *, count(*) FILTER (starred) OVER (PARTITION BY doc_id) AS stars, lag(bare) OVER (PARTITION BY doc_id ORDER BY line_no) AS bare_before, lag(id) OVER (PARTITION BY doc_id ORDER BY line_no) AS id_before FROM e),"
    " m AS (SELECT doc_id, id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS k, count(*) OVER (PARTITION BY doc_id) AS n FROM e WHERE subs AND type = 'dialogue' AND label IS NULL)"
    f" SELECT doc_id, 'FAIL' AS level, 'batch.final.placeholder_translation' AS code, id AS message FROM f WHERE regexp_matches(trim(translation), '{DRAFT}')"
    f" UNION ALL SELECT doc_id, 'FAIL', 'batch.final.raw_format_marker', id FROM f WHERE regexp_matches(translation, '{_RAW_SQL}')"
    f" UNION ALL SELECT doc_id, 'FAIL', 'batch.final.revision_asterisk_missing', id FROM f WHERE starred AND stars >= {REVISIONS} AND NOT regexp_matches(translation, '\\[\\[\\*\\]\\]\\s*$')"
    f" UNION ALL SELECT doc_id, 'WARN', 'batch.final.adjacent_duplicate_translation', id_before || ',' || id FROM f WHERE bare = bare_before AND length(bare) >= {DUPLICATE_LENGTH}"
    f" UNION ALL SELECT doc_id, 'WARN', 'batch.final.short_action_translation', id FROM f WHERE type = 'action' AND length(source) >= {SHORT_SOURCE} AND length(translation) - length(regexp_replace(translation, '[\\x{{3400}}-\\x{{9fff}}]', '', 'g')) < {SHORT_TARGET}"
    f" UNION ALL SELECT doc_id, 'WARN', 'batch.final.no_inline_reader_markup', '' FROM f GROUP BY doc_id HAVING count(*) FILTER ({_MARKED_UP}) = 0"
    " UNION ALL SELECT doc_id, 'INFO', 'batch.final.subtitle_labels', string_agg(label || '=' || n, ' ' ORDER BY label) FROM (SELECT doc_id, label, count(*) AS n FROM f WHERE label IS NOT NULL GROUP BY doc_id, label) GROUP BY doc_id"
    f" UNION ALL SELECT doc_id, 'FAIL', 'batch.final.missing_subtitle_labels', string_agg(id, ',' ORDER BY k) FILTER (k <= {PREVIEW}) || CASE WHEN max(n) > {PREVIEW} THEN ' total=' || max(n) ELSE '' END FROM m GROUP BY doc_id"
)
