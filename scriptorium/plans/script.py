"""Script lines: shape, side, route and kind of lines, dialogue runs, reflow, scenes, as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import script as s
from scriptorium.functions import text as t
from scriptorium.operators import runs
from scriptorium.sources.tables import LINES, lines, table

QUERIES, SQL = {}, {}
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return register


def placed(spark, d):
    """Lines with a place on the page; some are in capitals, headings, in parentheses (some left open), or carry a revision mark."""
    n = F.col("line_no")
    body = F.when(n % 3 == 0, F.translate("line", LOWER, UPPER)).otherwise(F.col("line"))
    head = [F.when((n % 7 == 2) | (n % 11 == 4), "(").otherwise(""), F.when(n % 13 == 6, "INT. ").otherwise("")]
    tail = [F.when(n % 7 == 2, ")").otherwise(""), F.when(n % 5 == 0, " *").otherwise("")]
    label = F.concat(n.cast("string"), F.when(n % 2 == 0, "A").otherwise(""))
    line = F.when(n % 17 == 8, label).otherwise(F.concat(*head, body, *tail))
    x = ((F.col("line_no") * 37 + F.col("doc_id")) % 600).cast("double")
    return lines(spark, d).select("doc_id", "line_no", x.alias("x"), line.alias("line"))


PLACED = f"(SELECT doc_id, line_no, CAST((line_no * 37 + doc_id) % 600 AS DOUBLE) AS x, CASE WHEN line_no % 17 = 8 THEN line_no || (CASE WHEN line_no % 2 = 0 THEN 'A' ELSE '' END) ELSE (CASE WHEN line_no % 7 = 2 OR line_no % 11 = 4 THEN '(' ELSE '' END) || (CASE WHEN line_no % 13 = 6 THEN 'INT. ' ELSE '' END) || (CASE WHEN line_no % 3 = 0 THEN translate(line, '{LOWER}', '{UPPER}') ELSE line END) || (CASE WHEN line_no % 7 = 2 THEN ')' ELSE '' END) || (CASE WHEN line_no % 5 = 0 THEN ' *' ELSE '' END) END AS line FROM {LINES})"
SIDE = "CASE WHEN x <= 96 THEN 'left' WHEN x >= 516 THEN 'right' END"
ONE_SPACE = "trim(regexp_replace(line, '\\s+', ' ', 'g'))"
LABEL = f"upper({ONE_SPACE})"
IS_LABEL = f"(length({LABEL}) <= 24 AND {LABEL} NOT IN ('MORE', '(MORE)', 'OMITTED', 'OMMITTED') AND regexp_matches({LABEL}, '{s.LABEL}') AND (regexp_full_match({LABEL}, '[IVXLCDM]+|[A-Z]') OR regexp_matches({LABEL}, '[0-9]')))"
_SHAPE, _CAPITALS = (p.replace("'", "''") for p in (s.SHAPE, s.CAPITALS))
SHAPE = f"(length({ONE_SPACE}) <= 80 AND (regexp_matches({ONE_SPACE}, '{_SHAPE}') OR regexp_matches({ONE_SPACE}, '{_CAPITALS}')))"
UPPERISH = "(length(regexp_replace(line, '[^A-Za-z]', '', 'g')) > 0 AND length(regexp_replace(line, '[^A-Z]', '', 'g')) / length(regexp_replace(line, '[^A-Za-z]', '', 'g')) > 0.8)"
KIND = f"CASE WHEN regexp_full_match(trim(line), '\\d{{1,9}}\\.?') THEN 'page_heading' WHEN regexp_matches(trim(line), '{s.HEADING}') THEN 'scene_heading' WHEN starts_with(trim(line), '(') THEN 'parenthetical' WHEN {UPPERISH} AND regexp_matches(trim(line), '{s.TRANSITION}') THEN 'transition' WHEN {UPPERISH} AND length(trim(line)) <= 40 AND x >= 220 THEN 'character' WHEN {UPPERISH} AND length(trim(line)) <= 40 THEN 'format_marker' ELSE 'action' END"
KINDS = f"(SELECT doc_id, line_no, x, line, {KIND} AS kind FROM {PLACED})"
ORDER = "(PARTITION BY doc_id ORDER BY line_no)"
FLOW = "(kind = 'parenthetical' OR (kind IN ('action', 'format_marker') AND x >= 160))"
DIALOGUE = f"(SELECT doc_id, line_no, x, line, CASE WHEN kind <> 'parenthetical' AND {FLOW} AND last_value(CASE WHEN NOT {FLOW} THEN kind END IGNORE NULLS) OVER {ORDER} = 'character' THEN 'dialogue' ELSE kind END AS kind FROM {KINDS})"


def kinds(spark, d):
    return placed(spark, d).withColumn("kind", s.entry_kind(F.col("line"), F.col("x")))


def dialogues(spark, d):
    return runs.with_dialogue(kinds(spark, d), ["doc_id"], ["line_no"], "kind", F.col("x") >= s.DIALOGUE_X)


@query("P07_structural_shape", f"SELECT doc_id, line_no FROM {PLACED} WHERE {SHAPE}")
def p07(spark, d):
    return placed(spark, d).filter(s.structural_shape(F.col("line"))).select("doc_id", "line_no")


@query("P09_margin_side", f"SELECT side, count(*) AS n FROM (SELECT {SIDE} AS side FROM {PLACED}) WHERE side IS NOT NULL GROUP BY side")
def p09(spark, d):
    return placed(spark, d).select(s.margin_side(F.col("x")).alias("side")).filter("side is not null").groupBy("side").agg(F.count("*").alias("n"))


ROUTE = f"CASE WHEN {IS_LABEL} AND ({SIDE}) IS NOT NULL THEN 'marker' WHEN {IS_LABEL} OR ({SIDE}) IS NOT NULL THEN 'noise' WHEN {SHAPE} THEN 'unclassified' END"


@query("P10_signal_route", f"SELECT route, count(*) AS n FROM (SELECT {ROUTE} AS route FROM {PLACED}) WHERE route IS NOT NULL GROUP BY route")
def p10(spark, d):
    route = s.signal_route(F.col("line"), F.col("x"))
    return placed(spark, d).select(route.alias("route")).filter("route is not null").groupBy("route").agg(F.count("*").alias("n"))


@query("P27_capped_signals", f"SELECT route, doc_id, line_no FROM (SELECT route, doc_id, line_no, row_number() OVER (PARTITION BY route ORDER BY doc_id, line_no) AS k FROM (SELECT {ROUTE} AS route, doc_id, line_no FROM {PLACED}) WHERE route IS NOT NULL) WHERE k <= 40")
def p27(spark, d):
    rows = placed(spark, d).select(s.signal_route(F.col("line"), F.col("x")).alias("route"), "doc_id", "line_no").filter("route is not null")
    return runs.first_rows(rows, ["route"], ["doc_id", "line_no"], 40).select("route", "doc_id", "line_no")


@query("P11_entry_kind", f"SELECT doc_id, line_no, kind FROM {DIALOGUE}")
def p11(spark, d):
    return dialogues(spark, d).select("doc_id", "line_no", "kind")


@query("W01_dialogue_runs", f"SELECT kind, count(*) AS n FROM {DIALOGUE} GROUP BY kind")
def w01(spark, d):
    return dialogues(spark, d).groupBy("kind").agg(F.count("*").alias("n"))


@query("P19_revised", f"SELECT doc_id, count(*) AS n FROM {PLACED} WHERE regexp_matches(line, '\\s\\*$') GROUP BY doc_id")
def p19(spark, d):
    return placed(spark, d).filter(s.asterisk(F.col("line"))).groupBy("doc_id").agg(F.count("*").alias("n"))


@query("W02_open_parenthesis", f"SELECT doc_id, line_no FROM (SELECT doc_id, line_no, lag(line) OVER {ORDER} AS before FROM {PLACED}) WHERE starts_with(before, '(') AND NOT ends_with(before, ')')")
def w02(spark, d):
    rows = placed(spark, d).withColumn("before", F.lag("line").over(runs.ordered(["doc_id"], ["line_no"])))
    return rows.filter(F.col("before").startswith("(") & ~F.col("before").endswith(")")).select("doc_id", "line_no")


@query("W09_scene_carry", f"SELECT doc_id, line_no, last_value(CASE WHEN kind = 'scene_heading' THEN line_no END IGNORE NULLS) OVER {ORDER} AS heading FROM {KINDS}")
def w09(spark, d):
    heading = runs.carried(F.when(F.col("kind") == "scene_heading", F.col("line_no")), ["doc_id"], ["line_no"])
    return kinds(spark, d).select("doc_id", "line_no", heading.alias("heading"))


@query("W17_gap_join", f"SELECT doc_id, line_no // 10 AS page, string_agg((CASE WHEN x - before > 10 THEN ' ' ELSE '' END) || line, '' ORDER BY line_no) AS joined FROM (SELECT doc_id, line_no, x, line, lag(x) OVER (PARTITION BY doc_id, line_no // 10 ORDER BY line_no) AS before FROM {PLACED}) GROUP BY ALL")
def w17(spark, d):
    rows = placed(spark, d).withColumn("page", F.expr("cast(line_no div 10 as int)"))
    gap = F.col("x") - F.lag("x").over(runs.ordered(["doc_id", "page"], ["line_no"])) > 10
    rows = rows.withColumn("part", F.concat(F.when(gap, " ").otherwise(""), F.col("line")))
    parts = F.array_sort(F.collect_list(F.struct("line_no", "part")))
    return rows.groupBy("doc_id", "page").agg(F.array_join(F.transform(parts, lambda p: p["part"]), "").alias("joined"))


@query("W22_marker_slots", f"SELECT doc_id, line_no, CASE row_number() OVER {ORDER} WHEN 1 THEN 'left' ELSE 'right' END AS slot FROM {PLACED} WHERE {IS_LABEL}")
def w22(spark, d):
    rows = placed(spark, d).filter(s.scene_label(F.col("line")).isNotNull())
    place = F.row_number().over(runs.ordered(["doc_id"], ["line_no"]))
    return rows.select("doc_id", "line_no", F.when(place == 1, "left").otherwise("right").alias("slot"))


@query("P25_title_rows", f"SELECT doc_id, line_no FROM {LINES} WHERE line_no // 10 = 0 AND trim(line) <> '' AND NOT regexp_full_match(line, '\\d{{1,9}}\\.?')")
def p25(spark, d):
    line = F.col("line")
    return lines(spark, d).filter((F.col("line_no") < 10) & (F.trim(line) != "") & t.page_number(line).isNull()).select("doc_id", "line_no")


@query("P03_page_overlap", f"SELECT doc_id, line_no FROM {LINES} WHERE line_no // 10 + 1 BETWEEN 2 - 1 AND 3 + 1")
def p03(spark, d):
    return lines(spark, d).filter(F.expr("line_no div 10 + 1 between 2 - 1 and 3 + 1")).select("doc_id", "line_no")


@query("P04_excerpt", f"SELECT doc_id, line_no FROM {LINES} WHERE line_no BETWEEN 2 AND 30 ORDER BY doc_id, line_no LIMIT 160")
def p04(spark, d):
    return lines(spark, d).filter(F.col("line_no").between(2, 30)).select("doc_id", "line_no").orderBy("doc_id", "line_no").limit(160)


@query("G29_scan_counts", f"SELECT count(*) AS n, count(*) FILTER (WHERE {SHAPE}) AS shaped, count(*) FILTER (WHERE {IS_LABEL}) AS labels, count({SIDE}) AS in_margin FROM {PLACED}")
def g29(spark, d):
    line = F.col("line")
    return placed(spark, d).agg(F.count("*").alias("n"), F.count_if(s.structural_shape(line)).alias("shaped"), F.count(s.scene_label(line)).alias("labels"), F.count(s.margin_side(F.col("x"))).alias("in_margin"))


@query("G06_side_sets", f"SELECT doc_id, string_agg(DISTINCT side, ',' ORDER BY side) AS sides FROM (SELECT doc_id, {SIDE} AS side FROM {PLACED}) WHERE side IS NOT NULL GROUP BY doc_id")
def g06(spark, d):
    rows = placed(spark, d).select("doc_id", s.margin_side(F.col("x")).alias("side")).filter("side is not null")
    return rows.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("side")), ",").alias("sides"))


@query("G17_scene_counts", f"SELECT doc_id, heading, count(*) FILTER (WHERE kind = 'action') AS actions, count(*) FILTER (WHERE kind = 'dialogue') AS spoken, min(line_no) FILTER (WHERE kind = 'dialogue') AS first_spoken FROM (SELECT doc_id, line_no, kind, count(*) FILTER (WHERE kind = 'scene_heading') OVER {ORDER} AS heading FROM {DIALOGUE}) GROUP BY doc_id, heading")
def g17(spark, d):
    w = runs.ordered(["doc_id"], ["line_no"])
    rows = dialogues(spark, d).withColumn("heading", F.count_if(F.col("kind") == "scene_heading").over(w))
    kind = F.col("kind")
    return rows.groupBy("doc_id", "heading").agg(F.count_if(kind == "action").alias("actions"), F.count_if(kind == "dialogue").alias("spoken"), F.min(F.when(kind == "dialogue", F.col("line_no"))).alias("first_spoken"))


@query("T02_line_order", f"SELECT doc_id, line_no, row_number() OVER (PARTITION BY doc_id ORDER BY line_no // 10, x, line) AS place FROM {PLACED}")
def t02(spark, d):
    place = F.row_number().over(runs.ordered(["doc_id"], [F.expr("line_no div 10"), "x", "line"]))
    return placed(spark, d).select("doc_id", "line_no", place.alias("place"))


@query("F23_split_asterisk", f"SELECT doc_id, line_no, CASE WHEN line_no % 2 = 0 THEN regexp_replace(line, '\\s+$', '') ELSE line END AS body, line_no % 2 = 0 AS revised FROM {LINES}")
def f23(spark, d):
    parts = s.split_asterisk(F.when(F.col("line_no") % 2 == 0, F.concat("line", F.lit("[[*]]"))).otherwise(F.col("line")))
    return lines(spark, d).select("doc_id", "line_no", parts["body"].alias("body"), parts["revised"].alias("revised"))


@query("F10_token_key", f"SELECT doc_id, line_no, lower(replace(line, '’', '''')) AS value FROM {LINES}")
def f10(spark, d):
    return lines(spark, d).select("doc_id", "line_no", s.token_key(F.col("line")).alias("value"))


@query("F13_strip_ends", f"SELECT doc_id, line_no, trim(line, '.,!? ') AS value FROM {LINES}")
def f13(spark, d):
    return lines(spark, d).select("doc_id", "line_no", s.strip_ends(F.col("line"), ".,!? ").alias("value"))


@query("F18_millimetres", "SELECT p_partkey, round(p_size * 25.4 / 72, 4) > 10 AS wide FROM part")
def f18(spark, d):
    return table(spark, d, "part").select("p_partkey", (F.round(F.col("p_size") * 25.4 / 72, 4) > 10).alias("wide"))


@query("F27_divergence_label", "SELECT user_id, concat_ws('·', CASE WHEN c > 0 THEN c || '改' END, CASE WHEN e > 0 THEN e || '未见' END) AS label FROM (SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS c, count(*) FILTER (WHERE event_type = 'error') AS e FROM events GROUP BY user_id)")
def f27(spark, d):
    n = table(spark, d, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "click").alias("c"), F.count_if(F.col("event_type") == "error").alias("e"))
    return n.select("user_id", s.divergence_label(F.col("c"), F.col("e")).alias("label"))


@query("F29_table_cells", "SELECT p_partkey, p_brand || ';' || p_type AS cells, false AS rule FROM part")
def f29(spark, d):
    cells = s.table_cells(F.concat(F.lit("| "), "p_brand", F.lit(" | "), "p_type", F.lit(" |")))
    return table(spark, d, "part").select("p_partkey", F.array_join(cells, ";").alias("cells"), s.is_table_rule(cells).alias("rule"))


@query("F39_font_styles", "SELECT p_partkey, concat_ws(',', CASE WHEN p_partkey % 2 = 0 THEN 'bold' END, CASE WHEN p_partkey % 3 = 0 THEN 'italic' END) AS styles FROM part")
def f39(spark, d):
    key = F.col("p_partkey")
    name = F.concat(F.lit("ABCDEF+Courier"), F.when(key % 2 == 0, "Bold").otherwise(""), F.when(key % 3 == 0, "Oblique").otherwise(""))
    return table(spark, d, "part").select("p_partkey", s.font_styles(name).alias("styles"))


@query("F41_structure_preview", "SELECT conv_id, 'STRUCTURE PREVIEW turns: ' || string_agg(role, ' / ' ORDER BY turn, role) AS preview FROM conversations GROUP BY conv_id")
def f41(spark, d):
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("r"))
    return rows.select("conv_id", s.structure_preview(F.lit("turns"), F.transform("r", lambda x: x["role"])).alias("preview"))
