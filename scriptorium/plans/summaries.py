"""Summaries of captions, tails, styles and drafts, carried sections, and reading order, as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions import text as t
from scriptorium.operators import phrases, runs, scans
from scriptorium.plans import layout, rules, script, style
from scriptorium.sources.tables import LINES, lines, table

QUERIES, SQL = {}, {}
# Length of a long caption, seconds of a short one, entries of a tail, its speakers, terms of a style summary.
LONG, SHORT, TAIL, SPEAKERS, STYLE_TERMS = 42, 0.5, 8, 6, 20


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return register


def caption_quality(events: DataFrame, keys: list[str]) -> DataFrame:
    """Per key of ``keys, start, end, text``: events, last end, empty and repeated texts, kinds of line, long, short and zero events.

    Repeats are found by a digest, so no text is shuffled; counts are combined before the shuffle.
    """
    text = t.collapse_space(F.coalesce("text", F.lit("")))
    cjk, latin = text.rlike(style.CJK), text.rlike(style.LATIN)
    lasts = F.greatest(F.lit(0.0), F.coalesce(F.col("end") - F.col("start"), F.lit(0.0)))
    flags = {"n_empty": text == "", "n_cjk": cjk & ~latin, "n_latin": latin & ~cjk, "n_mixed": cjk & latin, "n_long": F.length(text) >= LONG, "n_short": (lasts > 0) & (lasts < SHORT), "n_zero": lasts == 0}
    rows = events.select(*keys, F.sha2(text, 256).alias("digest"), (text == "").alias("blank"), "end", *[c.cast("long").alias(n) for n, c in flags.items()])
    per = rows.groupBy(*keys, "digest", "blank").agg(F.count(F.lit(1)).alias("n"), F.max("end").alias("end"), *[F.sum(c).alias(c) for c in flags])
    again = F.sum(F.when(F.col("blank"), 0).otherwise(F.col("n") - 1))
    return per.groupBy(*keys).agg(F.sum("n").alias("n_events"), F.coalesce(F.max("end"), F.lit(0.0)).alias("seconds"), again.alias("n_repeated"), *[F.sum(c).alias(c) for c in flags])


#: Turns as events: some in Chinese, some blank, some that last no time.
_SAID = "CASE turn % 5 WHEN 1 THEN '灯塔。' WHEN 2 THEN text || ' 灯塔' WHEN 3 THEN ' ' ELSE text END"
_EVENTS = f"(SELECT role, turn * 1.5e0 AS start, turn * 1.5e0 + (length(text) % 7 - 1) * 0.2e0 AS stop, {_SAID} AS text FROM conversations)"


@query(
    "G11_quality_summary",
    f"WITH e AS (SELECT role, stop, greatest(0e0, stop - start) AS lasts, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM {_EVENTS}), k AS (SELECT *, regexp_matches(t, '{style.CJK}') AS cjk, regexp_matches(t, '{style.LATIN}') AS latin FROM e)"
    " SELECT role, count(*) AS n_events, max(stop) AS seconds, count(*) FILTER (t <> '') - count(DISTINCT t) FILTER (t <> '') AS n_repeated, count(*) FILTER (t = '') AS n_empty, count(*) FILTER (cjk AND NOT latin) AS n_cjk, count(*) FILTER (latin AND NOT cjk) AS n_latin, count(*) FILTER (cjk AND latin) AS n_mixed,"
    " count(*) FILTER (length(t) >= 42) AS n_long, count(*) FILTER (lasts > 0 AND lasts < 0.5) AS n_short, count(*) FILTER (lasts = 0) AS n_zero FROM k GROUP BY role",
)
def g11(spark, d):
    start = F.col("turn") * 1.5
    rows = table(spark, d, "conversations").select("role", start.alias("start"), (start + (F.length("text") % 7 - 1) * 0.2).alias("end"), F.expr(_SAID).alias("text"))
    return caption_quality(rows, ["role"])


def uncovered(items: DataFrame, key: str, texts: DataFrame) -> DataFrame:
    """Keys of items whose text, with single spaces, stands in no text; blank items are left out.  Texts are read once and not shuffled."""
    plain = t.collapse_space(F.col("text"))
    own = items.select(key, plain.alias("phrase")).filter("phrase <> ''")
    met = phrases.phrase_hits(texts.select(F.lit(0).alias("one"), plain.alias("text")), "one", "text", own, "phrase", False, False)
    return own.join(met.select("phrase").distinct(), "phrase", "left_anti").select(key)


_FLAT = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"


@query("J14_uncovered", f"SELECT item_id FROM (SELECT item_id, {_FLAT} AS x FROM benchmark) b WHERE NOT EXISTS (SELECT 1 FROM (SELECT {_FLAT} AS y FROM documents) WHERE contains(y, x))")
def j14(spark, d):
    return uncovered(table(spark, d, "benchmark"), "item_id", table(spark, d, "documents"))


def tail_statistics(entries: DataFrame, key: str, order: str) -> DataFrame:
    """``key, n, kinds, speakers`` of the last TAIL entries of ``key, order, kind, text``: counts by kind, and the first SPEAKERS names in order."""
    last = runs.first_rows(entries.select(key, order, "kind", "text"), [key], [F.desc(order)], TAIL)
    rows = last.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, "kind", F.trim(F.coalesce("text", F.lit(""))).alias("text")))).alias("e"))
    kinds = F.array_sort(F.array_distinct(F.transform("e", lambda x: x["kind"])))
    counted = F.transform(kinds, lambda k: F.concat_ws("=", k, F.size(F.filter("e", lambda x: x["kind"] == k)).cast("string")))
    names = F.array_distinct(F.transform(F.filter("e", lambda x: (x["kind"] == "character") & (x["text"] != "")), lambda x: x["text"]))
    return rows.select(key, F.size("e").cast("long").alias("n"), F.array_join(counted, " ").alias("kinds"), F.array_join(F.slice(names, 1, SPEAKERS), "|").alias("speakers"))


@query(
    "G24_tail_statistics",
    f"WITH e AS (SELECT doc_id, line_no, kind, trim(line) AS text FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no DESC) AS r FROM {script.DIALOGUE}) WHERE r <= {TAIL}),"
    " k AS (SELECT doc_id, string_agg(kind || '=' || n, ' ' ORDER BY kind) AS kinds, CAST(sum(n) AS BIGINT) AS n FROM (SELECT doc_id, kind, count(*) AS n FROM e GROUP BY doc_id, kind) GROUP BY doc_id),"
    f" s AS (SELECT doc_id, string_agg(text, '|' ORDER BY first) AS speakers FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY first) AS k FROM (SELECT doc_id, text, min(line_no) AS first FROM e WHERE kind = 'character' AND text <> '' GROUP BY doc_id, text)) WHERE k <= {SPEAKERS} GROUP BY doc_id)"
    " SELECT k.doc_id, n, kinds, coalesce(speakers, '') AS speakers FROM k LEFT JOIN s ON s.doc_id = k.doc_id",
)
def g24(spark, d):
    return tail_statistics(script.dialogues(spark, d).withColumn("text", F.col("line")), "doc_id", "line_no")


def draft_states(entries: DataFrame, key: str, order: str) -> DataFrame:
    """``key, order, before, open``: what an audit of drafts knows when it comes to an entry: the kind before it, and the
    parenthetical, if any, that is still open; one that a run of parentheticals leaves open is known to the entry behind it."""
    w = Window.partitionBy(key).orderBy(order)
    body = F.trim(F.coalesce("text", F.lit("")))
    closes = body.endswith(")")
    opens = body.startswith("(") & ~closes
    rows = entries.withColumn("before", F.lag("kind").over(w))
    new = (F.col("kind") == "parenthetical") != F.coalesce(F.col("before") == "parenthetical", F.lit(False))
    rows = rows.withColumn("run", F.sum(F.when(new, 1).otherwise(0)).over(w))
    event = F.when((F.col("kind") == "parenthetical") & (opens | closes), F.struct(F.when(opens, F.col("id")).alias("id")))
    after = F.last(event, ignorenulls=True).over(Window.partitionBy(key, "run").orderBy(order))["id"]
    return rows.withColumn("after", after).withColumn("open", F.lag("after").over(w)).select(key, order, "before", "open")


@query(
    "W12_draft_state",
    f"WITH e AS (SELECT doc_id, line_no, kind, trim(line) AS body, 'e' || line_no AS id, lag(kind) OVER (PARTITION BY doc_id ORDER BY line_no) AS before FROM {script.DIALOGUE}),"
    " r AS (SELECT *, sum(CASE WHEN (kind = 'parenthetical') <> coalesce(before = 'parenthetical', false) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS run, CASE WHEN kind = 'parenthetical' AND ends_with(body, ')') THEN '' WHEN kind = 'parenthetical' AND starts_with(body, '(') THEN id END AS event FROM e),"
    " s AS (SELECT *, last_value(event IGNORE NULLS) OVER (PARTITION BY doc_id, run ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS state FROM r)"
    " SELECT doc_id, line_no, before, nullif(lag(state) OVER (PARTITION BY doc_id ORDER BY line_no), '') AS open FROM s",
)
def w12(spark, d):
    rows = script.dialogues(spark, d).select("doc_id", "line_no", "kind", F.col("line").alias("text"), F.format_string("e%d", "line_no").alias("id"))
    return draft_states(rows, "doc_id", "line_no")


def carried_sections(rows: DataFrame, key: str, order: str) -> DataFrame:
    """``key, order, section, fields``: the section a line stands in, and the ``Format`` fields that hold there; a new section has none yet.

    Lines of one file may be cut over any number of tasks: both are carried by a scan.
    """
    line = F.trim("line")
    section = F.when(line.rlike("^\\[.*\\]$"), F.lower(F.regexp_extract(line, "^\\[(.*)\\]$", 1)))
    named = F.when(line.rlike("(?i)^format:"), F.regexp_replace(F.lower(F.regexp_replace(line, "(?i)^format:", "")), "\\s+", ""))
    news = rows.select(key, order, section.alias("own"), F.when(section.isNotNull(), "").otherwise(named).alias("named"))
    out = scans.carried(news, [key], [order], F.col("own"), "section")
    return scans.carried(out, [key], [order], F.col("named"), "fields").select(key, order, "section", F.nullif("fields", F.lit("")).alias("fields"))


_ASS = "CASE line_no % 12 WHEN 2 THEN '[Events] ' WHEN 3 THEN 'Format: Start, End, Text' WHEN 7 THEN '[V4+ Styles]' WHEN 9 THEN 'format:Name' ELSE line END"


@query(
    "W20_section_carry",
    f"WITH l AS (SELECT doc_id, line_no, trim({_ASS}) AS line FROM {LINES}), n AS (SELECT doc_id, line_no, CASE WHEN regexp_matches(line, '^\\[.*\\]$') THEN lower(regexp_extract(line, '^\\[(.*)\\]$', 1)) END AS own, CASE WHEN regexp_matches(line, '^(?i:format):') THEN regexp_replace(lower(regexp_replace(line, '^(?i:format):', '')), '\\s+', '', 'g') END AS named FROM l)"
    " SELECT doc_id, line_no, last_value(own IGNORE NULLS) OVER w AS section, nullif(last_value(CASE WHEN own IS NOT NULL THEN '' ELSE named END IGNORE NULLS) OVER w, '') AS fields FROM n WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING)",
)
def w20(spark, d):
    return carried_sections(lines(spark, d).select("doc_id", "line_no", F.expr(_ASS).alias("line")), "doc_id", "line_no")


@query("T01_reading_order", f"WITH {layout._FRAGMENTS} SELECT doc_id, seq, row_number() OVER (PARTITION BY doc_id ORDER BY y DESC, x, seq) AS place FROM r")
def t01(spark, d):
    """Fragments of a page from top to bottom, left to right, ties in the order they came."""
    rows = layout.fragments(spark, d).select("doc_id", "seq", "x", "y")
    return rows.select("doc_id", "seq", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("y"), "x", "seq")).alias("place"))


_WORDS = style.TOKEN.replace("'", "''")
_ENDS = "'" + style.ENDS.replace("'", "''") + "'"


@query(
    "P29_style_summary",
    f"WITH a AS ({style._tone_sql('lang', 'text', 'documents')}), b AS ({style._action_sql('lang', 'text', 'documents')}), t AS (SELECT lang, string_agg(term, ' ' ORDER BY k) AS terms FROM (SELECT lang, term, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, term) AS k FROM (SELECT lang, trim(unnest(regexp_extract_all(text, '{_WORDS}')), {_ENDS}) AS term FROM documents)"
    f" WHERE length(term) >= 2 AND (regexp_matches(term, '{style.CJK}') OR (lower(term) NOT IN {style.fixed.sql_list(style.fixed.STYLE_STOP_WORDS)} AND term <> lower(term))) GROUP BY lang, term) WHERE k <= {STYLE_TERMS} GROUP BY lang)"
    " SELECT a.lang, tone, action_style, coalesce(terms, '') AS terms FROM a JOIN b ON b.lang = a.lang LEFT JOIN t ON t.lang = a.lang",
)
def p29(spark, d):
    docs = table(spark, d, "documents").select("lang", "text")
    found = style.tone(docs, ["lang"], "text").join(style.action_style(docs, ["lang"], "text"), "lang").join(style.tendencies(docs, ["lang"], "text", STYLE_TERMS), "lang", "left")
    return found.select("lang", "tone", "action_style", F.coalesce(F.array_join(F.transform("terms", lambda x: x["term"]), " "), F.lit("")).alias("terms"))


@query("O22_revision_candidates", f"SELECT doc_id, count(*) FILTER (regexp_matches(line, '(^|\\s)\\*\\s*$')) AS n, count(*) FILTER (regexp_matches(line, '(^|\\s)\\*\\s*$')) >= {rules.REVISIONS} AS required FROM {script.PLACED} GROUP BY doc_id")
def o22(spark, d):
    n = F.count_if(F.col("line").rlike("(^|\\s)\\*\\s*$"))
    return script.placed(spark, d).groupBy("doc_id").agg(n.alias("n"), (n >= rules.REVISIONS).alias("required"))


@query("O25_marker_exists", f"SELECT doc_id, line_no FROM {rules._DRAFT_ROWS} WHERE marker = 'contd'")
def o25(spark, d):
    rows = rules._drafted(spark, d).select("doc_id", "line_no", "markers")
    return rows.filter(F.exists("markers", lambda m: m["type"] == "contd")).select("doc_id", "line_no")


# What is added for work around a translation, and for what a price holds.
OVERHEAD, PRICED_TOKENS = 1.35, 1_000_000


def cost_estimates(artifacts: DataFrame, projects: DataFrame, prices: DataFrame, key: str) -> DataFrame:
    """``key, status, missing``, tokens and cost of each project in ``projects (key, model, input_price, output_price, overhead)``.

    ``artifacts``: ``key, kind ('context' is read, 'translated' is written), bytes``; a file has a token for four bytes, one at
    least.  A price of the project's own counts before that of its model in ``prices (model, input, output)``; without
    both prices and a model nothing is estimated, and ``missing`` says why.  A null overhead is OVERHEAD.
    """
    tokens = lambda kind: F.sum(F.when(F.col("kind") == kind, t.token_proxy(F.col("bytes"))).otherwise(0))
    held = artifacts.groupBy(key).agg(tokens("context").alias("base_input"), tokens("translated").alias("base_output"))
    rows = projects.join(held, key, "left").join(prices.select("model", F.col("input").alias("model_input"), F.col("output").alias("model_output")), "model", "left")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("base_input", "base_output")})
    price = {c: F.coalesce(f"{c}_price", f"model_{c}") for c in ("input", "output")}
    overhead = F.coalesce("overhead", F.lit(OVERHEAD))
    rows = rows.withColumns({f"{c}_tokens": F.rint(F.col(f"base_{c}") * overhead).cast("long") for c in price} | {f"{c}_usd": p for c, p in price.items()})
    missing = F.concat_ws(",", F.when(F.col("model").isNull(), "model_name"), *[F.when(F.col(f"{c}_usd").isNull(), f"{c}_usd_per_million_tokens") for c in price])
    cost = sum(F.col(f"{c}_tokens") * F.col(f"{c}_usd") / PRICED_TOKENS for c in price)
    rows = rows.withColumn("missing", missing)
    return rows.select(key, F.when(F.col("missing") == "", "estimated").otherwise("not_estimated").alias("status"), "missing", "base_input", "base_output", "input_tokens", "output_tokens", F.when(F.col("missing") == "", cost).alias("cost"))


@query(
    "G16_cost_estimate",
    "WITH a AS (SELECT source, CASE WHEN doc_id % 3 = 0 THEN 'context' WHEN doc_id % 3 = 1 THEN 'translated' ELSE 'note' END AS kind, greatest(1, CAST(round_even(strlen(text) / 4, 0) AS BIGINT)) AS n FROM documents),"
    " h AS (SELECT source, CAST(sum(CASE WHEN kind = 'context' THEN n ELSE 0 END) AS BIGINT) AS base_input, CAST(sum(CASE WHEN kind = 'translated' THEN n ELSE 0 END) AS BIGINT) AS base_output FROM a GROUP BY source),"
    " p AS (SELECT DISTINCT source, CAST(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS BIGINT) AS k FROM documents),"
    " r AS (SELECT p.source, p.k, h.base_input, h.base_output, n.n_name AS model, CASE WHEN p.k % 4 = 0 THEN 2.5e0 ELSE n.n_regionkey * 0.5e0 + 1 END AS input_usd, CASE WHEN n.n_regionkey <> 2 THEN n.n_regionkey * 4e0 + 2 END AS output_usd, CASE WHEN p.k % 5 = 1 THEN 1.1e0 ELSE 1.35e0 END AS overhead FROM p JOIN h ON h.source = p.source LEFT JOIN nation n ON n.n_nationkey = p.k AND p.k % 7 <> 6),"
    " t AS (SELECT *, CAST(round_even(base_input * overhead, 0) AS BIGINT) AS input_tokens, CAST(round_even(base_output * overhead, 0) AS BIGINT) AS output_tokens, concat_ws(',', CASE WHEN model IS NULL THEN 'model_name' END, CASE WHEN input_usd IS NULL THEN 'input_usd_per_million_tokens' END, CASE WHEN output_usd IS NULL THEN 'output_usd_per_million_tokens' END) AS missing FROM r)"
    " SELECT source, CASE WHEN missing = '' THEN 'estimated' ELSE 'not_estimated' END AS status, missing, base_input, base_output, input_tokens, output_tokens, CASE WHEN missing = '' THEN input_tokens * input_usd / 1000000 + output_tokens * output_usd / 1000000 END AS cost FROM t",
)
def g16(spark, d):
    """Sources as projects, nations as models: some lack a model or a price, some have a price or an overhead of their own."""
    docs = table(spark, d, "documents").select("source", "doc_id", F.octet_length("text").alias("bytes"))
    kind = F.when(F.col("doc_id") % 3 == 0, "context").when(F.col("doc_id") % 3 == 1, "translated").otherwise("note")
    k = F.nullif(F.regexp_extract("source", "([0-9]+)$", 1), F.lit("")).cast("long")
    nation = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("k"), "n_name", "n_regionkey")
    projects = docs.select("source").distinct().withColumn("k", k).join(nation.filter("k % 7 <> 6").select("k", F.col("n_name").alias("model")), "k", "left")
    projects = projects.select("source", "model", F.when(F.col("k") % 4 == 0, 2.5).alias("input_price"), F.lit(None).cast("double").alias("output_price"), F.when(F.col("k") % 5 == 1, 1.1).alias("overhead"))
    prices = nation.select(F.col("n_name").alias("model"), (F.col("n_regionkey") * 0.5 + 1).alias("input"), F.when(F.col("n_regionkey") != 2, F.col("n_regionkey") * 4.0 + 2).alias("output"))
    return cost_estimates(docs.select("source", kind.alias("kind"), "bytes"), projects, prices, "source")
