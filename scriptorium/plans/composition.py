"""Batch plan, merge with timestamps and configuration values as queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.operators import runs
from scriptorium.sources.tables import table

QUERIES, SQL = {}, {}
# What a batch holds at most, its pages, labels of entries that a caption stands behind, and the title of a project that has none.
LIMITS = {"entries": 110, "dialogue": 65, "markers": 18}
LEAST_PAGES, MOST_PAGES = 5, 10
DEFAULT_TITLE = "剧本学习版"
MATCHED_LABELS = ("字幕匹配", "字幕差异")
STAMP = ("subtitle_event_index", "subtitle_start", "subtitle_end")


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return register


def batch_plan(pages: DataFrame, key: str, page: str) -> DataFrame:
    """Page ranges to work on, from the counts of each page: first and last page, sums, and whether a range is longer than the least."""
    binned = runs.page_bins(pages, [key], page, LIMITS, LEAST_PAGES, MOST_PAGES)
    ranges = binned.groupBy(key, "bin").agg(F.min(page).alias("first_page"), F.max(page).alias("last_page"), F.count("*").alias("page_count"), *(F.sum(c).alias(c) for c in LIMITS))
    return ranges.withColumn("risk", F.when(F.col("page_count") <= LEAST_PAGES, "standard").otherwise("low_density"))


_FULL = "b.entries + p.entries > 110 OR b.dialogue + p.dialogue > 65 OR b.markers + p.markers > 18"
_SUMS = ", ".join(f"CASE WHEN new THEN {c} ELSE {c} + {c}_before END" for c in LIMITS)


@query(
    "O03_batch_plan",
    "WITH RECURSIVE p AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM (SELECT o_custkey, o_orderkey, count(l_orderkey) AS entries, count(*) FILTER (l_returnflag = 'N') AS dialogue, count(*) FILTER (l_discount > 0.05) AS markers FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)),"
    " b AS (SELECT o_custkey, r, entries, dialogue, markers, 1 AS pages, 0 AS bin FROM p WHERE r = 1 UNION ALL"
    f" SELECT o_custkey, r, {_SUMS}, CASE WHEN new THEN 1 ELSE pages + 1 END, CASE WHEN new THEN bin + 1 ELSE bin END FROM (SELECT p.*, b.entries AS entries_before, b.dialogue AS dialogue_before, b.markers AS markers_before, b.pages, b.bin, b.pages >= 5 AND (b.pages >= 10 OR {_FULL}) AS new FROM b JOIN p ON p.o_custkey = b.o_custkey AND p.r = b.r + 1))"
    " SELECT o_custkey, CAST(bin AS BIGINT) AS bin, min(o_orderkey) AS first_page, max(o_orderkey) AS last_page, count(*) AS page_count, CAST(sum(p.entries) AS BIGINT) AS entries, CAST(sum(p.dialogue) AS BIGINT) AS dialogue, CAST(sum(p.markers) AS BIGINT) AS markers, CASE WHEN count(*) <= 5 THEN 'standard' ELSE 'low_density' END AS risk FROM b JOIN p USING (o_custkey, r) GROUP BY o_custkey, bin",
)
def o03(spark, d):
    """Lines are counted per page before they meet the pages."""
    counts = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("entries"), F.count_if(F.col("l_returnflag") == "N").alias("dialogue"), F.count_if(F.col("l_discount") > 0.05).alias("markers")
    )
    pages = table(spark, d, "orders").select("o_custkey", "o_orderkey").join(counts, "o_orderkey", "left").fillna(0, list(LIMITS))
    return batch_plan(pages, "o_custkey", "o_orderkey")


def with_timestamps(entries: DataFrame, stamps: DataFrame, order: str) -> DataFrame:
    """Dialogue entries with a matched label take the first stamp that names their id; ``mismatch`` marks those that hold another one.

    ``stamps`` has ``entry_ids``, the stamp's fields and ``subtitle_match_confidence``; a stamp that lacks a field names nobody.
    """
    fields = [*STAMP, "subtitle_match_confidence"]
    confidence = F.when(F.col("subtitle_match_confidence").isin("high", "low"), F.col("subtitle_match_confidence")).alias("subtitle_match_confidence")
    named = stamps.dropna(subset=list(STAMP)).select(F.explode("entry_ids").alias("id"), F.struct(order, *STAMP, confidence).alias("stamp"))
    first = named.groupBy("id").agg(F.min("stamp").alias("stamp"))
    rows = entries.join(first, "id", "left")
    takes = F.col("stamp").isNotNull() & (F.col("type") == "dialogue") & F.col("subtitle_label").isin(*MATCHED_LABELS)
    differs = F.lit(False)
    for c in STAMP:
        differs |= F.coalesce(F.col(c) != F.col("stamp")[c], F.lit(False))
    made = {c: F.when(takes, F.coalesce(F.col("stamp")[c], F.col(c))).otherwise(F.col(c)) for c in fields}
    return rows.withColumns({"mismatch": F.coalesce(takes & differs, F.lit(False)), **made}).drop("stamp")


@query(
    "O10_merged_timestamps",
    "WITH s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY event_id) AS r FROM (SELECT event_id, value, event_type, unnest(['c' || user_id || '-t0', 'c' || user_id || '-t' || (event_id % 3)]) AS id FROM events)) WHERE r = 1),"
    " e AS (SELECT conv_id, turn, 'c' || conv_id || '-t' || turn AS id, CASE WHEN turn = 0 AND conv_id % 5 = 0 THEN conv_id END AS own, role = 'user' AND turn % 4 <> 3 AS takes FROM conversations)"
    " SELECT conv_id, turn, CASE WHEN takes THEN coalesce(event_id, own) ELSE own END AS subtitle_event_index, CASE WHEN takes THEN value END AS subtitle_start, CASE WHEN takes THEN value + 1 END AS subtitle_end, CASE WHEN takes AND event_type = 'purchase' THEN 'high' WHEN takes AND event_type = 'view' THEN 'low' END AS subtitle_match_confidence, coalesce(takes AND own <> event_id, false) AS mismatch FROM e LEFT JOIN s USING (id)",
)
def o10(spark, d):
    turn = F.col("turn")
    entries = table(spark, d, "conversations").select(
        "conv_id", "turn", F.concat(F.lit("c"), "conv_id", F.lit("-t"), "turn").alias("id"), F.when(F.col("role") == "user", "dialogue").otherwise("action").alias("type"),
        F.when(turn % 4 != 3, F.when(turn % 4 == 0, MATCHED_LABELS[0]).otherwise(MATCHED_LABELS[1])).otherwise("other").alias("subtitle_label"),
        F.when((turn == 0) & (F.col("conv_id") % 5 == 0), F.col("conv_id")).alias("subtitle_event_index"),
        F.lit(None).cast("double").alias("subtitle_start"), F.lit(None).cast("double").alias("subtitle_end"), F.lit(None).cast("string").alias("subtitle_match_confidence"),
    )
    confidence = F.when(F.col("event_type") == "purchase", "high").when(F.col("event_type") == "view", "low").otherwise("none")
    ids = F.array(F.concat(F.lit("c"), "user_id", F.lit("-t0")), F.concat(F.lit("c"), "user_id", F.lit("-t"), F.col("event_id") % 3))
    stamps = table(spark, d, "events").select("event_id", ids.alias("entry_ids"), F.col("event_id").alias(STAMP[0]), F.col("value").alias(STAMP[1]), (F.col("value") + 1).alias(STAMP[2]), confidence.alias("subtitle_match_confidence"))
    return with_timestamps(entries, stamps, "event_id").select("conv_id", "turn", *STAMP, "subtitle_match_confidence", "mismatch")


def scalar_kind(c: Column) -> Column:
    """What a configuration value is: null, boolean, integer or text."""
    v = F.trim(c)
    null = v.isNull() | v.isin("", "null", "Null", "NULL", "~")
    return F.when(null, "null").when(v.isin("true", "True", "TRUE", "false", "False", "FALSE"), "boolean").when(v.rlike("^-?[0-9]+$"), "integer").otherwise("text")


def scalar_value(c: Column) -> Column:
    """The value as text, without the quotes that enclose it; null for null."""
    v, kind = F.trim(c), scalar_kind(c)
    bare = F.when(v.rlike("(?s)^(\".*\"|'.*')$"), F.substr(v, F.lit(2), F.length(v) - 2)).otherwise(v)
    return F.when(kind == "boolean", F.lower(v)).when(kind == "integer", v).when(kind == "text", bare)


_RAW = "CASE p_partkey % 6 WHEN 0 THEN ' ~ ' WHEN 1 THEN ' True' WHEN 2 THEN CAST(-p_size AS VARCHAR) || ' ' WHEN 3 THEN '\"' || p_name || '\"' WHEN 4 THEN '''' || p_type || '''' ELSE p_name END"


@query("F32_scalar", f"SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'null' WHEN 1 THEN 'boolean' WHEN 2 THEN 'integer' ELSE 'text' END AS kind, CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'true' ELSE trim({_RAW}, ' \"''') END AS value FROM part")
def f32(spark, d):
    raw = F.expr(_RAW.replace("AS VARCHAR", "AS STRING").replace("''''", "\"'\""))
    return table(spark, d, "part").select("p_partkey", scalar_kind(raw).alias("kind"), scalar_value(raw).alias("value"))


def resolved_path(parent: Column, value: Column, home: str) -> Column:
    """A configured path: absolute ones and those from home stand alone, others are below the project's folder; null for empty."""
    whole = F.when(value.startswith("~/"), F.concat(F.lit(home), F.substr(value, F.lit(2)))).otherwise(value)
    return F.when(value != "", F.when(whole.startswith("/"), whole).otherwise(F.concat_ws("/", parent, whole)))


@query("F40_resolved_path", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '/' || p_type WHEN 2 THEN '/home/a/' || p_type ELSE p_brand || '/' || p_type END AS path FROM part")
def f40(spark, d):
    kind = F.col("p_partkey") % 4
    value = F.when(kind == 0, "").when(kind == 1, F.concat(F.lit("/"), "p_type")).when(kind == 2, F.concat(F.lit("~/"), "p_type")).otherwise(F.col("p_type"))
    return table(spark, d, "part").select("p_partkey", resolved_path(F.col("p_brand"), value, "/home/a").alias("path"))


@query("O18_metadata", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN c_mktsegment ELSE '剧本学习版' END AS title, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN c_mktsegment ELSE '剧本学习版' END AS source_title, 'zh-CN' AS language FROM customer")
def o18(spark, d):
    """Title and language with fallbacks; blank counts as missing."""
    kind = F.col("c_custkey") % 3
    own = F.when(kind == 0, F.col("c_name")).when(kind == 1, F.lit(""))
    source = F.when(kind == 0, F.col("c_name")).when(kind == 1, F.col("c_mktsegment")).otherwise("")
    title = F.coalesce(F.nullif(own, F.lit("")), F.nullif(source, F.lit("")), F.lit(DEFAULT_TITLE))
    return table(spark, d, "customer").select("c_custkey", title.alias("title"), F.coalesce(F.nullif(source, F.lit("")), title).alias("source_title"), F.lit("zh-CN").alias("language"))
