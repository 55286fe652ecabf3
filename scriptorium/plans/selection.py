"""Selection, precedence, ordering, union and nested-value operators as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import fixed
from scriptorium.functions import script as s
from scriptorium.operators import runs
from scriptorium.sources.tables import LINES, lines, table

QUERIES, SQL = {}, {}
# The prefixes that mark a translation as not yet made.
PREFIX = {"system": "待译场景标题：", "user": "待译对白：", "assistant": "待译动作描写："}
KINDS = {"system": "scene_heading", "user": "dialogue", "assistant": "action"}
STOP_WORDS = fixed.STYLE_STOP_WORDS


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return register


def _cases(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


def _mapped(column: str, values: dict[str, str]):
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col(column)]


@query("P01_compact_record", """SELECT '{"o_orderkey":' || o_orderkey || ',"status":"' || o_orderstatus || '"' || CASE WHEN o_orderpriority = '1-URGENT' THEN ',"urgent":true' ELSE '' END || '}' AS record FROM orders""")
def p01(spark, d):
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", True).alias("urgent")
    return table(spark, d, "orders").select(F.to_json(F.struct("o_orderkey", F.col("o_orderstatus").alias("status"), urgent)).alias("record"))


@query("P14_kept_terms", f"SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[A-Z][A-Za-z''-]*')) AS word FROM documents) WHERE length(word) >= 3 AND lower(word) NOT IN {fixed.sql_list(STOP_WORDS)} GROUP BY word")
def p14(spark, d):
    words = table(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Z][A-Za-z'-]*"), F.lit(0))).alias("word"))
    return words.filter((F.length("word") >= 3) & ~F.lower("word").isin(*STOP_WORDS)).groupBy("word").agg(F.count("*").alias("n"))


@query("P18_divergent", "SELECT doc_id FROM (SELECT doc_id, CASE WHEN toxic = 1 THEN 'unseen' WHEN quality = 0 THEN 'diff' ELSE 'match' END AS label FROM labels) WHERE label IN ('diff', 'unseen')")
def p18(spark, d):
    label = F.when(F.col("toxic") == 1, "unseen").when(F.col("quality") == 0, "diff").otherwise("match")
    return table(spark, d, "labels").filter(label.isin("diff", "unseen")).select("doc_id")


@query("P20_revised_context", "SELECT doc_id FROM documents WHERE regexp_matches(text || CASE doc_id % 9 WHEN 0 THEN ' Rev. 2' WHEN 1 THEN ' revised' ELSE ' prevision' END, '(?i)\\b(rev\\.?|revised|revision)\\b')")
def p20(spark, d):
    noted = F.concat("text", F.when(F.col("doc_id") % 9 == 0, " Rev. 2").when(F.col("doc_id") % 9 == 1, " revised").otherwise(" prevision"))
    return table(spark, d, "documents").filter(noted.rlike("(?i)\\b(rev\\.?|revised|revision)\\b")).select("doc_id")


@query("P21_safe_limits", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 110 OR count(*) FILTER (event_type = 'view') > 65 OR count(*) FILTER (event_type = 'error') > 18")
def p21(spark, d):
    stats = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "view").alias("views"), F.count_if(F.col("event_type") == "error").alias("errors"))
    return stats.filter("n > 110 or views > 65 or errors > 18").select("user_id", "n")


@query("P23_type_map", f"SELECT conv_id, turn, {_cases('role', KINDS)} AS kind FROM conversations")
def p23(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", _mapped("role", KINDS).alias("kind"))


@query("P24_placeholder", f"SELECT conv_id, turn, {_cases('role', PREFIX)} || text AS translation FROM conversations")
def p24(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", F.concat(_mapped("role", PREFIX), "text").alias("translation"))


@query("P30_has_captions", "SELECT conv_id, bool_or(role = 'system') AS has_captions FROM conversations GROUP BY conv_id")
def p30(spark, d):
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.bool_or(F.col("role") == "system").alias("has_captions"))


@query("P31_precedence", "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment WHEN c_nationkey % 2 = 0 THEN n_name ELSE 'default' END AS value, CASE WHEN c_acctbal >= 0 THEN 'option' WHEN c_nationkey % 2 = 0 THEN 'config' ELSE 'default' END AS origin FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey")
def p31(spark, d):
    """The first value that is present, with the name of its origin."""
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = table(spark, d, "customer").join(nation, "c_nationkey", "left")
    chain = [("option", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))), ("config", F.when(F.col("c_nationkey") % 2 == 0, F.col("n_name"))), ("default", F.lit("default"))]
    first = F.coalesce(*[F.when(value.isNotNull(), F.struct(value.alias("value"), F.lit(origin).alias("origin"))) for origin, value in chain])
    return rows.select("c_custkey", first.alias("first")).select("c_custkey", "first.*")


@query("P34_progress_key", "SELECT doc_id, coalesce(nullif(trim(split_part(text, chr(10), 1)), ''), 'untitled') AS title, concat_ws(':', source, lang, doc_id) AS progress_key FROM documents")
def p34(spark, d):
    title = F.coalesce(F.nullif(F.trim(F.split_part("text", F.lit("\n"), F.lit(1))), F.lit("")), F.lit("untitled"))
    return table(spark, d, "documents").select("doc_id", title.alias("title"), F.concat_ws(":", "source", "lang", F.col("doc_id").cast("string")).alias("progress_key"))


@query("T03_text_order", "SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY 'e' || turn) AS INTEGER) AS place FROM conversations")
def t03(spark, d):
    key = F.concat(F.lit("e"), F.col("turn").cast("string"))
    return table(spark, d, "conversations").select("conv_id", "turn", F.row_number().over(runs.ordered(["conv_id"], [key])).alias("place"))


@query("T05_nulls_last", "SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY nullif(p_size % 5, 0) NULLS LAST, p_partkey) AS INTEGER) AS place FROM part")
def t05(spark, d):
    key = F.nullif(F.col("p_size") % 5, F.lit(0)).asc_nulls_last()
    return table(spark, d, "part").select("p_partkey", F.row_number().over(runs.ordered(["p_brand"], [key, "p_partkey"])).alias("place"))


@query("T07_argmax", "SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber DESC) AS k FROM lineitem) WHERE k = 1")
def t07(spark, d):
    """Argmax as an aggregate: combined before the shuffle, without a sort."""
    best = F.max(F.struct("l_quantity", "l_linenumber"))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(best["l_linenumber"].alias("l_linenumber"))


@query("T09_head_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 160")
def t09(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(160)


@query("T10_groups_by_first", "SELECT user_id, min(epoch_us(ts)) AS first_us, count(*) AS n FROM events GROUP BY user_id ORDER BY first_us, user_id")
def t10(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("first_us"), F.count("*").alias("n")).orderBy("first_us", "user_id")


@query("T11_anchor_order", """SELECT page_id, CAST(unnest(range(len(x))) AS INTEGER) AS place, unnest(x) AS href FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS x FROM pages) ORDER BY 1, 2""")
def t11(spark, d):
    return table(spark, d, "pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("place", "href")).orderBy("page_id", "place")


@query("T12_sorted_counts", "SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL ORDER BY 1, 2")
def t12(spark, d):
    return table(spark, d, "documents").groupBy("source", "lang").agg(F.count("*").alias("n")).orderBy("source", "lang")


@query("U01_union_duplicates", "SELECT doc_id, count(*) AS n FROM (SELECT doc_id FROM documents UNION ALL SELECT doc_id FROM labels) GROUP BY doc_id HAVING count(*) > 1")
def u01(spark, d):
    both = table(spark, d, "documents").select("doc_id").unionByName(table(spark, d, "labels").select("doc_id"))
    return both.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")


@query("U03_synthetic_rows", "SELECT conv_id, turn, text FROM conversations UNION ALL SELECT DISTINCT conv_id, -1, NULL FROM conversations")
def u03(spark, d):
    own = table(spark, d, "conversations").select("conv_id", "turn", "text")
    made = own.select("conv_id").distinct().withColumn("turn", F.lit(-1).cast("long"))
    return own.unionByName(made, allowMissingColumns=True)


@query("U04_unlike_schemas", "SELECT event_id, value, NULL AS props FROM events WHERE event_type = 'click' UNION ALL SELECT event_id, NULL, props FROM events WHERE event_type = 'error'")
def u04(spark, d):
    e = table(spark, d, "events")
    return e.filter("event_type = 'click'").select("event_id", "value").unionByName(e.filter("event_type = 'error'").select("event_id", "props"), allowMissingColumns=True)


@query("U06_candidates_minus_kept", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT max(doc_id) FROM documents GROUP BY source)")
def u06(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id").join(docs.groupBy("source").agg(F.max("doc_id").alias("doc_id")).select("doc_id"), "doc_id", "left_anti")


@query("U09_front_and_body", f"SELECT part, count(*) AS n FROM (SELECT 'front' AS part FROM {LINES} WHERE line_no = 0 UNION ALL SELECT 'body' FROM {LINES} WHERE line_no > 0) GROUP BY part")
def u09(spark, d):
    rows = lines(spark, d).select("line_no")
    parts = rows.filter("line_no = 0").select(F.lit("front").alias("part")).unionByName(rows.filter("line_no > 0").select(F.lit("body").alias("part")))
    return parts.groupBy("part").agg(F.count("*").alias("n"))


@query("F03_repair_glyphs", "SELECT item_id, translate(replace(translate(text, 'abcde', 'ÕÒÓÑÉ'), 'É', '...'), 'ÕÒÓÑ', '’\"\"-') AS value FROM benchmark")
def f03(spark, d):
    return table(spark, d, "benchmark").select("item_id", s.repair_glyphs(F.translate("text", "abcde", "ÕÒÓÑÉ")).alias("value"))


@query("F16_rounding", "SELECT event_id, round_even(value * 8, 0) / 8 AS value FROM events")
def f16(spark, d):
    return table(spark, d, "events").select("event_id", (F.bround(F.col("value") * 8, 0) / 8).alias("value"))


@query("F28_first_marker", f"SELECT doc_id, line_no, coalesce(list_filter(string_split(line, ' '), lambda w: regexp_matches(w, '[0-9]'))[1], '') AS marker FROM {LINES}")
def f28(spark, d):
    found = F.get(F.filter(F.split("line", " "), lambda w: w.rlike("[0-9]")), 0)
    return lines(spark, d).select("doc_id", "line_no", F.coalesce(found, F.lit("")).alias("marker"))


@query("F31_number_in_url", "SELECT page_id, TRY_CAST(regexp_extract(url, '([0-9]+)[^0-9]*$', 1) AS BIGINT) AS number FROM pages")
def f31(spark, d):
    return table(spark, d, "pages").select("page_id", F.regexp_extract("url", "([0-9]+)[^0-9]*$", 1).try_cast("long").alias("number"))


@query("F33_checked_number", "SELECT c_custkey, TRY_CAST(right(c_name, 4) AS DOUBLE) AS value, coalesce(TRY_CAST(substr(c_name, c_custkey % 12 + 1, 20) AS DOUBLE) > 0, false) AS valid FROM customer")
def f33(spark, d):
    part = F.expr("substr(c_name, cast(c_custkey % 12 + 1 as int), 20)")
    return table(spark, d, "customer").select("c_custkey", F.right("c_name", F.lit(4)).try_cast("double").alias("value"), F.coalesce(part.try_cast("double") > 0, F.lit(False)).alias("valid"))


@query("F34_arrays", "SELECT conv_id, len(list(DISTINCT role)) AS n_roles, array_to_string(list_slice(list_sort(list(DISTINCT role)), 1, 2), ',') AS first_roles, list_contains(list(role), 'system') AS has_system FROM conversations GROUP BY conv_id")
def f34(spark, d):
    roles = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_set("role")).alias("r"))
    return roles.select("conv_id", F.size("r").cast("long").alias("n_roles"), F.array_join(F.slice("r", 1, 2), ",").alias("first_roles"), F.array_contains("r", "system").alias("has_system"))


@query("F35_map_counts", "SELECT user_id, count(*) FILTER (event_type = 'view') + count(*) FILTER (event_type = 'signup') AS n FROM events GROUP BY user_id")
def f35(spark, d):
    n = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    counts = n.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    got = [F.coalesce(F.try_element_at("m", F.lit(k)), F.lit(0)) for k in ("view", "signup")]
    return counts.select("user_id", (got[0] + got[1]).alias("n"))


@query("F36_json_keys", "SELECT event_id, array_to_string(list_sort(json_keys(props)), ',') AS keys FROM events")
def f36(spark, d):
    return table(spark, d, "events").select("event_id", F.array_join(F.array_sort(F.json_object_keys("props")), ",").alias("keys"))


@query("F42_nested_markers", f"SELECT doc_id, line_no, unnest(regexp_extract_all(line, '[0-9]+')) AS marker FROM {LINES}")
def f42(spark, d):
    """Markers nested in the entries of a document, one row each."""
    entries = table(spark, d, "documents").select("doc_id", F.posexplode(F.transform(F.split("text", "\n"), lambda x: F.regexp_extract_all(x, F.lit("[0-9]+"), F.lit(0)))).alias("line_no", "markers"))
    return entries.select("doc_id", "line_no", F.explode("markers").alias("marker"))
