"""Joins, aggregations, ordered operators, sorts and set operations as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import text as t
from scriptorium.operators import intervals, runs, scans
from scriptorium.sources.tables import LINES, lines, table

QUERIES, SQL = {}, {}


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return register


@query("J01_anti_keys", "SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag = 'R')")
def j01(spark, d):
    back = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").select("o_orderkey").join(back, "o_orderkey", "left_anti")


@query("J02_left_dimension", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def j02(spark, d):
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, d, "customer").join(nation, "c_nationkey", "left").select("c_custkey", "n_name")


@query("J03_band", "SELECT a.event_id AS view_id, b.event_id AS click_id FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'view' AND b.event_type = 'click' AND abs(epoch(a.ts) - epoch(b.ts)) <= 3600")
def j03(spark, d):
    # Equal keys and time cells: each view meets its own and the two neighbouring cells only, however long the span.
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", t.seconds(F.col("ts")).alias("at")).withColumn("cell", F.floor(F.col("at") / 3600))
    a = e.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("at").alias("a"), F.explode(F.array(F.col("cell") - 1, "cell", F.col("cell") + 1)).alias("cell"))
    b = e.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), F.col("at").alias("b"), "cell")
    return a.join(b, ["user_id", "cell"]).filter(F.abs(F.col("a") - F.col("b")) <= 3600).select("view_id", "click_id")


@query("J05_paired_groups", "SELECT user_id FROM events GROUP BY user_id HAVING count(*) FILTER (event_type = 'click') > 0 AND count(*) FILTER (event_type = 'purchase') > 0")
def j05(spark, d):
    kinds = F.array_sort(F.collect_set("event_type"))
    return table(spark, d, "events").filter(F.col("event_type").isin("click", "purchase")).groupBy("user_id").agg(kinds.alias("kinds")).filter(F.col("kinds") == F.array(F.lit("click"), F.lit("purchase"))).select("user_id")


@query("J12_as_of", "SELECT p.event_id, (SELECT max(v.ts) FROM events v WHERE v.user_id = p.user_id AND v.event_type = 'view' AND v.ts < p.ts) AS viewed FROM events p WHERE p.event_type = 'purchase'")
def j12(spark, d):
    e = table(spark, d, "events")
    bought = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    seen = e.filter("event_type = 'view'").select("user_id", F.col("ts").alias("seen_ts"))
    return scans.as_of(bought, seen, ["user_id"], "ts", "seen_ts", "seen_ts", "viewed").select("event_id", "viewed")


@query("J15_broken_links", "SELECT page_id, target FROM (SELECT DISTINCT page_id, html, unnest(regexp_extract_all(html, '\\bhref=\"#([^\"]*)\"', 1)) AS target FROM (SELECT page_id, html || '<a href=\"#s' || (page_id % 5) || '\"></a><h2 id=\"s' || (page_id % 3) || '\"></h2>' AS html FROM pages)) WHERE NOT list_contains(regexp_extract_all(html, '\\bid=\"([^\"]*)\"', 1), target)")
def j15(spark, d):
    anchors = F.format_string('<a href="#s%d"></a><h2 id="s%d"></h2>', F.col("page_id") % 5, F.col("page_id") % 3)
    pages = table(spark, d, "pages").select("page_id", F.concat("html", anchors).alias("html"))
    targets = F.array_distinct(F.regexp_extract_all("html", F.lit('\\bhref="#([^"]*)"'), F.lit(1)))
    return pages.select("page_id", F.explode(F.array_except(targets, t.attributes(F.col("html"), "id"))).alias("target"))


@query("J19_missing_in_range", "SELECT x AS doc_id FROM (SELECT unnest(range(min(doc_id), max(doc_id) + 1)) AS x FROM labels) WHERE x NOT IN (SELECT doc_id FROM labels)")
def j19(spark, d):
    # From each id to the next: gaps come out without a series over the whole range in one row.
    have = table(spark, d, "labels").select("doc_id").distinct()
    cell = have.withColumn("cell", F.floor(F.col("doc_id") / 4096))
    ends = have.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    wanted = ends.select(F.explode(F.sequence(F.floor(F.col("lo") / 4096), F.floor(F.col("hi") / 4096))).alias("cell"), "lo", "hi")
    series = wanted.select("cell", F.explode(F.sequence(F.greatest("lo", F.col("cell") * 4096), F.least("hi", F.col("cell") * 4096 + 4095))).alias("doc_id"))
    return series.join(cell, ["cell", "doc_id"], "left_anti").select("doc_id")


@query("J22_left_counts", "SELECT o_orderkey, count(l_orderkey) AS n_lines FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey")
def j22(spark, d):
    n = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_lines"))
    return table(spark, d, "orders").select("o_orderkey").join(n, "o_orderkey", "left").fillna(0, ["n_lines"])


@query("G03_count_by_key", "SELECT source, lang, count(*) AS n FROM documents GROUP BY source, lang")
def g03(spark, d):
    return table(spark, d, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))


@query("G04_mode", "SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, min(event_id)) AS r FROM events GROUP BY user_id, event_type) WHERE r = 1")
def g04(spark, d):
    n = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first"))
    return n.groupBy("user_id").agg(F.max_by("event_type", F.struct("n", -F.col("first"))).alias("event_type"))


@query("G05_ordered_list", "SELECT conv_id, string_agg(role, '>' ORDER BY turn) AS roles FROM conversations GROUP BY conv_id")
def g05(spark, d):
    inorder = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(inorder, lambda x: x["role"]), ">").alias("roles"))


@query("G07_ranges", "SELECT source, min(doc_id) AS first_doc, max(doc_id) AS last_doc FROM documents GROUP BY source")
def g07(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))


@query("G08_any", "SELECT conv_id, bool_or(role = 'system') AS has_system FROM conversations GROUP BY conv_id")
def g08(spark, d):
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.bool_or(F.col("role") == "system").alias("has_system"))


@query(
    "G09_candidate_terms",
    "SELECT term, n FROM (SELECT term, count(*) AS n, min(CAST(doc_id AS HUGEINT) * 2147483648 + pos) AS first FROM (SELECT doc_id, unnest(range(len(w))) AS pos, unnest(w) AS term FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z][a-z''-]*') AS w FROM documents)) WHERE length(term) >= 3 GROUP BY term) ORDER BY n DESC, first LIMIT 50",
)
def g09(spark, d):
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z][a-z'-]*"), F.lit(0))
    tokens = table(spark, d, "documents").select("doc_id", F.posexplode(words).alias("pos", "term")).filter(F.length("term") >= 3)
    # Id and place as one decimal, exact for any id and length: the least of a struct would need a sort for each aggregate.
    place = F.col("doc_id").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col("pos")
    n = tokens.groupBy("term").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    return n.orderBy(F.desc("n"), "first").limit(50).select("term", "n")


@query("G10_terms_by_name", "SELECT term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z][a-z''-]*')) AS term FROM conversations) GROUP BY term ORDER BY n DESC, term LIMIT 10")
def g10(spark, d):
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z][a-z'-]*"), F.lit(0))
    return table(spark, d, "conversations").select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(10)


@query("G14_style_notes", "SELECT role, count(*) FILTER (contains(text, '?')) AS n_questions, count(*) FILTER (contains(text, '!')) AS n_exclaimed, sum(length(text)) AS n_chars, count(*) AS n FROM conversations GROUP BY role")
def g14(spark, d):
    c = F.col("text")
    return table(spark, d, "conversations").groupBy("role").agg(F.count_if(c.contains("?")).alias("n_questions"), F.count_if(c.contains("!")).alias("n_exclaimed"), F.sum(F.length(c)).alias("n_chars"), F.count("*").alias("n"))


@query("G15_rollup", "SELECT coalesce(source, 'total') AS grp, count(*) AS n, sum(strlen(text)) AS n_bytes FROM documents GROUP BY ROLLUP (source)")
def g15(spark, d):
    rows = table(spark, d, "documents").select("source", F.octet_length("text").alias("b")).rollup("source").agg(F.count("*").alias("n"), F.sum("b").alias("n_bytes"))
    return rows.select(F.coalesce("source", F.lit("total")).alias("grp"), "n", "n_bytes")


@query("G20_pattern_hits", "SELECT page_id, CAST(len(regexp_extract_all(html, '<a ')) AS INTEGER) AS n_links, CAST(len(regexp_extract_all(html, '<p')) AS INTEGER) AS n_paragraphs FROM pages")
def g20(spark, d):
    return table(spark, d, "pages").select("page_id", F.regexp_count("html", F.lit("<a ")).alias("n_links"), F.regexp_count("html", F.lit("<p")).alias("n_paragraphs"))


@query("G22_severity", "SELECT user_id, CASE max(CASE event_type WHEN 'error' THEN 3 WHEN 'signup' THEN 2 WHEN 'click' THEN 1 ELSE 0 END) WHEN 3 THEN 'FAIL' WHEN 2 THEN 'UNCERTAIN' WHEN 1 THEN 'WARN' ELSE 'ok' END AS state FROM events GROUP BY user_id")
def g22(spark, d):
    rank = F.when(F.col("event_type") == "error", 3).when(F.col("event_type") == "signup", 2).when(F.col("event_type") == "click", 1).otherwise(0)
    worst = table(spark, d, "events").groupBy("user_id").agg(F.max(rank).alias("r"))
    return worst.select("user_id", F.element_at(F.array(*map(F.lit, ("ok", "WARN", "UNCERTAIN", "FAIL"))), F.col("r") + 1).alias("state"))


@query("G27_run_concat", "SELECT conv_id, role, string_agg(text, ' ' ORDER BY turn) AS text FROM (SELECT *, turn - row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS run FROM conversations) GROUP BY conv_id, role, run")
def g27(spark, d):
    c = table(spark, d, "conversations")
    w = runs.ordered(["conv_id"], ["turn"])
    numbered = runs.islands(c, ["conv_id"], ["turn"], (F.lag("role").over(w) != F.col("role")) | (F.col("turn") - F.lag("turn").over(w) != 1))
    parts = F.array_sort(F.collect_list(F.struct("turn", "text")))
    return numbered.groupBy("conv_id", "role", "island").agg(F.array_join(F.transform(parts, lambda x: x["text"]), " ").alias("text")).select("conv_id", "role", "text")


@query("W03_entry_ids", "SELECT conv_id, turn, printf('p%03d-e%03d', conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn)) AS id FROM conversations")
def w03(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", F.format_string("p%03d-e%03d", "conv_id", F.row_number().over(runs.ordered(["conv_id"], ["turn"]))).alias("id"))


@query("W04_carry_forward", "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS purchase_id FROM events")
def w04(spark, d):
    bought = F.when(F.col("event_type") == "purchase", F.col("event_id"))
    return scans.carried(table(spark, d, "events").select("event_id", "event_type", "user_id", "ts"), ["user_id"], ["ts", "event_id"], bought, "purchase_id").select("event_id", "purchase_id")


@query(
    "W05_sessions",
    "SELECT user_id, min(event_id) AS first_event, count(*) AS n, max(ts) AS until FROM (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 7200 THEN 1 ELSE 0 END AS b FROM events)) GROUP BY user_id, s",
)
def w05(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "ts")
    numbered = scans.islands(e, ["user_id"], ["ts", "event_id"], t.seconds(F.col("ts")), lambda now, then: now - then > 7200, "session")
    return numbered.groupBy("user_id", "session").agg(F.min("event_id").alias("first_event"), F.count("*").alias("n"), F.max("ts").alias("until")).drop("session")


@query("W11_adjacent_repeats", f"SELECT doc_id, line_no FROM (SELECT doc_id, line_no, line, lag(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS before FROM {LINES}) WHERE line = before AND length(line) >= 6")
def w11(spark, d):
    before = F.lag("line").over(runs.ordered(["doc_id"], ["line_no"]))
    return lines(spark, d).withColumn("before", before).filter("line = before and length(line) >= 6").select("doc_id", "line_no")


@query(
    "W14_compact_ranges",
    "SELECT source, string_agg(CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE lo || '-' || hi END, ',' ORDER BY lo) AS ranges FROM (SELECT source, min(doc_id) AS lo, max(doc_id) AS hi FROM (SELECT source, doc_id, doc_id - row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) GROUP BY source, r) GROUP BY source",
)
def w14(spark, d):
    ranges = intervals.of_values(table(spark, d, "documents"), ["source"], "doc_id")
    return intervals.compact(ranges, ["source"], "ranges").drop("n_ranges")


@query("W15_first_occurrence", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
def w15(spark, d):
    return table(spark, d, "documents").groupBy(F.sha2("text", 256)).agg(F.min("doc_id").alias("doc_id")).select("doc_id")


@query(
    "W16_greedy_bins",
    "WITH RECURSIVE o AS (SELECT conv_id, turn, length(text) AS size, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations), b AS (SELECT conv_id, turn, r, size AS used, 0 AS bin FROM o WHERE r = 1 UNION ALL SELECT o.conv_id, o.turn, o.r, CASE WHEN b.used > 0 AND b.used + o.size > 200 THEN o.size ELSE b.used + o.size END, b.bin + CASE WHEN b.used > 0 AND b.used + o.size > 200 THEN 1 ELSE 0 END FROM b JOIN o ON o.conv_id = b.conv_id AND o.r = b.r + 1) SELECT conv_id, turn, CAST(bin AS BIGINT) AS bin FROM b",
)
def w16(spark, d):
    sized = table(spark, d, "conversations").select("conv_id", "turn", F.length("text").alias("size"))
    return runs.greedy_bins(sized, ["conv_id"], "turn", "size", 200)


@query("W18_group_caps", "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS r FROM documents) WHERE r <= 12")
def w18(spark, d):
    return runs.first_rows(table(spark, d, "documents").select("source", "doc_id", "n_chars"), ["source"], [F.desc("n_chars"), "doc_id"], 12).select("source", "doc_id")


@query("W19_later_repeats", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r > 1")
def w19(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    first = docs.groupBy("digest").agg(F.min("doc_id").alias("first"))
    return docs.join(first, "digest").filter("doc_id <> first").select("doc_id")


@query("T06_widest_range", "SELECT source, max(doc_id) - min(doc_id) AS span FROM documents GROUP BY source ORDER BY span DESC, source DESC LIMIT 1")
def t06(spark, d):
    spans = table(spark, d, "documents").groupBy("source").agg((F.max("doc_id") - F.min("doc_id")).alias("span"))
    return spans.agg(F.max(F.struct("span", "source")).alias("m")).select("m.source", "m.span")


@query("T08_tail", "SELECT conv_id, turn FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations) WHERE r <= 2")
def t08(spark, d):
    return runs.first_rows(table(spark, d, "conversations").select("conv_id", "turn"), ["conv_id"], [F.desc("turn")], 2).select("conv_id", "turn")


@query("U02_union_findings", "SELECT 'FAIL' AS level, 'empty' AS code, count(*) AS n FROM documents WHERE length(text) < 60 UNION ALL SELECT 'WARN', 'toxic', count(*) FROM labels WHERE toxic = 1")
def u02(spark, d):
    short = table(spark, d, "documents").filter(F.length("text") < 60).agg(F.count("*").alias("n")).select(F.lit("FAIL").alias("level"), F.lit("empty").alias("code"), "n")
    toxic = table(spark, d, "labels").filter("toxic = 1").agg(F.count("*").alias("n")).select(F.lit("WARN").alias("level"), F.lit("toxic").alias("code"), "n")
    return short.unionByName(toxic)


@query("U05_except", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def u05(spark, d):
    return table(spark, d, "documents").select("doc_id").subtract(table(spark, d, "labels").select("doc_id"))


@query("U08_distinct_links", "SELECT DISTINCT href FROM (SELECT unnest(regexp_extract_all(html, '\\bhref=\"([^\"]*)\"', 1)) AS href FROM pages)")
def u08(spark, d):
    return table(spark, d, "pages").select(F.explode(t.attributes(F.col("html"), "href")).alias("href")).distinct()


