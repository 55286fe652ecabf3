"""Scoring, coverage and lookup joins, report aggregates and text-block operators as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions import text as t
from scriptorium.operators import runs
from scriptorium.sources.tables import LINES, lines, table

QUERIES, SQL = {}, {}


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return register


_TERMS = "list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z][a-z''-]*'), lambda w: length(w) >= 6))"


@query("J11_first_timestamp", "SELECT p.event_id, CASE WHEN p.value > 100 THEN f.event_id END AS first_view FROM events p LEFT JOIN (SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events WHERE event_type = 'view') WHERE k = 1) f ON f.user_id = p.user_id WHERE p.event_type = 'purchase'")
def j11(spark, d):
    """The first of several values for a key wins; only rows that meet the condition take it."""
    e = table(spark, d, "events")
    first = e.filter("event_type = 'view'").groupBy("user_id").agg(F.min(F.struct("ts", "event_id"))["event_id"].alias("view_id"))
    return e.filter("event_type = 'purchase'").select("event_id", "user_id", "value").join(first, "user_id", "left").select("event_id", F.when(F.col("value") > 100, F.col("view_id")).alias("first_view"))


@query("J20_style_lookup", "SELECT p_partkey, alignment FROM part LEFT JOIN (VALUES ('ECONOMY', 2), ('PROMO', 8), ('STANDARD', 5)) s(p_type, alignment) USING (p_type)")
def j20(spark, d):
    styles = spark.createDataFrame([("ECONOMY", 2), ("PROMO", 8), ("STANDARD", 5)], "p_type string, alignment int")
    return table(spark, d, "part").join(F.broadcast(styles), "p_type", "left").select("p_partkey", "alignment")  # three rows, fixed


@query("J21_price_lookup", "SELECT o_orderkey, o_totalprice * price / 1000000 AS cost FROM orders LEFT JOIN (VALUES ('1-URGENT', 15e0), ('2-HIGH', 3e0)) s(o_orderpriority, price) USING (o_orderpriority)")
def j21(spark, d):
    prices = spark.createDataFrame([("1-URGENT", 15.0), ("2-HIGH", 3.0)], "o_orderpriority string, price double")
    return table(spark, d, "orders").join(F.broadcast(prices), "o_orderpriority", "left").select("o_orderkey", (F.col("o_totalprice") * F.col("price") / 1000000).alias("cost"))  # two rows, fixed


@query("J24_stale_record", "SELECT source, coalesce(a.n, 0) AS confirmed, coalesce(b.n, 0) AS current, coalesce(a.n, 0) <> coalesce(b.n, 0) AS stale FROM (SELECT source, count(*) AS n FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY source) a FULL JOIN (SELECT source, count(*) AS n FROM documents GROUP BY source) b USING (source)")
def j24(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    a = docs.join(table(spark, d, "labels").select("doc_id").distinct(), "doc_id", "left_semi").groupBy("source").agg(F.count("*").alias("a"))
    b = docs.groupBy("source").agg(F.count("*").alias("b"))
    confirmed, current = F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))
    return a.join(b, "source", "full").select("source", confirmed.alias("confirmed"), current.alias("current"), (confirmed != current).alias("stale"))


@query("J25_known_ids", "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) AND trim(text) <> ''")
def j25(spark, d):
    return table(spark, d, "documents").filter(F.trim("text") != "").select("doc_id").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi")


@query("J26_expected_counts", "SELECT n_name, n_nationkey * 3 AS expected, coalesce(n, 0) AS actual FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) ON c_nationkey = n_nationkey WHERE coalesce(n, 0) <> n_nationkey * 3")
def j26(spark, d):
    n = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    rows = table(spark, d, "nation").join(n, "n_nationkey", "left").select("n_name", (F.col("n_nationkey") * 3).alias("expected"), F.coalesce("n", F.lit(0)).alias("actual"))
    return rows.filter("actual <> expected")


@query("G02_joined_spans", "SELECT l_orderkey, min(l_linenumber) AS start, max(l_linenumber) + 1 AS stop, l_returnflag AS style FROM (SELECT *, l_linenumber - row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber) AS run FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem)) GROUP BY l_orderkey, run, l_returnflag")
def g02(spark, d):
    """Touching spans of one style become one."""
    spans = table(spark, d, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("style"), F.col("l_linenumber").alias("start"), (F.col("l_linenumber") + 1).alias("stop"))
    return runs.touching(spans, ["l_orderkey", "style"], "start", "stop").select("l_orderkey", "start", "stop", "style")


@query("G19_missing_labels", "SELECT source, string_agg(doc_id, ',' ORDER BY doc_id) FILTER (k <= 12) AS preview, count(*) AS total FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) GROUP BY source")
def g19(spark, d):
    """The first 12 ids and the count: the list is cut per task before the shuffle, the count is summed."""
    missing = table(spark, d, "documents").select("source", "doc_id").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")
    preview = runs.first_rows(missing, ["source"], ["doc_id"], 12).groupBy("source").agg(F.array_join(F.array_sort(F.collect_list("doc_id")).cast("array<string>"), ",").alias("preview"))
    return preview.join(missing.groupBy("source").agg(F.count("*").alias("total")), "source")


@query("G23_signal_names", "SELECT CASE event_type WHEN 'error' THEN 0 ELSE 1 END AS rank, event_type AS name, count(*) AS n FROM events GROUP BY event_type ORDER BY rank, n DESC, name")
def g23(spark, d):
    rank = F.when(F.col("event_type") == "error", 0).otherwise(1)
    return table(spark, d, "events").groupBy(F.col("event_type").alias("name"), rank.alias("rank")).agg(F.count("*").alias("n")).select("rank", "name", "n").orderBy("rank", F.desc("n"), "name")


@query("G25_record_digest", "SELECT conv_id, sha256(string_agg(turn || ':' || role || ':' || text, chr(10) ORDER BY turn)) AS digest FROM conversations GROUP BY conv_id")
def g25(spark, d):
    record = F.concat_ws(":", F.col("turn").cast("string"), "role", "text")
    rows = F.transform(F.array_sort(F.collect_list(F.struct("turn", record.alias("r")))), lambda x: x["r"])
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.sha2(F.array_join(rows, "\n"), 256).alias("digest"))


@query("G28_entry_counts", "SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) AS n FROM documents")
def g28(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")).cast("long").alias("n"))


_BLOCK = "CASE WHEN regexp_matches(line, '^\\s*$') THEN 'blank' WHEN regexp_matches(line, '^\\s*([-*]|[0-9]+[.)])\\s') THEN 'list' WHEN regexp_matches(line, '^#+\\s') THEN 'heading' WHEN regexp_matches(line, '^\\|.*\\|$') THEN 'table' ELSE 'paragraph' END"


@query("W21_markdown_blocks", f"WITH k AS (SELECT doc_id, line_no, {_BLOCK} AS kind FROM {LINES}), b AS (SELECT *, sum(CASE WHEN coalesce(kind <> before, true) OR kind = 'heading' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS block FROM (SELECT *, lag(kind) OVER (PARTITION BY doc_id ORDER BY line_no) AS before FROM k)) SELECT doc_id, kind, min(line_no) AS first_line, count(*) AS n FROM b WHERE kind <> 'blank' GROUP BY doc_id, block, kind")
def w21(spark, d):
    line = F.col("line")
    kind = F.when(line.rlike("^\\s*$"), "blank").when(line.rlike("^\\s*([-*]|[0-9]+[.)])\\s"), "list").when(line.rlike("^#+\\s"), "heading").when(line.rlike("^\\|.*\\|$"), "table").otherwise("paragraph")
    rows = lines(spark, d).select("doc_id", "line_no", kind.alias("kind"))
    before = F.lag("kind").over(runs.ordered(["doc_id"], ["line_no"]))
    rows = rows.withColumn("breaks", (F.col("kind") != before) | (F.col("kind") == "heading"))
    blocks = runs.islands(rows, ["doc_id"], ["line_no"], F.col("breaks"))
    return blocks.filter("kind <> 'blank'").groupBy("doc_id", "island", "kind").agg(F.min("line_no").alias("first_line"), F.count("*").alias("n")).drop("island")


def parenthesis_groups(df: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
    """Groups rows from an opening line until the balance since then is 0 or less: ``keys, first, n``.

    The balance starts anew after each group and is never below 0.  Such a sum that is cut off at 0 is the plain running
    sum less its lowest value so far, so two windows over one sort give it; a row belongs to the row before where that left some open.
    """
    w = runs.ordered(keys, [order])
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    balance = F.coalesce(t.parenthesis_balance(F.col(text)), F.lit(0)).cast("long")
    rows = df.select(*keys, order, balance.alias("__b")).withColumn("__sum", F.sum("__b").over(running))
    rows = rows.withColumn("__open", F.col("__sum") - F.least(F.lit(0), F.min("__sum").over(running)))
    groups = runs.islands(rows, keys, [order], F.lag("__open").over(w) <= 0)
    return groups.groupBy(*keys, "island").agg(F.min(order).cast("long").alias("first"), F.count("*").alias("n")).drop("island")


_BALANCE = "length(line) - length(replace(replace(line, '(', ''), '（', '')) - length(line) + length(replace(replace(line, ')', ''), '）', ''))"


@query(
    "W08_parenthesis_groups",
    f"WITH RECURSIVE l AS (SELECT doc_id, line_no, {_BALANCE} AS b FROM {LINES}), g AS (SELECT doc_id, line_no, line_no AS first, greatest(b, 0) AS open FROM l WHERE line_no = 0 UNION ALL SELECT l.doc_id, l.line_no, CASE WHEN g.open > 0 THEN g.first ELSE l.line_no END, greatest(g.open + l.b, 0) FROM g JOIN l ON l.doc_id = g.doc_id AND l.line_no = g.line_no + 1) SELECT doc_id, CAST(first AS BIGINT) AS first, count(*) AS n FROM g GROUP BY doc_id, first",
)
def w08(spark, d):
    return parenthesis_groups(lines(spark, d), ["doc_id"], "line_no", "line")


@query("O08_detail_lines", "SELECT conv_id, turn, 'role=' || role || ' text=' || length(text) || ' turn=' || turn AS line FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations) WHERE k <= 50")
def o08(spark, d):
    rows = runs.first_rows(table(spark, d, "conversations").select("conv_id", "turn", "role", F.length("text").cast("string").alias("n")), ["conv_id"], ["turn"], 50)
    pairs = [F.concat(F.lit(f"{k}="), F.col(c).cast("string")) for k, c in (("role", "role"), ("text", "n"), ("turn", "turn"))]
    return rows.select("conv_id", "turn", F.concat_ws(" ", *pairs).alias("line"))


CAUSES = (("error", "input_missing"), ("purchase", "price_changed"), ("refund", "never_seen"))


@query("O13_causes", "SELECT DISTINCT user_id, cause FROM events JOIN (VALUES ('error', 'input_missing'), ('purchase', 'price_changed'), ('refund', 'never_seen')) r(event_type, cause) USING (event_type)")
def o13(spark, d):
    """Causes whose signal is present, by a fixed rule table of three rows."""
    rules = F.broadcast(spark.createDataFrame(CAUSES, "event_type string, cause string"))
    return table(spark, d, "events").select("user_id", "event_type").distinct().join(rules, "event_type").select("user_id", "cause").distinct()


