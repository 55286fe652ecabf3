"""Coverage, fuzzy and one-to-one matching, and further ordered operators, as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.operators import runs
from scriptorium.sources.tables import table

QUERIES, SQL = {}, {}


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return register


@query("J04_unused_rows", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def j04(spark, d):
    used = table(spark, d, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, d, "part").select("p_partkey").join(used, "p_partkey", "left_anti")


_WORDS = "list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z][a-z''-]*'), lambda w: length(w) >= 6))"


@query("J09_unique_match", "SELECT l_orderkey, l_partkey FROM (SELECT l_orderkey, l_partkey, count(*) OVER (PARTITION BY l_orderkey) AS a, count(*) OVER (PARTITION BY l_partkey) AS b FROM lineitem WHERE l_quantity = 50) WHERE a = 1 AND b = 1")
def j09(spark, d):
    pairs = table(spark, d, "lineitem").filter("l_quantity = 50").select("l_orderkey", "l_partkey")
    orders = pairs.groupBy("l_orderkey").agg(F.count("*").alias("a"), F.max("l_partkey").alias("l_partkey")).filter("a = 1")
    parts = pairs.groupBy("l_partkey").agg(F.count("*").alias("b")).filter("b = 1")
    return orders.join(parts, "l_partkey", "left_semi").select("l_orderkey", "l_partkey")


@query("J10_coalesced_match", "SELECT o_orderkey, coalesce((SELECT max(l_partkey) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R'), (SELECT min(l_partkey) FROM lineitem WHERE l_orderkey = o_orderkey), -1) AS partkey FROM orders")
def j10(spark, d):
    best = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("high"), F.min("l_partkey").alias("low"))
    return table(spark, d, "orders").select("o_orderkey").join(best, "o_orderkey", "left").select("o_orderkey", F.coalesce("high", "low", F.lit(-1)).alias("partkey"))


@query("J18_two_sided_anti", "(SELECT doc_id, 'unlabelled' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) UNION ALL (SELECT doc_id, 'unknown' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))")
def j18(spark, d):
    docs, labels = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id")
    return docs.join(labels, "doc_id", "left_anti").withColumn("side", F.lit("unlabelled")).unionByName(labels.join(docs, "doc_id", "left_anti").withColumn("side", F.lit("unknown")))


@query("G18_label_counts", "SELECT string_agg(role || '=' || n, ' ' ORDER BY role) AS counts FROM (SELECT role, count(*) AS n FROM conversations GROUP BY role)")
def g18(spark, d):
    n = table(spark, d, "conversations").groupBy("role").agg(F.count("*").alias("n"))
    return n.agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "role", "n"))), " ").alias("counts"))


@query("G26_distinct_pages", "SELECT source, string_agg(l, ',' ORDER BY l) AS langs FROM (SELECT DISTINCT source, lang AS l FROM documents) GROUP BY source")
def g26(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("langs"))


@query("W10_group_change", "SELECT conv_id, turn FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations) WHERE before IS NULL OR before <> role")
def w10(spark, d):
    before = F.lag("role").over(runs.ordered(["conv_id"], ["turn"]))
    return table(spark, d, "conversations").withColumn("before", before).filter("before is null or before <> role").select("conv_id", "turn")


@query("W13_first_blocking", "SELECT event_id, CASE WHEN r = 1 THEN 'OPEN' ELSE 'FROZEN' END AS state FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events WHERE event_type = 'error')")
def w13(spark, d):
    place = F.row_number().over(runs.ordered(["user_id"], ["ts", "event_id"]))
    return table(spark, d, "events").filter("event_type = 'error'").withColumn("r", place).select("event_id", F.when(F.col("r") == 1, "OPEN").otherwise("FROZEN").alias("state"))


@query("T04_scored_top2", "SELECT l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS r FROM lineitem) WHERE r <= 2")
def t04(spark, d):
    return runs.first_rows(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), ["l_orderkey"], [F.desc("l_extendedprice"), "l_linenumber"], 2).select("l_orderkey", "l_linenumber")


