"""Operator 12: secret scans over an incremental ledger of blobs, in DataFrame functions only.

1. Every version of a path is addressed by the SHA-256 of its text, its blob.
2. The ledger holds which blob was scanned by which version of which rule and what was found.  Pairs that it has are
   not scanned again, whatever paths or later versions bring the text back, and of equal texts one is scanned.
3. A rule's leftmost matches that do not overlap cut a text into pieces; running sums over the lengths of pieces and
   matches give their places.  Only these numbers are shuffled, by blob.
4. Findings are joined back to all paths of their blob; blobs of very many paths go to all executors.

A commit to the ledger is a folder of its own that counts once Spark has marked it complete, so a run that dies
leaves the ledger as it was.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.llm.common import BROADCAST_LIMIT, Written, _filesystem, join_classes, shared_dir, table


class Rule(NamedTuple):
    """A match counts if its group ``group`` (0: all of it) has ``least`` characters; a changed rule needs a new version."""

    name: str
    version: int
    pattern: str
    group: int
    least: int


#: In the order that breaks ties of place.  A run of 24 and more of one class is the same match as a whole run that is
#: then held against 24, and so for the access key; what an assignment that is dropped has eaten stays eaten.
RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)
ENTRY = "blob binary, rules array<struct<rule:string,version:int>>, spans array<struct<start:int,rule:string,version:int,end:int>>"


class Ledger:
    """Scanned blobs: ``blob``, the ``rules`` of a scan, and all ``spans`` that they found in it."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        """``path``: a folder that all executors share; a new one under the shared folder if not given."""
        self.spark, self.path = spark, path or f"{shared_dir(spark)}/scriptorium-ledger-{uuid.uuid4().hex}"

    def commits(self) -> list[str]:
        fs, folder = _filesystem(self.spark, self.path)
        if not fs.exists(folder):
            return []
        new = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return sorted(str(s.getPath()) for s in fs.listStatus(folder) if fs.exists(new(s.getPath(), "_SUCCESS")))

    def entries(self) -> DataFrame:
        found = self.commits()
        return self.spark.read.schema(ENTRY).parquet(*found) if found else self.spark.createDataFrame([], ENTRY)

    def add(self, entries: DataFrame) -> None:
        entries.write.parquet(f"{self.path}/commit-{uuid.uuid4().hex}")


def _names(rules: tuple[Rule, ...]) -> Column:
    return F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules])


def matches(text: Column, rule: Rule) -> Column:
    """Per match: its ``place`` in order, the ``gap`` since the last one, its ``size`` and whether it is ``kept``; in code points."""
    own = F.lit(rule.pattern)
    kept = lambda m: F.length(F.regexp_extract(m, rule.pattern, rule.group)) >= rule.least if rule.group else F.length(m) >= rule.least
    found = F.transform(F.regexp_extract_all(text, own, F.lit(0)), lambda m, k: F.struct(k.alias("place"), F.length(m).alias("size"), kept(m).alias("kept")))
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda piece: F.length(piece))
    name = [F.lit(rule.name).alias("rule"), F.lit(rule.version).alias("version")]
    joined = F.zip_with(gaps, found, lambda gap, m: F.when(m.isNotNull(), F.struct(*name, m["place"].alias("place"), gap.alias("gap"), m["size"].alias("size"), m["kept"].alias("kept"))))
    return F.filter(joined, lambda m: m.isNotNull())


def scanned(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob, rules, found``: the matches in each text of ``blob, body, rules``, by those of the rules that its row names."""
    none = F.array().cast("array<struct<rule:string,version:int,place:int,gap:int,size:int,kept:boolean>>")
    due = lambda r: F.exists("rules", lambda x: (x["rule"] == r.name) & (x["version"] == r.version)) & F.col("body").rlike(r.pattern)
    found = F.concat(*[F.when(due(r), matches(F.col("body"), r)).otherwise(none) for r in rules])
    return texts.select("blob", "rules", found.alias("found"))


def _placed(found: DataFrame) -> DataFrame:
    """Ledger entries from matches; a blob's meet in one task, which holds what one text has and no more."""
    hit = F.size("found") > 0
    rows = found.filter(hit).select("blob", "rules", F.explode("found").alias("m")).select("blob", "rules", "m.*").repartition("blob")
    so_far = Window.partitionBy("blob", "rule").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far).cast("int"))
    span = F.struct((F.col("end") - F.col("size")).alias("start"), "rule", "version", "end")
    spans = ends.groupBy("blob").agg(F.first("rules").alias("rules"), F.collect_list(F.when(F.col("kept"), span)).alias("spans"))
    return spans.unionByName(found.filter(~hit).select("blob", "rules", F.array().cast("array<struct<start:int,rule:string,version:int,end:int>>").alias("spans")))


def _texts(rows: DataFrame, due: Written) -> DataFrame:
    """One text of every blob of ``due (blob, rules)``: copies are combined where they are, then one text a blob is shuffled.

    Blobs that are few, as after the first commit, are picked by a broadcast before that.
    """
    if due.bytes * 4 <= BROADCAST_LIMIT:
        rows = rows.join(F.broadcast(due.df.select("blob")), "blob", "left_semi")
    return rows.groupBy("blob").agg(F.first("body").alias("body")).join(due.df, "blob").select("blob", "body", "rules")


def scan_unseen(versions: DataFrame, rows: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> None:
    """Scans the pairs of blob and rule that the ledger lacks, and commits them; without any, nothing is written.

    ``versions``: a written table with ``blob``; ``rows (blob, body)``: the texts, read only if there are such pairs.
    """
    everything = _names(rules)
    blobs = versions.select("blob").distinct()
    if ledger.commits():
        seen = ledger.entries().groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen"))
        unseen = F.array_except(everything, F.coalesce("seen", F.array_except(everything, everything)))
        blobs = blobs.join(seen, "blob", "left").select("blob", unseen.alias("rules")).filter("size(rules) > 0")
    else:
        blobs = blobs.withColumn("rules", everything)
    due = Written(blobs, "due")
    if due.df.isEmpty():
        return
    found = Written(scanned(_texts(rows, due), rules), "found")
    ledger.add(_placed(found.df))
    due.drop()
    found.drop()


def scan(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, blob, spans`` of every row: ``start, rule, end`` of all findings, by place, then in the rules' order.

    Null texts equal the empty text, which has no finding.  Null ids and repeated rows each give a row; of a row's
    text every version is a blob of its own, so rows of one id need not agree.  An empty table gives no row and leaves
    the ledger as it is; other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("body"))
    rows = rows.withColumn("blob", F.unhex(F.sha2("body", 256)))
    versions = Written(rows.select("doc_id", "blob"), "versions").df
    scan_unseen(versions, rows.select("blob", "body"), ledger, rules)
    order = F.array(*[F.lit(r.name) for r in rules])
    now = lambda s: F.array_contains(_names(rules), F.struct(s["rule"], s["version"]))
    placed = F.transform(F.filter("spans", now), lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["rule"]).alias("at"), s["rule"].alias("rule"), s["end"].alias("end")))
    valid = ledger.entries().filter(F.exists("spans", now)).select("blob", placed.alias("spans"))
    hits = valid.groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))
    counts = versions.groupBy("blob").agg(F.count(F.lit(1)).alias("n"))
    findings = Written(hits.join(counts, "blob"), "findings")
    met = join_classes(versions, findings, "blob", "n", versions.count())
    spans = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["rule"].alias("rule"), s["end"].alias("end")))
    return met.select("doc_id", "blob", F.coalesce(spans, F.array().cast("array<struct<start:int,rule:string,end:int>>")).alias("spans"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The findings of every document as counts and digests; a ledger of its own, so every distinct text is scanned once."""
    found = scan(table(spark, sf_dir, "documents"), Ledger(spark))
    count = lambda name: F.size(F.filter("spans", lambda s: s["rule"] == name)).cast("long").alias(f"n_{name}")
    said = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", *[count(r.name) for r in RULES], F.sha2(said, 256).alias("base_sha256"), said.alias("spans"))


def _sql() -> str:
    either = lambda words: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)
    patterns = {
        "assign": either("(password|passwd|secret|token|api_?key)") + r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        "access": "AKIA[A-Z0-9]+",
        "hex": "[0-9a-f]+",
    }
    least = {"assign": 6, "access": 20, "hex": 24}
    one = "\n  UNION ALL ".join(
        f"SELECT doc_id, '{name}' AS kind, {k} AS place_no, unnest(range(len(regexp_extract_all(t, '{p}')))) AS place, unnest(list_transform(regexp_extract_all(t, '{p}'), lambda m: length(m))) AS size,"
        f" unnest(list_transform(regexp_extract_all(t, '{p}', {2 if name == 'assign' else 0}), lambda m: length(m) >= {least[name]})) AS kept,"
        f" unnest(list_transform(string_split_regex(t, '{p}')[1:len(regexp_extract_all(t, '{p}'))], lambda g: length(g))) AS gap FROM d"
        for k, (name, p) in enumerate(patterns.items())
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  {one}
),
s AS (SELECT doc_id, kind, place_no, kept, size, sum(gap + size) OVER (PARTITION BY doc_id, kind ORDER BY place) AS stop FROM m),
f AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || CAST(stop - size AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY stop - size, place_no) AS spans
  FROM s WHERE kept GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN f ON d.doc_id = f.doc_id
"""


OP12_SQL = _sql()
