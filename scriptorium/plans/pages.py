"""Completeness of pages and batches as queries: expected against present ranges, extraction, selection, merge errors.

The documents of a source are a project whose pages are document ids; the views of a user are batches whose page range
begins at the hour of the view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions import text as t
from scriptorium.operators import intervals
from scriptorium.operators.stored import Stored
from scriptorium.sources.tables import table

QUERIES, SQL = {}, {}


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return register


def _rows(df: DataFrame, keys: list[str], level: str, code: str, message) -> DataFrame:
    return df.select(*keys, F.lit(level).alias("level"), F.lit(code).alias("code"), message.alias("message"))


def extraction_findings(totals: DataFrame, present: DataFrame, keys: list[str], page: str) -> DataFrame:
    """``keys, level, code, message``: pages 1 to ``total`` of each key against the distinct pages that it has.

    ``totals``: ``keys, total``; a key without a page has all of them missing, one without a total is not looked at.
    """
    there = Stored(intervals.of_values(present.join(totals.select(*keys), keys, "left_semi"), keys, page)).df
    expected = totals.select(*keys, F.lit(1).alias("lo"), F.col("total").alias("hi"))
    missing = Stored(intervals.compact(intervals.difference(expected, there, keys), keys)).df
    extra = Stored(intervals.compact(intervals.difference(there, expected, keys), keys)).df
    none = F.lit("none")
    have = totals.join(intervals.compact(there, keys), keys, "left").withColumn("n", F.coalesce("n_pages", F.lit(0)))
    flawed = missing.select(*keys).unionAll(extra.select(*keys)).distinct()
    pages = F.concat(F.lit("pages="), "pages")
    counts = F.concat(F.lit("pdf_pages="), "total", F.lit(" extracted_pages="), "n")
    return (
        _rows(have, keys, "INFO", "extraction.pdf_pages_total", F.col("total").cast("string"))
        .unionAll(_rows(have, keys, "INFO", "extraction.source_lines_pdf_pages", F.concat(F.lit("count="), "n", F.lit(" pages="), F.coalesce("pages", none))))
        .unionAll(_rows(missing, keys, "UNCERTAIN", "extraction.pdf_pages_missing", pages))
        .unionAll(_rows(extra, keys, "UNCERTAIN", "extraction.pdf_pages_extra", pages))
        .unionAll(_rows(have.join(flawed, keys, "left_semi"), keys, "UNCERTAIN", "extraction.completeness_unverified", counts))
        .unionAll(_rows(have.join(flawed, keys, "left_anti"), keys, "INFO", "extraction.completeness_verified", F.lit("true")))
    )


def display_page_findings(present: DataFrame, keys: list[str], page: str) -> DataFrame:
    """Pages of a key's lines, and those missing between its first and last."""
    there = Stored(intervals.of_values(present, keys, page)).df
    missing = intervals.compact(intervals.holes(there, keys), keys)
    said = F.concat(F.lit("count="), "n_pages", F.lit(" pages="), "pages")
    return _rows(intervals.compact(there, keys), keys, "INFO", "source_lines.display_pages", said).unionAll(_rows(missing, keys, "WARN", "source_lines.display_pages_missing", F.concat(F.lit("pages="), "pages")))


def selection_findings(batches: DataFrame, key: str) -> DataFrame:
    """``key, level, code, lo, hi, page``: what speaks against taking one batch (``batch, lo, hi``) of several for the whole.

    The longest batch is taken, then the one that ends last, begins last, and has the largest name.  If it is not the
    whole range, ``batch.auto_select`` names the first page it lacks; ``batch.uncovered`` the first that no batch has.
    """
    real = Stored(batches.filter("lo <= hi")).df
    chosen = real.groupBy(key).agg(F.max(F.struct((F.col("hi") - F.col("lo")).alias("n"), "hi", "lo", "batch")).alias("c"), F.min("lo").alias("first"), F.max("hi").alias("last"), F.count("*").alias("n"))
    lacks = F.when(F.col("c.lo") > F.col("first"), F.col("first")).otherwise(F.col("c.hi") + 1)
    partial = chosen.filter((F.col("n") > 1) & ((F.col("c.lo") != F.col("first")) | (F.col("c.hi") != F.col("last"))))
    partial = partial.select(key, F.lit("FAIL").alias("level"), F.lit("batch.auto_select").alias("code"), F.col("c.lo").alias("lo"), F.col("c.hi").alias("hi"), lacks.alias("page"))
    hole = intervals.holes(real, [key]).groupBy(key).agg(F.min("lo").alias("page"))
    open_ = hole.join(chosen, key).select(key, F.lit("WARN").alias("level"), F.lit("batch.uncovered").alias("code"), F.col("first").alias("lo"), F.col("last").alias("hi"), "page")
    return partial.unionAll(open_)


def merge_findings(batches: DataFrame, entries: DataFrame, project: str) -> DataFrame:
    """``project, batch, code, message``: why the batches of a project cannot be merged.

    ``batches``: ``project, batch, lo, hi``; ``entries``: ``project, batch, at, lo, hi, id``.  Batches come in order of their range and
    name; of several entries with one id the first counts and each later one is an error.
    """
    no_pages = batches.filter("lo is null or hi is null").select(project, "batch", F.lit("merge.source_pages").alias("code"), F.lit("start/end must be int").alias("message"))
    blank = F.col("id").isNull() | F.col("id").rlike("^\\s*$")
    unnamed = entries.filter(blank).select(project, "batch", F.lit("merge.entry_id_missing").alias("code"), F.concat(F.lit("entries["), "at", F.lit("]")).alias("message"))
    place = F.row_number().over(Window.partitionBy(project, "id").orderBy(F.asc_nulls_last("lo"), F.asc_nulls_last("hi"), "batch", "at"))
    again = entries.filter(~blank).withColumn("k", place).filter("k > 1").select(project, "batch", F.lit("merge.entry_id_duplicate").alias("code"), F.col("id").alias("message"))
    return no_pages.unionAll(unnamed).unionAll(again)


def report_texts(findings: DataFrame, key: str) -> DataFrame:
    """``key, report``: findings as lines ``LEVEL CODE message``, which ``captions.parse_findings`` reads again; a report holds one key's findings by definition."""
    line = F.concat_ws(" ", "level", "code", "message")
    return findings.groupBy(key).agg(F.concat(F.array_join(F.array_sort(F.collect_list(line)), "\n"), F.lit("\n")).alias("report"))


def _expected(spark, d):
    ids = table(spark, d, "documents").groupBy(F.col("source").alias("part")).agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    return ids.select("part", F.greatest(F.lit(1), "lo").alias("lo"), (F.col("hi") + 5).alias("hi"))


def _labelled(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.col("source").alias("part"))
    return docs.join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi")


_EXPECTED = "x AS (SELECT source AS part, greatest(1, min(doc_id)) AS lo, max(doc_id) + 5 AS hi FROM documents GROUP BY source)"
_LABELLED = "p AS (SELECT DISTINCT source AS part, doc_id AS v FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))"


@query(
    "J17_expected_pages",
    f"WITH {_EXPECTED}, {_LABELLED}, b AS (SELECT x.part, v, coalesce(lag(v) OVER (PARTITION BY x.part ORDER BY v), lo - 1) AS before, hi FROM x JOIN p ON p.part = x.part AND v BETWEEN lo AND hi) SELECT part, before + 1 AS lo, v - 1 AS hi FROM b WHERE v > before + 1 UNION ALL SELECT x.part, coalesce(m, x.lo - 1) + 1, x.hi FROM x LEFT JOIN (SELECT part, max(v) AS m FROM b GROUP BY part) l ON l.part = x.part WHERE coalesce(m, x.lo - 1) < x.hi",
)
def j17(spark, d):
    """The expected pages of a part that no labelled document has, as ranges."""
    return intervals.difference(_expected(spark, d), intervals.of_values(_labelled(spark, d), ["part"], "doc_id"), ["part"])


_PAGES = "string_agg(CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE lo || '-' || hi END, ',' ORDER BY lo)"


def _runs(points: str) -> str:
    """Maximal runs of ``part, v``."""
    return f"(SELECT part, min(v) AS lo, max(v) AS hi, count(*) AS n FROM (SELECT part, v, v - row_number() OVER (PARTITION BY part ORDER BY v) AS r FROM ({points})) GROUP BY part, r)"


_PRESENT = "p AS (SELECT DISTINCT source AS part, doc_id AS v FROM documents UNION SELECT 'whole', doc_id + 1 FROM documents), x AS (SELECT source AS part, count(*) AS total FROM documents GROUP BY source UNION ALL SELECT 'whole', count(*) FROM documents HAVING count(*) > 0)"
_SERIES = "s AS (SELECT part, unnest(range(1, total + 1)) AS v FROM x)"


@query(
    "V05_extraction_rules",
    f"WITH {_PRESENT}, {_SERIES}, h AS (SELECT part, {_PAGES} AS pages, CAST(sum(n) AS BIGINT) AS n FROM {_runs('SELECT * FROM p')} GROUP BY part), missing AS (SELECT part, {_PAGES} AS pages FROM {_runs('SELECT * FROM s EXCEPT SELECT * FROM p')} GROUP BY part), extra AS (SELECT part, {_PAGES} AS pages FROM {_runs('SELECT * FROM p EXCEPT SELECT * FROM s')} GROUP BY part)"
    " SELECT part, 'INFO' AS level, 'extraction.pdf_pages_total' AS code, CAST(total AS VARCHAR) AS message FROM x"
    " UNION ALL SELECT part, 'INFO', 'extraction.source_lines_pdf_pages', 'count=' || n || ' pages=' || pages FROM h"
    " UNION ALL SELECT part, 'UNCERTAIN', 'extraction.pdf_pages_missing', 'pages=' || pages FROM missing"
    " UNION ALL SELECT part, 'UNCERTAIN', 'extraction.pdf_pages_extra', 'pages=' || pages FROM extra"
    " UNION ALL SELECT x.part, 'UNCERTAIN', 'extraction.completeness_unverified', 'pdf_pages=' || total || ' extracted_pages=' || n FROM x JOIN h ON h.part = x.part WHERE x.part IN (SELECT part FROM missing UNION SELECT part FROM extra)"
    " UNION ALL SELECT part, 'INFO', 'extraction.completeness_verified', 'true' FROM x WHERE part NOT IN (SELECT part FROM missing UNION SELECT part FROM extra)",
)
def v05(spark, d):
    """Documents of a source against pages 1 to their number; and all documents, as one project more, whose ids are without a gap."""
    docs = table(spark, d, "documents")
    present = docs.select(F.col("source").alias("part"), F.col("doc_id").alias("page")).unionAll(docs.select(F.lit("whole").alias("part"), (F.col("doc_id") + 1).alias("page")))
    totals = docs.groupBy(F.col("source").alias("part")).agg(F.count("*").alias("total")).unionAll(docs.groupBy(F.lit("whole").alias("part")).agg(F.count("*").alias("total")))
    return extraction_findings(totals, present, ["part"], "page")


@query(
    "V06_display_page_rules",
    f"WITH {_LABELLED}, h AS (SELECT part, {_PAGES} AS pages, CAST(sum(n) AS BIGINT) AS n FROM {_runs('SELECT * FROM p')} GROUP BY part), gaps AS (SELECT part, before + 1 AS lo, v - 1 AS hi FROM (SELECT part, v, lag(v) OVER (PARTITION BY part ORDER BY v) AS before FROM p) WHERE v > before + 1)"
    f" SELECT part, 'INFO' AS level, 'source_lines.display_pages' AS code, 'count=' || n || ' pages=' || pages AS message FROM h UNION ALL SELECT part, 'WARN', 'source_lines.display_pages_missing', 'pages=' || {_PAGES} FROM gaps GROUP BY part",
)
def v06(spark, d):
    return display_page_findings(_labelled(spark, d), ["part"], "doc_id")


_BATCHES = "b AS (SELECT user_id, event_id AS batch, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS lo, CAST(floor(epoch(ts) / 3600) + floor(value / 9) - 2 AS BIGINT) AS hi FROM events WHERE event_type = 'view')"


def _view_batches(spark, d):
    hour = F.floor(t.seconds(F.col("ts")) / 3600)
    return table(spark, d, "events").filter("event_type = 'view'").select("user_id", F.col("event_id").alias("batch"), hour.alias("lo"), (hour + F.floor(F.col("value") / 9) - 2).alias("hi"))


@query(
    "V07_selection_rules",
    f"WITH {_BATCHES}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY hi - lo DESC, hi DESC, lo DESC, batch DESC) AS k, min(lo) OVER (PARTITION BY user_id) AS first_page, max(hi) OVER (PARTITION BY user_id) AS last_page, max(hi) OVER (PARTITION BY user_id ORDER BY lo, hi, batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until FROM b WHERE lo <= hi)"
    " SELECT user_id, 'FAIL' AS level, 'batch.auto_select' AS code, lo, hi, CASE WHEN lo > first_page THEN first_page ELSE hi + 1 END AS page FROM r WHERE k = 1 AND (lo <> first_page OR hi <> last_page)"
    " UNION ALL SELECT user_id, 'WARN', 'batch.uncovered', min(first_page), max(last_page), min(until) + 1 FROM r WHERE lo > until + 1 GROUP BY user_id",
)
def v07(spark, d):
    return selection_findings(_view_batches(spark, d), "user_id")


@query(
    "V08_merge_rules",
    "WITH e AS (SELECT c.role AS project, c.conv_id AS batch, c.turn AS at_turn, CASE WHEN c.conv_id % 10 = 3 THEN NULL ELSE c.conv_id END AS lo, c.conv_id + 2 AS hi, CASE WHEN length(text) % 11 = 0 THEN ' ' ELSE 'e' || length(text) END AS id FROM conversations c)"
    " SELECT DISTINCT project, batch, 'merge.source_pages' AS code, 'start/end must be int' AS message FROM e WHERE lo IS NULL"
    " UNION ALL SELECT project, batch, 'merge.entry_id_missing', 'entries[' || at_turn || ']' FROM e WHERE id = ' '"
    " UNION ALL SELECT project, batch, 'merge.entry_id_duplicate', id FROM (SELECT *, row_number() OVER (PARTITION BY project, id ORDER BY lo NULLS LAST, hi NULLS LAST, batch, at_turn) AS k FROM e WHERE id <> ' ') WHERE k > 1",
)
def v08(spark, d):
    """A role is a project, its turns of a conversation a batch; ids are made from lengths, so some repeat or are blank."""
    lo = F.when(F.col("conv_id") % 10 != 3, F.col("conv_id"))
    named = F.when(F.length("text") % 11 == 0, " ").otherwise(F.concat(F.lit("e"), F.length("text")))
    rows = table(spark, d, "conversations").select(F.col("role").alias("project"), F.col("conv_id").alias("batch"), F.col("turn").alias("at"), lo.alias("lo"), (F.col("conv_id") + 2).alias("hi"), named.alias("id"))
    return merge_findings(rows.select("project", "batch", "lo", "hi").distinct(), rows, "project")


@query("K02_report_lines", "WITH v AS (" + SQL["V08_merge_rules"] + ") SELECT project, string_agg('FAIL ' || code || ' ' || batch || ' ' || message, chr(10) ORDER BY 'FAIL ' || code || ' ' || batch || ' ' || message) || chr(10) AS report FROM v GROUP BY project")
def k02(spark, d):
    """A report for each project: a finding per line, in order, with a line feed behind the last."""
    return report_texts(v08(spark, d).select("project", F.lit("FAIL").alias("level"), "code", F.concat_ws(" ", "batch", "message").alias("message")), "project")
