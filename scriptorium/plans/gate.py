"""The gate after signals are recorded (record, check, diagnostic report), and what a project's folders hold, as queries."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import script as s
from scriptorium.operators import runs
from scriptorium.plans.artifacts import _json_files
from scriptorium.plans.script import PLACED, ROUTE, placed
from scriptorium.sources import batches
from scriptorium.sources.tables import LINES, lines, table

QUERIES, SQL = {}, {}
# Kinds of signals in their order, states that block, what each state means, and ids of known failures.
SIGNALS = ("structural_signal", "warning_signal", "noise_signal")
BLOCKING = ("ISSUE DETECTED", "UNCERTAIN")
STATES = {"NO ISSUE DETECTED": "PASS", "OUT OF SCOPE FINDING": "PARTIAL", "ISSUE DETECTED": "FAIL", "UNCERTAIN": "FAIL"}
FAILURE_MODES = ("FM-001", "FM-003", "FM-005", "FM-006")
CAUSES = {
    "warning_signal.unclassified": "Stage 2 retained unmatched source-structure evidence as warning signals.",
    "noise_signal.candidate": "Stage 2 retained low-confidence source candidates for traceability.",
    "": "Stage 2 validation artifacts are not confirmed as complete.",
}
CHECKS = {
    "": "Check work/logs/stage-2-confirmation.json before Stage 3.",
    "warning_signal.unclassified": "Review warning_signal entries in work/reports/sample-validation.txt.",
    "noise_signal.candidate": "Keep noise_signal candidates as traceability evidence only.",
    "FAIL": "Review Stage 1-2 validation artifacts before continuing.",
}
INVENTORY = {"marker": "known_markers", "unclassified": "unclassified_signals", "noise": "noise_candidates"}
FIRST_SIGNALS = 50
TRANSLATED = "^translated-p([0-9]+)(-([0-9]+))?\\.json$"
RECORDS = "array<struct<place:long,line:long,code:string>>"


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return register


def summaries(logs: DataFrame, key: str) -> DataFrame:
    """State (missing or empty: uncertain), number and digest of records (missing: none), and signals of each kind, per finding log."""
    records = F.coalesce(F.col("records").cast(RECORDS), F.array().cast(RECORDS))
    codes = F.transform("records", lambda r: F.regexp_extract(r["code"], "^([^.]*)\\.", 1))
    counts = [F.size(F.filter(codes, F.lit(kind).__eq__)).alias(f"n_{kind}") for kind in SIGNALS]
    rows = logs.select(key, "log_path", F.coalesce(F.nullif("overall_state", F.lit("")), F.lit("UNCERTAIN")).alias("state"), records.alias("records"))
    return rows.select("*", F.size("records").alias("n_records"), F.sha2(F.to_json("records"), 256).alias("digest"), *counts)


def gate_records(logs: DataFrame, key: str) -> DataFrame:
    """The record that lets work go on, per finding log; where the state blocks, ``refused`` says so and nothing is confirmed."""
    blocked = F.col("state").isin(*BLOCKING)
    refused = F.when(blocked, F.concat(F.lit("stage2 findings are blocking: state="), "state"))
    source = [F.when(~blocked, F.col(a)).alias(b) for a, b in (("log_path", "source_log"), ("state", "source_state"), ("n_records", "source_count"), ("digest", "source_digest"))]
    return summaries(logs, key).select(key, refused.alias("refused"), (~blocked).alias("confirmed"), *source, *[F.when(~blocked, F.col(f"n_{kind}")).alias(f"n_{kind}") for kind in SIGNALS])


def gate_check(projects: DataFrame, logs: DataFrame, confirmations: DataFrame, key: str) -> DataFrame:
    """Each project with its log's summary and ``failure``, the first rule that keeps the gate shut (null: open).

    ``confirmations`` has the columns of ``gate_records`` and at most one row per project.
    """
    given = confirmations.select(key, F.lit(True).alias("given"), "confirmed", "source_log", "source_state", "source_count", "source_digest")
    rows = projects.select(key).join(summaries(logs, key), key, "left").join(given, key, "left")
    rules = [
        (F.col("state").isNull(), "stage2.finding_log_missing"),
        (F.col("state").isin(*BLOCKING), "stage2.findings_blocking"),
        (F.col("given").isNull(), "stage2.confirmation_missing"),
        (~F.coalesce("confirmed", F.lit(False)), "stage2.confirmation_unapproved"),
    ]
    same = (("source_log", "log_path", "source_finding_log"), ("source_state", "state", "source_overall_state"), ("source_count", "n_records", "source_records_count"), ("source_digest", "digest", "source_records_digest"))
    rules += [(~F.col(a).eqNullSafe(F.col(b)), f"stage2.confirmation_stale {name}") for a, b, name in same]
    return rows.withColumn("failure", F.coalesce(*[F.when(c, code) for c, code in rules]))


def signal_name(code: Column) -> Column:
    """Kind and name of a signal's code, without the numbers at its end; null for other codes."""
    name = F.regexp_extract(F.regexp_replace(code, "(\\.[0-9]+)+$", ""), "^[^.]*(\\.[^.]*)?", 0)
    return F.when(code.rlike(f"^({'|'.join(SIGNALS)})\\."), name)


def key_signals(codes: Column) -> Column:
    """Names among codes with how often they occur: by kind, then the most frequent first, then by name."""
    names = F.filter(F.transform(codes, signal_name), lambda x: x.isNotNull())
    rank = lambda x: F.array_position(F.array(*map(F.lit, SIGNALS)), F.substring_index(x, ".", 1))
    ranked = F.array_sort(F.transform(F.array_distinct(names), lambda x: F.struct(rank(x).alias("kind"), (-F.size(F.filter(names, lambda y: y == x))).alias("n"), x.alias("name"))))
    often = lambda n: F.when(n <= -50, "high").when(n <= -10, "medium").otherwise("low")
    return F.transform(ranked, lambda x: F.struct(x["name"].alias("signal"), often(x["n"]).alias("frequency")))


def _chosen(*cases: tuple[Column, str]) -> Column:
    return F.filter(F.array(*[F.when(c, F.lit(v)) for c, v in cases]), lambda x: x.isNotNull())


def recommended_checks(state: Column, signals: Column, is_open: Column) -> Column:
    return _chosen(*[(~is_open if name == "" else state == name if name == "FAIL" else F.array_contains(signals, name), text) for name, text in CHECKS.items()])


def likely_causes(signals: Column, is_open: Column) -> Column:
    return _chosen(*[(F.array_contains(signals, name) if name else ~is_open, text) for name, text in CAUSES.items()])


def diagnostic_report(checked: DataFrame, key: str, pages_missing: Column, known: Iterable[str] = FAILURE_MODES) -> DataFrame:
    """A report per project that has a log, from rows of ``gate_check``; ``pages_missing`` says that its report names missing pages."""
    is_open = F.col("failure").isNull()
    state = F.coalesce(*[F.when(is_open & (F.col("state") == a), b) for a, b in STATES.items()], F.lit("FAIL"))
    rows = checked.filter("state is not null").withColumns({"system_state": state, "key_signals": key_signals(F.transform("records", lambda r: r["code"]))})
    signals = F.transform("key_signals", lambda x: x["signal"])
    modes = {
        "FM-001": ~is_open & ((F.col("n_warning_signal") > 0) | (F.col("n_noise_signal") > 0)),
        "FM-003": (F.col("state") == "OUT OF SCOPE FINDING") & (F.col("n_records") == 0),
        "FM-005": ~is_open,
        "FM-006": F.coalesce(pages_missing, F.lit(False)),
    }
    found = _chosen(*[(c, mode) for mode, c in modes.items() if mode in set(known)])
    return rows.select(key, "system_state", "key_signals", found.alias("failure_modes"), likely_causes(signals, is_open).alias("causes"), recommended_checks(F.col("system_state"), signals, is_open).alias("checks"))


def _logs(spark, d) -> DataFrame:
    """A finding log per part, whose records are its lines; some parts have none, and some logs hold no list."""
    other = F.when(F.col("l_linenumber") == 7, "info.note").otherwise(F.concat(F.lit("structural_signal.marker."), "l_linenumber"))
    code = F.when(F.col("l_returnflag") == "R", "warning_signal.unclassified").when(F.col("l_returnflag") == "A", "noise_signal.candidate").otherwise(other)
    record = F.struct(F.col("l_orderkey").alias("place"), F.col("l_linenumber").cast("long").alias("line"), code.alias("code"))
    records = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.array_sort(F.collect_list(record)).alias("records"))
    k = F.col("p_partkey")
    state = F.when(k % 5 < 4, F.element_at(F.array(*map(F.lit, STATES)), (k % 5 + 1).cast("int")))
    rows = table(spark, d, "part").filter(k % 17 != 0).select("p_partkey", F.concat(F.lit("logs/"), k.cast("string")).alias("log_path"), state.alias("overall_state"))
    return rows.join(records, "p_partkey", "left").withColumn("records", F.when(k % 23 != 0, F.col("records")))


def _checked(spark, d) -> DataFrame:
    logs, k = _logs(spark, d), F.col("p_partkey")
    given = gate_records(logs, "p_partkey").filter((k % 3 != 0) & F.col("refused").isNull())
    given = given.withColumns({
        "confirmed": k % 7 != 0, "source_log": F.when(k % 19 == 0, "elsewhere").otherwise(F.col("source_log")), "source_state": F.when(k % 11 == 0, "UNCERTAIN").otherwise(F.col("source_state")),
        "source_count": F.col("source_count") + (k % 4 == 0).cast("int"), "source_digest": F.when(k % 13 == 0, "").otherwise(F.col("source_digest")),
    })
    return gate_check(table(spark, d, "part"), logs, given, "p_partkey")


_CODE = "CASE l_returnflag WHEN 'R' THEN 'warning_signal.unclassified' WHEN 'A' THEN 'noise_signal.candidate' ELSE CASE WHEN l_linenumber = 7 THEN 'info.note' ELSE 'structural_signal.marker.' || l_linenumber END END"
_COUNTED = ", ".join(f"CAST(count(*) FILTER (starts_with(code, '{kind}.')) AS INTEGER) AS n_{kind}" for kind in SIGNALS)
_PER_LOG = f"(SELECT l_partkey, CAST(count(*) AS INTEGER) AS n, '[' || string_agg('{{\"place\":' || l_orderkey || ',\"line\":' || l_linenumber || ',\"code\":\"' || code || '\"}}', ',' ORDER BY l_orderkey, l_linenumber, code) || ']' AS json, {_COUNTED} FROM (SELECT *, {_CODE} AS code FROM lineitem) GROUP BY l_partkey)"
_STATE = "CASE p_partkey % 5 WHEN 0 THEN 'NO ISSUE DETECTED' WHEN 1 THEN 'OUT OF SCOPE FINDING' WHEN 2 THEN 'ISSUE DETECTED' ELSE 'UNCERTAIN' END"
_NAMED = ", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in SIGNALS)
_SUMMARY = f"(SELECT p_partkey, o_missing, {_STATE} AS state, coalesce(n, 0) AS n_records, sha256(coalesce(json, '[]')) AS digest, {_NAMED} FROM (SELECT p_partkey, p_size > 25 AS o_missing FROM part WHERE p_partkey % 17 <> 0) LEFT JOIN {_PER_LOG} ON l_partkey = p_partkey AND p_partkey % 23 <> 0)"
_FAILURE = (
    "CASE WHEN p_partkey % 17 = 0 THEN 'stage2.finding_log_missing' WHEN p_partkey % 5 > 1 THEN 'stage2.findings_blocking' WHEN p_partkey % 3 = 0 THEN 'stage2.confirmation_missing' WHEN p_partkey % 7 = 0 THEN 'stage2.confirmation_unapproved'"
    " WHEN p_partkey % 19 = 0 THEN 'stage2.confirmation_stale source_finding_log' WHEN p_partkey % 11 = 0 THEN 'stage2.confirmation_stale source_overall_state' WHEN p_partkey % 4 = 0 THEN 'stage2.confirmation_stale source_records_count' WHEN p_partkey % 13 = 0 THEN 'stage2.confirmation_stale source_records_digest' END"
)
_KINDS = ", ".join(f"CASE WHEN p_partkey % 5 < 2 THEN n_{kind} END AS n_{kind}" for kind in SIGNALS)


@query("O04_gate_record", f"SELECT p_partkey, CASE WHEN p_partkey % 5 > 1 THEN 'stage2 findings are blocking: state=' || state END AS refused, p_partkey % 5 < 2 AS confirmed, CASE WHEN p_partkey % 5 < 2 THEN 'logs/' || p_partkey END AS source_log, CASE WHEN p_partkey % 5 < 2 THEN state END AS source_state, CASE WHEN p_partkey % 5 < 2 THEN n_records END AS source_count, CASE WHEN p_partkey % 5 < 2 THEN digest END AS source_digest, {_KINDS} FROM {_SUMMARY}")
def o04(spark, d):
    return gate_records(_logs(spark, d), "p_partkey")


@query("V04_gate_check", f"SELECT p_partkey, {_FAILURE} AS failure FROM part")
def v04(spark, d):
    """Rules ``stage2.*``: every way in which a gate stays shut, and open ones."""
    return _checked(spark, d).select("p_partkey", "failure")


_OFTEN = "CASE WHEN n_{0} >= 50 THEN '=high' WHEN n_{0} >= 10 THEN '=medium' ELSE '=low' END"
_SIGNALS = ", ".join(f"CASE WHEN n_{kind} > 0 THEN '{kind}.{name}' || {_OFTEN.format(kind)} END" for kind, name in zip(SIGNALS, ("marker", "unclassified", "candidate")))
_HAS = {"": "shut", "FAIL": "system_state = 'FAIL'", "warning_signal.unclassified": "n_warning_signal > 0", "noise_signal.candidate": "n_noise_signal > 0"}
_REPORT = f"(SELECT *, CASE WHEN shut THEN 'FAIL' WHEN state = 'NO ISSUE DETECTED' THEN 'PASS' ELSE 'PARTIAL' END AS system_state FROM (SELECT *, ({_FAILURE}) IS NOT NULL AS shut FROM {_SUMMARY}))"


def _listed(cases: dict[str, str]) -> str:
    return "concat_ws(' | ', " + ", ".join(f"CASE WHEN {_HAS[name]} THEN '{text}' END" for name, text in cases.items()) + ")"


@query(
    "O12_diagnostic_report",
    f"SELECT p_partkey, system_state, concat_ws(' ', {_SIGNALS}) AS signals, concat_ws(' ', CASE WHEN shut AND (n_warning_signal > 0 OR n_noise_signal > 0) THEN 'FM-001' END, CASE WHEN state = 'OUT OF SCOPE FINDING' AND n_records = 0 THEN 'FM-003' END, CASE WHEN shut THEN 'FM-005' END, CASE WHEN o_missing THEN 'FM-006' END) AS failure_modes, {_listed(CAUSES)} AS causes FROM {_REPORT}",
)
def o12(spark, d):
    sizes = table(spark, d, "part").select("p_partkey", "p_size")
    rows = diagnostic_report(_checked(spark, d).join(sizes, "p_partkey"), "p_partkey", F.col("p_size") > 25)
    signals = F.array_join(F.transform("key_signals", lambda x: F.concat(x["signal"], F.lit("="), x["frequency"])), " ")
    return rows.select("p_partkey", "system_state", signals.alias("signals"), F.array_join("failure_modes", " ").alias("failure_modes"), F.array_join("causes", " | ").alias("causes"))


@query("O14_recommended_checks", f"SELECT p_partkey, {_listed(CHECKS)} AS checks FROM {_REPORT}")
def o14(spark, d):
    return diagnostic_report(_checked(spark, d), "p_partkey", F.lit(False)).select("p_partkey", F.array_join("checks", " | ").alias("checks"))


def draft_entries(entries: DataFrame, markers: DataFrame, key: str) -> DataFrame:
    """Entries as JSON without what a translator still fills in; markers from the top of the page, absent fields left out."""
    at = F.struct(F.coalesce("pdf_page", F.lit(0)), -F.col("y"), F.col("x"), F.col("text"), F.struct("type", "pdf_page", "text", "scene_no", "position").alias("marker"))
    kept = F.transform(F.array_sort(F.collect_list(at)), lambda m: m["marker"])
    rows = entries.join(markers.groupBy(key).agg(kept.alias("markers")), key, "left")
    return rows.select(key, F.to_json(F.struct("id", "type", "display_page", "source", "markers")).alias("json"))


_MARKER = "'{\"type\":\"scene_no\",\"pdf_page\":' || l_linenumber % 3 || ',\"text\":\"m' || l_linenumber || '\",\"scene_no\":\"' || l_suppkey || '\"' || CASE WHEN l_returnflag = 'R' THEN ',\"position\":\"left\"' ELSE '' END || '}'"


@query(
    "O02_draft_entries",
    "SELECT o_orderkey, '{\"id\":\"e' || o_orderkey || '\",\"type\":\"' || CASE WHEN o_orderstatus = 'F' THEN 'action' ELSE 'dialogue' END || '\"' || CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE ',\"display_page\":' || o_orderkey % 9 END || ',\"source\":\"' || o_orderpriority || '\"' || coalesce(',\"markers\":[' || m || ']', '') || '}' AS json"
    f" FROM orders LEFT JOIN (SELECT l_orderkey, string_agg({_MARKER}, ',' ORDER BY l_linenumber % 3, l_quantity DESC, l_extendedprice, 'm' || l_linenumber, {_MARKER}) AS m FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey",
)
def o02(spark, d):
    kind, page = F.when(F.col("o_orderstatus") == "F", "action").otherwise("dialogue"), F.col("o_orderkey") % 9
    entries = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("e"), "o_orderkey").alias("id"), kind.alias("type"), F.when(page != 0, page).alias("display_page"), F.col("o_orderpriority").alias("source"))
    text = F.concat(F.lit("m"), "l_linenumber")
    markers = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.lit("scene_no").alias("type"), (F.col("l_linenumber") % 3).alias("pdf_page"), text.alias("text"), F.col("l_suppkey").cast("string").alias("scene_no"),
        F.when(F.col("l_returnflag") == "R", "left").alias("position"), F.col("l_extendedprice").alias("x"), F.col("l_quantity").alias("y"),
    )
    return draft_entries(entries, markers, "o_orderkey")


def inventory(signals: DataFrame, key: str, order: str, first: int = FIRST_SIGNALS) -> DataFrame:
    """All markers of a scan, the first unclassified and noise signals, and how many there are of each, per ``key``."""
    rows = signals.withColumn("place", F.row_number().over(runs.ordered([key, "route"], [order])))
    kept = {route: (F.col("route") == route) & ((F.col("place") <= first) | (F.col("route") == "marker")) for route in INVENTORY}
    lists = [F.array_sort(F.collect_list(F.when(c, F.col(order)))).alias(INVENTORY[route]) for route, c in kept.items()]
    return rows.groupBy(key).agg(*lists, *[F.count_if(F.col("route") == route).alias(f"n_{route}") for route in INVENTORY])


_KEPT = ", ".join(f"'\"{name}\":[' || coalesce(string_agg(line_no, ',' ORDER BY line_no) FILTER (route = '{route}' AND (place <= {FIRST_SIGNALS} OR route = 'marker')), '') || ']'" for route, name in INVENTORY.items())


@query(
    "O06_inventory",
    f"SELECT doc_id, '{{' || concat_ws(',', {_KEPT}) || '}}' AS json, " + ", ".join(f"count(*) FILTER (route = '{route}') AS n_{route}" for route in INVENTORY) + f" FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, route ORDER BY line_no) AS place FROM (SELECT doc_id, line_no, {ROUTE} AS route FROM {PLACED}) WHERE route IS NOT NULL) GROUP BY doc_id",
)
def o06(spark, d):
    signals = placed(spark, d).select("doc_id", "line_no", s.signal_route(F.col("line"), F.col("x")).alias("route")).filter("route is not null")
    return inventory(signals, "doc_id", "line_no").select("doc_id", F.to_json(F.struct(*INVENTORY.values())).alias("json"), *[f"n_{route}" for route in INVENTORY])


def batch_listing(texts: DataFrame) -> DataFrame:
    """Translated batches by file name: their pages (null where the range is not one) and their entries (null for damaged files)."""
    name = F.substring_index("path", "/", -1)
    rows = batches.parse_batches(texts.filter(name.like("translated-p%.json")))
    start, stop = (F.nullif(F.regexp_extract(name, TRANSLATED, i), F.lit("")).try_cast("long") for i in (1, 3))
    stop = F.coalesce(stop, start)
    pages = [F.when(stop >= start, x).alias(n) for x, n in ((start, "first_page"), (stop, "last_page"), (stop - start + 1, "page_count"))]
    return rows.select("path", *pages, F.when(F.col("damaged").isNull(), F.coalesce(F.size("entries"), F.lit(0))).cast("long").alias("n_entries"))


_FILE = "CASE conv_id % 4 WHEN 0 THEN 'translated-p' || conv_id || '-' || (conv_id + conv_id % 6 - 1) WHEN 1 THEN 'translated-p' || conv_id WHEN 2 THEN 'translated-pages' ELSE 'draft' END"


@query(
    "O17_batch_listing",
    f"SELECT 'b/' || conv_id || '/' || ({_FILE}) || '.json' AS path, CASE WHEN conv_id % 4 = 0 AND conv_id % 6 > 0 OR conv_id % 4 = 1 THEN conv_id END AS first_page, CASE WHEN conv_id % 4 = 0 AND conv_id % 6 > 0 THEN conv_id + conv_id % 6 - 1 WHEN conv_id % 4 = 1 THEN conv_id END AS last_page, CASE WHEN conv_id % 4 = 0 AND conv_id % 6 > 0 THEN conv_id % 6 WHEN conv_id % 4 = 1 THEN 1 END AS page_count, CASE WHEN conv_id % 7 <> 0 THEN count(*) END AS n_entries FROM conversations WHERE conv_id % 4 <> 3 GROUP BY conv_id",
)
def o17(spark, d):
    """Drafts are files of another name, and no part of the listing."""
    entry = F.struct(F.concat(F.lit("e"), "turn").alias("id"), F.col("text").alias("source"))
    texts = _json_files(table(spark, d, "conversations"), "conv_id", "turn", entry, F.lit("entries"))
    file = F.expr(_FILE.replace("conv_id", "cast(path as bigint)"))
    return batch_listing(texts.withColumn("path", F.concat(F.lit("b/"), "path", F.lit("/"), file, F.lit(".json"))))


def clean_candidates(files: DataFrame, project: str, kept: dict[str, tuple[str, ...]], keep_draft: bool = False) -> DataFrame:
    """Transient files of each project: all in its folders but names in ``kept``, its widest translated batch (then the last by name) and, if wanted, its draft."""
    ends = F.split(F.regexp_replace("name", "^translated-p|\\.[^.]*$", ""), "-")
    width = F.coalesce(F.element_at(ends, -1).try_cast("int") - ends[0].try_cast("int"), F.lit(0))
    widest = files.filter((F.col("folder") == "batches") & F.col("name").startswith("translated-")).groupBy(project).agg(F.max(F.struct(width.alias("width"), "name"))["name"].alias("name"))
    rows = files.join(widest.withColumn("folder", F.lit("batches")), [project, "folder", "name"], "left_anti")
    for folder, names in (kept | ({"batches": ("draft.json",)} if keep_draft else {})).items():
        rows = rows.filter(~((F.col("folder") == folder) & F.col("name").isin(*names)))
    return rows


_NAME = "CASE o_orderkey % 3 WHEN 0 THEN CASE WHEN o_orderkey % 5 = 0 THEN 'draft.json' WHEN o_orderkey % 5 = 1 THEN 'translated-notes' || o_orderkey || '.json' ELSE 'translated-p' || o_orderkey || '-' || (o_orderkey + o_orderkey % 4) || '.json' END WHEN 1 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'cost-report.json' ELSE 'r' || o_orderkey END ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'page.html' ELSE 'd' || o_orderkey END END"
_FOLDER = "CASE o_orderkey % 3 WHEN 0 THEN 'batches' WHEN 1 THEN 'reports' ELSE 'dist' END"
_BY_WIDTH = "PARTITION BY o_custkey, folder, starts_with(name, 'translated-') ORDER BY CASE WHEN starts_with(name, 'translated-p') THEN o_orderkey % 4 ELSE 0 END DESC, name DESC"


@query("K07_clean_candidates", f"SELECT o_custkey, folder, name FROM (SELECT *, row_number() OVER ({_BY_WIDTH}) AS r FROM (SELECT o_custkey, o_orderkey, {_FOLDER} AS folder, {_NAME} AS name FROM orders)) WHERE name NOT IN ('cost-report.json', 'page.html') AND NOT (folder = 'batches' AND starts_with(name, 'translated-') AND r = 1)")
def k07(spark, d):
    files = table(spark, d, "orders").select("o_custkey", F.expr(_FOLDER).alias("folder"), F.expr(_NAME).alias("name"))
    return clean_candidates(files, "o_custkey", {"reports": ("cost-report.json", "sample-validation.txt", "subtitle-report.txt"), "dist": ("page.html",)}).select("o_custkey", "folder", "name")


def run_steps(steps: Iterable[tuple[str, Callable[[], object]]]) -> list[tuple[str, Exception | None]]:
    """Runs named steps in order and stops at the first that raises; returns those begun, with what they raised."""
    done = []
    for name, step in steps:
        try:
            step()
            done.append((name, None))
        except Exception as error:
            done.append((name, error))
            break
    return done


def report_signals(lines: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """``key, place, signal, type, frequency`` from stored reports: ``lines (key, line)`` as ``LEVEL CODE message``.

    Names are counted and ordered by kind, then the most frequent first, then by name.  A key whose report names no
    signal takes ``counts (key, type, n)`` of its log instead, as ``type.count``; counts of none do not count.
    """
    code = F.get(F.split(F.trim("line"), "\\s+", 3), 1)
    found = lines.select(key, signal_name(code).alias("signal")).filter("signal is not null").groupBy(key, "signal").agg(F.count(F.lit(1)).alias("n"))
    found = found.select(key, F.substring_index("signal", ".", 1).alias("type"), "signal", "n")
    stored = counts.filter(F.col("type").isin(*SIGNALS) & (F.col("n") > 0)).join(found.select(key).distinct(), key, "left_anti")
    rows = found.unionByName(stored.select(key, "type", F.concat("type", F.lit(".count")).alias("signal"), F.col("n").cast("long").alias("n")))
    rank = F.array_position(F.array(*map(F.lit, SIGNALS)), F.col("type"))
    often = F.when(F.col("n") >= 50, "high").when(F.col("n") >= 10, "medium").otherwise("low")
    return rows.select(key, F.row_number().over(runs.ordered([key], [rank, F.desc("n"), "signal"])).cast("long").alias("place"), "signal", "type", often.alias("frequency"))


#: Lines as report lines: the code by the number of the line, some with numbers at its end, some no signal's.
_CODE = "CASE line_no % 7 " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate((f"{SIGNALS[0]}.marker.3.14", f"{SIGNALS[1]}.shape", f"{SIGNALS[2]}.margin.x.7", f"{SIGNALS[1]}.unpaired.2", "batch.valid", f"{SIGNALS[2]}", ""))) + " END"
_TYPES = ", ".join(f"('{x}', {k})" for k, x in enumerate(SIGNALS))


@query(
    "O12_report_signals",
    f"WITH l AS (SELECT doc_id, 'WARN ' || {_CODE} || ' ' || line AS line FROM {LINES} WHERE doc_id % 5 <> 0), t(type, k) AS (VALUES {_TYPES}),"
    " c AS (SELECT doc_id, regexp_replace(coalesce(regexp_split_to_array(trim(line), '\\s+')[2], ''), '(\\.[0-9]+)+$', '') AS code FROM l),"
    " f AS (SELECT doc_id, type, k, regexp_extract(code, '^[^.]*(\\.[^.]*)?') AS signal, count(*) AS n FROM c JOIN t ON starts_with(code, type || '.') GROUP BY ALL),"
    " s AS (SELECT doc_id, type, k, type || '.count' AS signal, doc_id * (k + 1) % 70 AS n FROM documents, t WHERE doc_id NOT IN (SELECT doc_id FROM f) AND doc_id * (k + 1) % 70 > 0)"
    " SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k, n DESC, signal) AS place, signal, type, CASE WHEN n >= 50 THEN 'high' WHEN n >= 10 THEN 'medium' ELSE 'low' END AS frequency FROM (SELECT * FROM f UNION ALL SELECT * FROM s)",
)
def o12_signals(spark, d):
    """Reports of documents; every fifth has none and takes the counts of its log."""
    said = lines(spark, d).filter("doc_id % 5 <> 0").select("doc_id", F.concat(F.lit("WARN "), F.expr(_CODE), F.lit(" "), "line").alias("line"))
    each = F.array(*[F.struct(F.lit(x).alias("type"), (F.col("doc_id") * (k + 1) % 70).alias("n")) for k, x in enumerate(SIGNALS)])
    counts = table(spark, d, "documents").select("doc_id", F.inline(each))
    return report_signals(said, counts, "doc_id")
