"""Tone, action style and tendencies of a project's texts, as queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import fixed
from scriptorium.operators import runs
from scriptorium.plans import script
from scriptorium.sources.tables import table

QUERIES, SQL = {}, {}
# Lead that decides a tone, lead or hits of medium confidence, terms in a profile, length of a concise caption.
LEAD, MEDIUM, TERMS, CONCISE = 2, 3, 10, 24
TOKEN = "[A-Za-z][A-Za-z'’-]*|[\\x{3400}-\\x{9fff}]{2,}"
CJK, LATIN = "[\\x{3400}-\\x{9fff}]", "[A-Za-z]"
ENDS = " -_.,!?;:()[]{}\"'“”‘’"
NOTES = {"chinese": ("[。，？！；]", "uses Chinese subtitle punctuation"), "mixed": (None, "blends Chinese and English"), "parenthetical": ("[（）()]", "includes parenthetical annotation style")}


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return register


def _hits(text: Column, markers: tuple[str, ...]) -> Column:
    """How many of the markers stand in a text, in any case, each once."""
    return sum((F.lower(text).contains(w.lower()).cast("long") for w in markers), F.lit(0).cast("long"))


def tone(lines: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``keys, n_lines, informal, formal, tone, tone_confidence``: a tone needs a lead of LEAD hits, and one of MEDIUM to be sure of it."""
    text = F.coalesce(F.col(column), F.lit(""))
    n = lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_lines"), F.sum(_hits(text, fixed.INFORMAL_MARKERS)).alias("informal"), F.sum(_hits(text, fixed.FORMAL_MARKERS)).alias("formal"))
    a, b = F.col("informal"), F.col("formal")
    value = F.when(a >= b + LEAD, "casual").when(b >= a + LEAD, "formal").otherwise("mixed")
    return n.select("*", value.alias("tone"), F.when(F.abs(a - b) >= MEDIUM, "medium").otherwise("low").alias("tone_confidence"))


def action_style(lines: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``keys, marked, action_style, action_confidence``: whether lines hold marks of a shooting script, and how many do."""
    upper = F.upper(F.coalesce(F.col(column), F.lit("")))
    hit = F.lit(False)
    for w in fixed.ACTION_MARKERS:
        hit = hit | upper.contains(w)
    n = lines.groupBy(*keys).agg(F.count_if(hit).alias("marked"))
    return n.select("*", F.when(F.col("marked") > 0, "literal").otherwise("interpretive").alias("action_style"), F.when(F.col("marked") >= MEDIUM, "medium").otherwise("low").alias("action_confidence"))


def tendencies(events: DataFrame, keys: list[str], column: str, most: int = TERMS) -> DataFrame:
    """``keys, terms``: the most frequent candidate terms as ``array<struct<term, n>>``; CJK runs, and words that are no stop words and not all lower case."""
    words = events.select(*keys, F.explode(F.transform(F.regexp_extract_all(column, F.lit(TOKEN), F.lit(0)), lambda w: F.btrim(w, F.lit(ENDS)))).alias("term"))
    word = F.col("term")
    kept = words.filter((F.length(word) >= 2) & (word.rlike(CJK) | (~F.lower(word).isin(*fixed.STYLE_STOP_WORDS) & (word != F.lower(word)))))
    counts = kept.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("n"))
    first = runs.first_rows(counts, keys, [F.desc("n"), "term"], most)
    return first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term", "n"))), lambda x: F.struct(x["term"].alias("term"), x["n"].alias("n"))).alias("terms"))


def caption_style(events: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``keys, n_events, average_length, chinese, mixed, parenthetical, notes``."""
    text = F.coalesce(F.col(column), F.lit(""))
    tests = {"chinese": text.rlike(NOTES["chinese"][0]), "mixed": text.rlike(CJK) & text.rlike(LATIN), "parenthetical": text.rlike(NOTES["parenthetical"][0])}
    n = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_events"), F.avg(F.length(text)).alias("average"), *[F.count_if(c).alias(k) for k, c in tests.items()])
    notes = F.concat_ws("; ", *[F.when(F.col(k) > 0, NOTES[k][1]) for k in tests], F.when(F.col("average") < CONCISE, "concise subtitle phrasing"))
    return n.select(*keys, "n_events", F.bround("average", 2).alias("average_length"), *tests, notes.alias("notes"))


def style_profiles(lines: DataFrame, events: DataFrame, key: str, line: str = "line", text: str = "text") -> DataFrame:
    """One profile per key with lines; the basis is the captions where there are any, else the source lines."""
    source = tone(lines, [key], line).join(action_style(lines, [key], line), key)
    captions = caption_style(events, [key], text).join(tendencies(events, [key], text), key, "left")
    basis = F.when(F.col("n_events").isNotNull(), "subtitles").otherwise("source_lines")
    return source.join(captions, key, "left").withColumn("style_basis", basis)


def _hits_sql(text: str, markers: tuple[str, ...]) -> str:
    return " + ".join("CAST(contains(lower({}), '{}') AS BIGINT)".format(text, w.lower().replace("'", "''")) for w in markers)


def _tone_sql(key: str, text: str, rows: str) -> str:
    sums = f"SELECT {key}, count(*) AS n_lines, CAST(sum({_hits_sql(text, fixed.INFORMAL_MARKERS)}) AS BIGINT) AS informal, CAST(sum({_hits_sql(text, fixed.FORMAL_MARKERS)}) AS BIGINT) AS formal FROM {rows} GROUP BY {key}"
    return f"SELECT *, CASE WHEN informal >= formal + 2 THEN 'casual' WHEN formal >= informal + 2 THEN 'formal' ELSE 'mixed' END AS tone, CASE WHEN abs(informal - formal) >= 3 THEN 'medium' ELSE 'low' END AS tone_confidence FROM ({sums})"


def _action_sql(key: str, text: str, rows: str) -> str:
    hit = " OR ".join(f"contains(upper({text}), '{w}')" for w in fixed.ACTION_MARKERS)
    return f"SELECT *, CASE WHEN marked > 0 THEN 'literal' ELSE 'interpretive' END AS action_style, CASE WHEN marked >= 3 THEN 'medium' ELSE 'low' END AS action_confidence FROM (SELECT {key}, count(*) FILTER ({hit}) AS marked FROM {rows} GROUP BY {key})"


@query("G12_tone", _tone_sql("role", "text", "conversations"))
def g12(spark, d):
    return tone(table(spark, d, "conversations"), ["role"], "text")


@query("G13_hit_lines", _action_sql("doc_id", "line", script.PLACED))
def g13(spark, d):
    return action_style(script.placed(spark, d), ["doc_id"], "line")


_SQL_TOKEN = TOKEN.replace("'", "''")
_SQL_ENDS = "'" + ENDS.replace("'", "''") + "'"
_TERMS = (
    f"t AS (SELECT conv_id, string_agg(term || '=' || n, ' ' ORDER BY n DESC, term) AS terms FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, term) AS k FROM (SELECT conv_id, term, count(*) AS n FROM (SELECT conv_id, trim(unnest(regexp_extract_all(text, '{_SQL_TOKEN}')), {_SQL_ENDS}) AS term FROM conversations)"
    f" WHERE length(term) >= 2 AND (regexp_matches(term, '{CJK}') OR (lower(term) NOT IN {fixed.sql_list(fixed.STYLE_STOP_WORDS)} AND term <> lower(term))) GROUP BY 1, 2)) WHERE k <= {TERMS} GROUP BY 1)"
)
_STYLE = (
    f"e AS (SELECT conv_id, count(*) AS n_events, avg(length(text)) AS average, count(*) FILTER (regexp_matches(text, '{NOTES['chinese'][0]}')) AS chinese, count(*) FILTER (regexp_matches(text, '{CJK}') AND regexp_matches(text, '{LATIN}')) AS mixed, count(*) FILTER (regexp_matches(text, '{NOTES['parenthetical'][0]}')) AS parenthetical FROM conversations GROUP BY conv_id)"
)


@query(
    "O16_style_profile",
    f"WITH {_TERMS}, {_STYLE}, a AS ({_tone_sql('doc_id', 'line', script.PLACED)}), b AS ({_action_sql('doc_id', 'line', script.PLACED)})"
    " SELECT a.doc_id, CASE WHEN e.conv_id IS NULL THEN 'source_lines' ELSE 'subtitles' END AS style_basis, n_lines, informal, formal, tone, tone_confidence, marked, action_style, action_confidence, coalesce(terms, '') AS terms, n_events, round_even(average, 2) AS average_length,"
    " coalesce(concat_ws('; ', CASE WHEN chinese > 0 THEN 'uses Chinese subtitle punctuation' END, CASE WHEN mixed > 0 THEN 'blends Chinese and English' END, CASE WHEN parenthetical > 0 THEN 'includes parenthetical annotation style' END, CASE WHEN average < 24 THEN 'concise subtitle phrasing' END), '') AS notes"
    " FROM a JOIN b ON b.doc_id = a.doc_id LEFT JOIN e ON e.conv_id = a.doc_id LEFT JOIN t ON t.conv_id = a.doc_id",
)
def o16(spark, d):
    """A project per document, with the conversation of the same id as its captions."""
    events = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), "text")
    listed = F.array_join(F.transform("terms", lambda x: F.concat(x["term"], F.lit("="), x["n"].cast("string"))), " ")
    out = style_profiles(script.placed(spark, d), events, "doc_id").withColumn("terms", F.coalesce(listed, F.lit("")))
    return out.select("doc_id", "style_basis", "n_lines", "informal", "formal", "tone", "tone_confidence", "marked", "action_style", "action_confidence", "terms", "n_events", "average_length", F.coalesce("notes", F.lit("")).alias("notes"))
