"""Context of a translation batch: relevant terms, caption candidates, their budget, timestamps and summary, as queries.

The documents of a language are one project part, their spoken lines its dialogue units; sentences of ``benchmark`` are the
captions, and the first two words of a conversation are a term whose rendering is the first of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions import fixed
from scriptorium.functions import script as s
from scriptorium.functions import text as t
from scriptorium.operators import caption_match as m
from scriptorium.operators import phrases, runs, scans
from scriptorium.operators.stored import Stored
from scriptorium.plans import script
from scriptorium.sources.tables import LINES, lines, table

QUERIES, SQL = {}, {}
TENDENCIES = 10


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return register


def term_rows(spark, d):
    """``term, english, chinese``: one row for each distinct English side."""
    english = F.regexp_extract("text", "^\\p{L}+ \\p{L}+", 0)
    rows = table(spark, d, "conversations").filter("turn = 0").select("conv_id", english.alias("english")).filter("english <> ''")
    return rows.groupBy("english").agg(F.min("conv_id").alias("term")).select("term", "english", F.substring_index("english", " ", 1).alias("chinese"))


def _part():
    return F.coalesce("lang", F.lit(""))


def parts(spark, d):
    return table(spark, d, "documents").select("doc_id", _part().alias("part"))


def tendencies(spark, d):
    """``part, word``: the most frequent terms of a part, ties in order of the words."""
    plain = F.replace("text", F.lit("’"), F.lit("'"))  # once a text, not once a word
    words = table(spark, d, "documents").select(_part().alias("part"), F.explode(F.regexp_extract_all(plain, F.lit("[A-Za-z][A-Za-z'-]{2,}"), F.lit(0))).alias("word"))
    words = words.groupBy("part", "word").agg(F.count("*").alias("n")).select("part", F.lower("word").alias("word"), "n").filter(~F.col("word").isin(*fixed.MATCH_STOP_WORDS))
    place = Window.partitionBy("part").orderBy(F.desc("n"), "word")
    return words.groupBy("part", "word").agg(F.sum("n").alias("n")).withColumn("k", F.row_number().over(place)).filter(F.col("k") <= TENDENCIES).select("part", "word")


def shared_words(spark, d, frequent=None):
    """``part, term, word``: words of three characters and more that a term shares with the tendencies of a part."""
    words = F.regexp_extract_all("english", F.lit("[A-Za-z][A-Za-z'’-]*"), F.lit(0))
    words = F.array_distinct(F.transform(F.filter(words, lambda w: F.length(w) >= 3), lambda w: t.plain_lower(w)))
    return term_rows(spark, d).select("term", F.explode(words).alias("word")).join(tendencies(spark, d) if frequent is None else frequent, "word").select("part", "term", "word")


def terms_in(texts: DataFrame, key: str, terms: DataFrame) -> DataFrame:
    """``key, term``: terms that stand in a text of the key, the English side in any case, the rendering as it is; keys are few."""
    plain = terms.select("term", t.plain_lower(F.col("english")).alias("phrase"))
    named = phrases.phrase_hits(texts, key, "text", plain, "phrase", False, few_keys=True).distinct().join(plain, "phrase").select(key, "term")
    rendered = phrases.phrase_hits(texts, key, "text", terms, "chinese", False, False, few_keys=True).distinct()
    return named.unionAll(rendered.join(terms.select("term", F.col("chinese").alias("phrase")), "phrase").select(key, "term"))


def first_terms_in(docs: DataFrame, terms: DataFrame, shared: DataFrame, n: int) -> DataFrame:
    """``doc_id, terms``: the n first terms of each of ``doc_id, part, text`` that stand in its text, or are ``shared`` by its part.

    Each source gives its own n first at most (a document's leave the task that read it), so no document meets all terms.
    """
    texts = docs.select("doc_id", "text")
    plain = terms.select("term", t.plain_lower(F.col("english")).alias("phrase"))
    named = phrases.least_values(texts, "doc_id", "text", plain, "phrase", "term", n)
    rendered = phrases.least_values(texts, "doc_id", "text", terms, "chinese", "term", n, False)
    by_part = runs.first_rows(shared, ["part"], ["term"], n).groupBy("part").agg(F.collect_list(F.col("term").cast("long")).alias("values"))
    of_part = docs.select("doc_id", "part").join(Stored(by_part).side(), "part").select("doc_id", "values")
    found = named.unionAll(rendered).unionAll(of_part).groupBy("doc_id").agg(F.flatten(F.collect_list("values")).alias("values"))
    return found.select("doc_id", F.slice(F.array_sort(F.array_distinct("values")), 1, n).alias("terms"))


def relevant_terms(spark, d):
    """``part, term, english, chinese``: terms that stand in a text of the part, in either language, or share a word with its tendencies."""
    terms = Stored(term_rows(spark, d)).df
    texts = table(spark, d, "documents").select(_part().alias("part"), "text")
    found = terms_in(texts, "part", terms).unionAll(shared_words(spark, d).select("part", "term")).distinct()
    return found.join(terms, "term").select("part", "term", "english", "chinese")


def capped_terms(spark, d):
    return runs.first_rows(relevant_terms(spark, d), ["part"], ["term"], m.RELEVANT, "k").drop("k")


def entries(spark, d):
    return script.dialogues(spark, d).select("doc_id", F.col("line_no").alias("at"), F.format_string("p%03d-e%03d", "doc_id", F.col("line_no") + 1).alias("id"), F.expr("line_no div 10 + 1").alias("page"), "kind", "x", F.col("line").alias("text"))


def units(spark, d, rows=None):
    found = m.dialogue_units(entries(spark, d) if rows is None else rows, ["doc_id"]).withColumn("unit_id", F.col("entry_ids")[0])
    return found.join(parts(spark, d), "doc_id")


def events(spark, d):
    """``event, start, end, text``: caption events, one for each sentence."""
    rows = table(spark, d, "benchmark").select("item_id", F.posexplode(F.regexp_extract_all("text", F.lit("[^.\\n]+"), F.lit(0))).alias("place", "text"))
    event = F.col("item_id") * 1000 + F.col("place")
    return rows.select(event.alias("event"), (event * 2.5).alias("start"), (event * 2.5 + F.length("text") / 20).alias("end"), "text")


def pairs(spark, d, found=None):
    found = units(spark, d) if found is None else found
    return m.scored_pairs(found.select("part", "unit_id", "source"), events(spark, d), capped_terms(spark, d), ["part"])


def matched(spark, d):
    """Units, those emitted, and the best candidates, each computed once."""
    found = Stored(units(spark, d)).df
    best = Stored(m.candidates(pairs(spark, d, found))).df
    return found, m.emitted(found, best, ["part"], ["doc_id", "unit"]), best


_WORDS = "list_distinct(list_filter(list_transform(regexp_extract_all({c}, '[A-Za-z][A-Za-z''’-]*'), lambda w: lower(replace(w, '’', ''''))), lambda w: length(w) >= 3 AND w NOT IN " + fixed.sql_list(fixed.MATCH_STOP_WORDS) + "))"
_PLAIN = "lower(replace(replace(english, '’', ''''), '‘', ''''))"
_TERMS = """terms AS (
  SELECT min(conv_id) AS term, english, string_split(english, ' ')[1] AS chinese
  FROM (SELECT conv_id, regexp_extract(text, '^\\p{L}+ \\p{L}+', 0) AS english FROM conversations WHERE turn = 0) WHERE english <> '' GROUP BY english
)"""
_TENDENCIES = f"""tendencies AS (
  SELECT part, word FROM (
    SELECT part, word, row_number() OVER (PARTITION BY part ORDER BY count(*) DESC, word) AS k
    FROM (SELECT coalesce(lang, '') AS part, unnest(list_filter(list_transform(regexp_extract_all(text, '[A-Za-z][A-Za-z''’-]*'), lambda w: lower(replace(w, '’', ''''))), lambda w: length(w) >= 3 AND w NOT IN {fixed.sql_list(fixed.MATCH_STOP_WORDS)})) AS word FROM documents)
    GROUP BY part, word
  ) WHERE k <= {TENDENCIES}
),
shared AS (
  SELECT DISTINCT part, term, word FROM tendencies JOIN (SELECT term, unnest(list_transform(list_filter(regexp_extract_all(english, '[A-Za-z][A-Za-z''’-]*'), lambda w: length(w) >= 3), lambda w: lower(replace(w, '’', '''')))) AS word FROM terms) USING (word)
)"""
_RELEVANT = f"""{_TERMS},
{_TENDENCIES},
relevant AS (
  SELECT part, term, english, chinese FROM (
    SELECT DISTINCT coalesce(lang, '') AS part, term FROM documents, terms WHERE contains(lower(text), {_PLAIN}) OR contains(text, chinese)
    UNION SELECT part, term FROM shared
  ) JOIN terms USING (term)
),
capped AS (SELECT part, term, english, chinese FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY term) AS k FROM relevant) WHERE k <= {m.RELEVANT})"""
_UNITS = f"""entries AS (SELECT doc_id, line_no, kind, trim(line) AS body FROM {script.DIALOGUE}),
led AS (
  SELECT *, last_value(CASE WHEN kind = 'character' THEN body WHEN kind IN ('scene_heading', 'transition', 'format_marker', 'page_heading') THEN '' END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS speaker,
         lag(kind) OVER (PARTITION BY doc_id ORDER BY line_no) AS before
  FROM entries
),
spoken AS (SELECT *, kind = 'dialogue' OR (kind IN ('parenthetical', 'action') AND coalesce(speaker, '') <> '' AND coalesce(before IN ('character', 'parenthetical'), false) AND body <> '') AS spoken FROM led),
numbered AS (SELECT *, sum(CASE WHEN spoken THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS run FROM spoken),
units AS (
  SELECT u.doc_id, coalesce(d.lang, '') AS part, u.unit, printf('p%03d-e%03d', u.doc_id, u.unit + 1) AS unit_id, nullif(u.speaker, '') AS speaker, u.n_entries, u.body AS source
  FROM (SELECT doc_id, min(line_no) AS unit, min(speaker) AS speaker, count(*) AS n_entries, string_agg(body, ' ' ORDER BY line_no) AS body FROM numbered WHERE spoken AND body <> '' GROUP BY doc_id, run) u JOIN documents d ON d.doc_id = u.doc_id
)"""
_PAIRS = f"""{_RELEVANT},
{_UNITS},
named AS (SELECT unit_id, list(chinese) AS named FROM units JOIN capped ON capped.part = units.part AND contains(lower(units.source), {_PLAIN}) GROUP BY unit_id),
u AS (
  SELECT units.*, {_WORDS.format(c="source")} AS words, regexp_replace(lower(source), '[^a-z0-9]', '', 'g') AS flat, coalesce(named, CAST([] AS VARCHAR[])) AS named
  FROM units LEFT JOIN named ON named.unit_id = units.unit_id WHERE regexp_matches(lower(source), '[a-z0-9\\x{{3400}}-\\x{{9fff}}]')
),
e AS (
  SELECT event, event * 2.5e0 AS start, event * 2.5e0 + length(raw) / 20 AS stop, trim(regexp_replace(raw, '\\s+', ' ', 'g')) AS text
  FROM (SELECT item_id * 1000 + unnest(range(len(regexp_extract_all(text, '[^.\\n]+')))) AS event, unnest(regexp_extract_all(text, '[^.\\n]+')) AS raw FROM benchmark)
),
ew AS (SELECT *, {_WORDS.format(c="text")} AS words, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS flat FROM e WHERE text <> ''),
met AS (
  SELECT u.part, u.doc_id, u.unit, u.unit_id, ew.event, ew.start, ew.stop, ew.text, u.flat AS uf, ew.flat AS ef, len(u.words) AS n, least(len(u.words), len(ew.words)) AS least_n,
         len(list_intersect(u.words, ew.words)) AS shared, len(list_filter(u.named, lambda x: contains(ew.text, x))) AS terms
  FROM u, ew
),
pairs AS (
  SELECT * FROM (SELECT *, CASE
    WHEN length(uf) >= 16 AND contains(ef, uf) THEN 1e0
    WHEN least_n = 0 THEN CASE WHEN terms > 0 THEN 0.72e0 ELSE 0e0 END
    WHEN shared < CASE WHEN n <= 4 THEN 2 ELSE 3 END THEN CASE WHEN terms > 0 AND shared > 0 THEN 0.72e0 ELSE 0e0 END
    WHEN n <= 4 AND shared < n THEN 0e0
    ELSE greatest(shared / least_n, CASE WHEN shared >= 3 THEN 0.65e0 ELSE 0e0 END, CASE WHEN terms > 0 THEN 0.72e0 + least(terms, 3) * 0.05e0 ELSE 0e0 END) END AS score FROM met) WHERE score >= 0.6e0
),
best AS (SELECT *, rank AS rank_no FROM (SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY score DESC, start, stop, text, event) AS rank FROM pairs) WHERE rank <= 2),
sent AS (
  SELECT * FROM (
    SELECT part, doc_id, unit, unit_id, n_candidates, coalesce(sum(n_candidates) OVER (PARTITION BY part ORDER BY doc_id, unit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent
    FROM (SELECT units.part, units.doc_id, units.unit, units.unit_id, coalesce(c.n, 0) AS n_candidates FROM units LEFT JOIN (SELECT unit_id, count(*) AS n FROM best GROUP BY unit_id) c ON c.unit_id = units.unit_id)
  ) WHERE spent < 60
),
firsts AS (SELECT sent.part, sent.unit_id, best.event, best.start, best.stop, sent.n_candidates = 1 AND best.score >= 0.7e0 AS alone FROM sent JOIN best ON best.unit_id = sent.unit_id AND best.rank_no = 1),
stamps AS (SELECT part, unit_id, event, start, stop, CASE WHEN alone AND count(*) FILTER (alone) OVER (PARTITION BY part, event) = 1 THEN 'high' ELSE 'low' END AS confidence FROM firsts)"""


@query("J06_relevant_terms", f"WITH {_RELEVANT} SELECT part, term, english FROM relevant")
def j06(spark, d):
    return relevant_terms(spark, d).select("part", "term", "english")


@query("P28_capped_terms", f"WITH {_RELEVANT} SELECT part, term, chinese FROM capped")
def p28(spark, d):
    return capped_terms(spark, d).select("part", "term", "chinese")


@query("U07_token_intersection", f"WITH {_TERMS}, {_TENDENCIES} SELECT part, term, count(*) AS n_shared FROM shared GROUP BY part, term")
def u07(spark, d):
    return shared_words(spark, d).groupBy("part", "term").agg(F.count("*").alias("n_shared"))


@query("W05_dialogue_units", f"WITH {_UNITS} SELECT part, doc_id, unit_id, speaker, n_entries, source FROM units")
def w05(spark, d):
    return units(spark, d).select("part", "doc_id", "unit_id", "speaker", F.col("n_entries").cast("long"), "source")


@query("J08_scorer", f"WITH {_PAIRS} SELECT unit_id, event, score FROM pairs")
def j08(spark, d):
    return pairs(spark, d).select("unit_id", "event", "score")


@query("J07_fuzzy_top2", f"WITH {_PAIRS} SELECT unit_id, rank, event, round_even(score, 3) AS score, CASE WHEN score >= 0.7e0 THEN 'high' ELSE 'low' END AS match_confidence FROM best")
def j07(spark, d):
    best = m.candidates(pairs(spark, d))
    return best.select("unit_id", F.col("rank").cast("long"), "event", F.bround("score", 3).alias("score"), F.when(F.col("score") >= m.HIGH, "high").otherwise("low").alias("match_confidence"))


@query("W06_running_limit", f"WITH {_PAIRS} SELECT part, unit_id, n_candidates FROM sent")
def w06(spark, d):
    _, sent, _ = matched(spark, d)
    return sent.select("part", "unit_id", "n_candidates")


@query("J10_claimed_timestamps", f"WITH {_PAIRS} SELECT part, unit_id, event, start, stop, confidence FROM stamps")
def j10(spark, d):
    _, sent, best = matched(spark, d)
    return m.timestamps(sent, best, ["part"]).withColumnRenamed("end", "stop")


@query(
    "G30_match_summary",
    f"WITH {_PAIRS} SELECT part, count(*) AS n_units, (SELECT count(*) FROM sent s WHERE s.part = units.part) AS n_included, (SELECT CAST(sum(n_candidates) AS BIGINT) FROM sent s WHERE s.part = units.part) AS n_candidates, (SELECT count(*) FROM stamps s WHERE s.part = units.part AND confidence = 'high') AS n_unique, (SELECT count(*) FROM stamps s WHERE s.part = units.part) AS n_timestamps FROM units GROUP BY part",
)
def g30(spark, d):
    found, sent, best = matched(spark, d)
    sent = Stored(sent).df
    return m.summary(found, sent, m.timestamps(sent, best, ["part"]), ["part"])


_ENTRIES = f"(SELECT doc_id, line_no, line AS source, coalesce(lead(line) OVER (PARTITION BY doc_id ORDER BY line_no), '') AS translation FROM {LINES})"


def terminology_findings(entries, terms, key: str):
    """``key, english, chinese``: terms that stand in the source as whole words, in any case, and whose rendering the translation lacks."""
    found = phrases.phrase_hits(entries, key, "source", terms, "english", True)
    known = terms.select("english", "chinese", F.lower("english").alias("phrase"))
    return found.join(known, "phrase").join(entries.select(key, "translation"), key).filter(~F.coalesce(F.col("translation"), F.lit("")).contains(F.col("chinese"))).select(key, "english", "chinese")


@query(
    "J13_missing_counterpart",
    f"WITH {_TERMS}, met AS MATERIALIZED (SELECT doc_id, line_no, lower(source) AS source, translation, english, chinese FROM (SELECT * FROM {_ENTRIES} WHERE line_no % 2 = 0) e, terms WHERE contains(lower(source), lower(english)) AND NOT contains(translation, chinese))"
    " SELECT 'batch.terminology_inconsistency' AS code, printf('p%03d-e%03d', doc_id, line_no + 1) AS entry_id, english AS term, chinese AS expected FROM met WHERE regexp_matches(source, '(^|[^\\p{L}\\p{N}_])' || lower(english) || '($|[^\\p{L}\\p{N}_])')",
)
def j13(spark, d):
    """Every other line is an entry whose translation is the line behind it; there is no join but on equal keys."""
    pages = lines(spark, d).withColumn("entry", F.expr("line_no div 2"))
    body = lambda k: F.max(F.when(F.col("line_no") % 2 == k, F.col("line")))
    rows = pages.groupBy("doc_id", "entry").agg(body(0).alias("source"), F.coalesce(body(1), F.lit("")).alias("translation"))
    rows = rows.withColumn("entry_id", F.format_string("p%03d-e%03d", "doc_id", F.col("entry") * 2 + 1))
    found = terminology_findings(Stored(rows).df, Stored(term_rows(spark, d)).df, "entry_id")
    return found.select(F.lit("batch.terminology_inconsistency").alias("code"), "entry_id", F.col("english").alias("term"), F.col("chinese").alias("expected"))


# Most rows, signals, terms of style and entries of the batch before in a package.
ROWS, SIGNALS, STYLE_TERMS, TAIL = 160, 40, 20, 8
SECTIONS = ("rows", "markers", "signals", "terms", "style", "matches", "tail")


def packages(keys: DataFrame, key: str, sections: dict[str, DataFrame]) -> DataFrame:
    """One package for each key: every section as an ordered list of texts.

    Sections are ``key, place, item``, each cut by its cap before, so what meets a key in the one shuffle here is bounded.
    """
    rows = keys.select(key, F.lit(None).cast("string").alias("section"), F.lit(0).cast("long").alias("place"), F.lit(None).cast("string").alias("item"))
    for name, part in sections.items():
        rows = rows.unionAll(part.select(key, F.lit(name), F.col("place").cast("long"), "item"))
    listed = lambda name: F.transform(F.array_sort(F.collect_list(F.when(F.col("section") == name, F.struct("place", "item")))), lambda x: x["item"])
    return rows.groupBy(key).agg(*[listed(name).alias(name) for name in sections])


def context_packages(spark, d) -> DataFrame:
    """A package for each document: its first rows, their markers and signals, terms, style, caption candidates, and the tail of the document before it."""
    docs = table(spark, d, "documents").select("doc_id", _part().alias("part"), "text")
    rows = Stored(entries(spark, d)).df
    first = rows.filter(F.col("at") < ROWS)
    route = s.signal_route(F.col("text"), F.col("x"))
    routed = Stored(first.select("doc_id", "at", "id", "text", route.alias("route")).filter("route is not null")).df
    signals = runs.first_rows(routed.filter("route <> 'marker'"), ["doc_id"], ["at"], SIGNALS)
    spoken = Stored(units(spark, d, rows)).df
    terms = Stored(term_rows(spark, d))
    frequent = Stored(tendencies(spark, d)).df
    found = first_terms_in(docs, terms.df, shared_words(spark, d, frequent).select("part", "term").distinct(), m.RELEVANT)
    found = Stored(found.select("doc_id", F.explode("terms").alias("term")).join(terms.side(), "term")).df
    best = Stored(m.candidates(m.scored_pairs(spoken.select("doc_id", "unit_id", "source"), events(spark, d), found.select("doc_id", "english", "chinese"), ["doc_id"]))).df
    sent = m.emitted(spoken.select("doc_id", "unit", "unit_id"), best, ["doc_id"], ["unit"]).filter("n_candidates > 0")
    style = frequent.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy("word"))).filter(F.col("place") <= STYLE_TERMS)
    last = runs.first_rows(rows.select("doc_id", "at", "id", "kind"), ["doc_id"], [F.desc("at")], TAIL).select(F.col("doc_id").alias("previous"), "at", F.concat_ws(":", "id", "kind").alias("item"))
    before = scans.lagged(docs.select("doc_id", "part"), ["part"], ["doc_id"], F.col("doc_id"), "previous")
    return packages(docs, "doc_id", {
        "rows": first.select("doc_id", F.col("at").alias("place"), F.concat_ws(":", "id", "kind").alias("item")),
        "markers": routed.filter("route = 'marker'").select("doc_id", F.col("at").alias("place"), F.concat_ws(":", "id", F.upper(t.collapse_space(F.col("text")))).alias("item")),
        "signals": signals.select("doc_id", F.col("at").alias("place"), F.concat_ws(":", "id", "route").alias("item")),
        "terms": found.select("doc_id", F.col("term").alias("place"), F.concat_ws("=", "english", "chinese").alias("item")),
        "style": docs.select("doc_id", "part").join(style, "part").select("doc_id", "place", F.col("word").alias("item")),
        "matches": sent.join(best, "unit_id").select("doc_id", (F.col("unit") * 10 + F.col("rank")).alias("place"), F.concat(F.col("unit_id"), F.lit(">"), F.col("event").cast("string")).alias("item")),
        "tail": before.join(last, "previous").select("doc_id", F.col("at").alias("place"), "item"),
    })


_DOC_PAIRS = (
    _PAIRS.replace(_RELEVANT, f"""{_TERMS},
{_TENDENCIES},
capped AS (
  SELECT doc_id, term, english, chinese FROM (
    SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY term) AS k FROM (
      SELECT doc_id, term FROM documents, terms WHERE contains(lower(text), {_PLAIN}) OR contains(text, chinese)
      UNION SELECT doc_id, term FROM shared JOIN documents ON coalesce(lang, '') = part
    )
  ) JOIN terms USING (term) WHERE k <= {m.RELEVANT}
)""")
    .replace("JOIN capped ON capped.part = units.part", "JOIN capped ON capped.doc_id = units.doc_id")
    .replace("PARTITION BY part ORDER BY doc_id, unit ROWS", "PARTITION BY doc_id ORDER BY unit ROWS")
)
_ROUTE = script.ROUTE
_SECTIONS_SQL = f"""
rows_cte AS (SELECT doc_id, string_agg(printf('p%03d-e%03d', doc_id, line_no + 1) || ':' || kind, ',' ORDER BY line_no) AS rows FROM entries WHERE line_no < {ROWS} GROUP BY doc_id),
routed AS (SELECT doc_id, line_no, {script.LABEL} AS label, {_ROUTE} AS route FROM {script.PLACED} WHERE line_no < {ROWS}),
markers_cte AS (SELECT doc_id, string_agg(printf('p%03d-e%03d', doc_id, line_no + 1) || ':' || label, ',' ORDER BY line_no) AS markers FROM routed WHERE route = 'marker' GROUP BY doc_id),
signals_cte AS (SELECT doc_id, string_agg(printf('p%03d-e%03d', doc_id, line_no + 1) || ':' || route, ',' ORDER BY line_no) AS signals FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS k FROM routed WHERE route <> 'marker') WHERE k <= {SIGNALS} GROUP BY doc_id),
terms_cte AS (SELECT doc_id, string_agg(english || '=' || chinese, ',' ORDER BY term) AS terms FROM capped GROUP BY doc_id),
style_cte AS (SELECT part, string_agg(word, ',' ORDER BY word) AS style FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY word) AS k FROM tendencies) WHERE k <= {STYLE_TERMS} GROUP BY part),
matches_cte AS (SELECT sent.doc_id, string_agg(sent.unit_id || '>' || event, ',' ORDER BY sent.unit, rank_no) AS matches FROM sent JOIN best ON best.unit_id = sent.unit_id GROUP BY sent.doc_id),
tail_cte AS (SELECT doc_id, string_agg(printf('p%03d-e%03d', doc_id, line_no + 1) || ':' || kind, ',' ORDER BY line_no) AS tail FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no DESC) AS k FROM entries) WHERE k <= {TAIL} GROUP BY doc_id),
before_cte AS (SELECT doc_id, coalesce(lang, '') AS part, lag(doc_id) OVER (PARTITION BY coalesce(lang, '') ORDER BY doc_id) AS previous FROM documents)"""


@query(
    "O01_context_package",
    f"WITH {_DOC_PAIRS},{_SECTIONS_SQL} SELECT b.doc_id, coalesce(rows, '') AS rows, coalesce(markers, '') AS markers, coalesce(signals, '') AS signals, coalesce(terms, '') AS terms, coalesce(style, '') AS style, coalesce(matches, '') AS matches, coalesce(tail, '') AS tail"
    " FROM before_cte b LEFT JOIN rows_cte r ON r.doc_id = b.doc_id LEFT JOIN markers_cte m ON m.doc_id = b.doc_id LEFT JOIN signals_cte g ON g.doc_id = b.doc_id LEFT JOIN terms_cte t ON t.doc_id = b.doc_id LEFT JOIN style_cte y ON y.part = b.part LEFT JOIN matches_cte x ON x.doc_id = b.doc_id LEFT JOIN tail_cte l ON l.doc_id = b.previous",
)
def o01(spark, d):
    return context_packages(spark, d).select("doc_id", *[F.array_join(c, ",").alias(c) for c in SECTIONS])


def with_tokens(reports: DataFrame, key: str, text: str, tokens: DataFrame, token: str) -> DataFrame:
    """``key, found``: whether any of the tokens, as they are written, stands in a report; a key's reports count together."""
    met = phrases.phrase_hits(reports, key, text, tokens, token, False, False).select(key).distinct().withColumn("found", F.lit(True))
    return reports.select(key).distinct().join(met, key, "left").select(key, F.coalesce("found", F.lit(False)).alias("found"))


@query("O15_report_token", f"WITH {_TERMS} SELECT doc_id, EXISTS (SELECT 1 FROM terms WHERE contains(text, english)) AS found FROM documents")
def o15(spark, d):
    return with_tokens(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text", term_rows(spark, d), "english")
