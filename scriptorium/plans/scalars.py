"""Projections, predicates and scalar functions as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import fixed
from scriptorium.functions import text as t
from scriptorium.sources.tables import LINES, lines, table

QUERIES, SQL = {}, {}


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return register


@query("F01_collapse_space", f"SELECT doc_id, line_no, trim(regexp_replace(line, '\\s+', ' ', 'g')) AS value FROM {LINES}")
def f01(spark, d):
    return lines(spark, d).select("doc_id", "line_no", t.collapse_space(F.col("line")).alias("value"))


@query("F02_drop_space", f"SELECT doc_id, line_no, regexp_replace(line, '\\s+', '', 'g') AS value FROM {LINES}")
def f02(spark, d):
    return lines(spark, d).select("doc_id", "line_no", t.drop_space(F.col("line")).alias("value"))


@query("F04_clean_caption", "SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '\\\\[Nn]', ' ', 'g'), '\\{[^}]*\\}|<[^>]*>', '', 'g'), '\\s+', ' ', 'g')) AS value FROM pages")
def f04(spark, d):
    return table(spark, d, "pages").select("page_id", t.clean_caption(F.col("html")).alias("value"))


@query("F05_parse_timecode", "SELECT event_id, CAST(extract('hour' FROM ts) * 3600 + extract('minute' FROM ts) * 60 + extract('second' FROM ts) AS DOUBLE) AS seconds FROM events")
def f05(spark, d):
    return table(spark, d, "events").select("event_id", t.parse_timecode(F.date_format("ts", "HH:mm:ss")).alias("seconds"))


@query(
    "F06_format_timecode",
    "SELECT event_id, CASE WHEN value IS NULL OR value < 0 THEN '' WHEN s >= 3600 THEN printf('%02d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) ELSE printf('%02d:%02d', s // 60, s % 60) END AS timecode FROM (SELECT event_id, value, CAST(floor(value * 25) AS BIGINT) AS s FROM events)",
)
def f06(spark, d):
    return table(spark, d, "events").select("event_id", t.format_timecode(F.col("value") * 25).alias("timecode"))


@query("F07_event_duration", "SELECT event_id, greatest(0.0, coalesce(lead(epoch(ts)) OVER w - epoch(ts), 0.0)) AS duration FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def f07(spark, d):
    from scriptorium.operators.runs import ordered

    at = t.seconds(F.col("ts"))
    return table(spark, d, "events").select("event_id", F.greatest(F.lit(0.0), F.coalesce(F.lead(at).over(ordered(["user_id"], ["ts", "event_id"])) - at, F.lit(0.0))).alias("duration"))


@query("F08_match_key", f"SELECT doc_id, line_no, trim(regexp_replace(lower(replace(replace(line, '’', ''''), '‘', '''')), '[^a-z0-9\\x{{3400}}-\\x{{9fff}}]+', ' ', 'g')) AS value FROM {LINES}")
def f08(spark, d):
    return lines(spark, d).select("doc_id", "line_no", t.match_key(F.col("line")).alias("value"))


@query("F09_compact_key", f"SELECT doc_id, line_no, regexp_replace(lower(line), '[^a-z0-9]', '', 'g') AS value FROM {LINES}")
def f09(spark, d):
    return lines(spark, d).select("doc_id", "line_no", t.compact_key(F.col("line")).alias("value"))


@query("F11_tokenize", "SELECT doc_id, CAST(len(regexp_extract_all(text, '[A-Za-z][A-Za-z''-]*')) AS INTEGER) AS n_words, array_to_string(regexp_extract_all(text, '[A-Za-z][A-Za-z''-]*'), ' ') AS words FROM documents")
def f11(spark, d):
    words = t.latin_words(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.size(words).alias("n_words"), F.array_join(words, " ").alias("words"))


@query("F12_term_set", f"SELECT conv_id, turn, array_to_string(list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(text, '[A-Za-z][A-Za-z''’-]*'), lambda w: lower(replace(w, '’', ''''))), lambda w: length(w) >= 3 AND w NOT IN {fixed.sql_list(fixed.MATCH_STOP_WORDS)}))), ' ') AS terms FROM conversations")
def f12(spark, d):
    words = F.transform(F.regexp_extract_all("text", F.lit("[A-Za-z][A-Za-z'’-]*"), F.lit(0)), lambda w: F.lower(F.translate(w, "’", "'")))
    kept = F.array_distinct(F.filter(words, lambda w: (F.length(w) >= 3) & ~w.isin(*fixed.MATCH_STOP_WORDS)))
    return table(spark, d, "conversations").select("conv_id", "turn", F.array_join(F.array_sort(kept), " ").alias("terms"))


@query("F14_canonical_label", "SELECT p_partkey, upper(regexp_replace(p_type, '[\\s._/-]', '', 'g')) AS label FROM part")
def f14(spark, d):
    return table(spark, d, "part").select("p_partkey", t.canonical_label(F.col("p_type")).alias("label"))


@query("F15_bucket", "SELECT event_id, round_even(value / 3, 0) * 3 AS bucket FROM events")
def f15(spark, d):
    return table(spark, d, "events").select("event_id", t.bucket(F.col("value"), 3).alias("bucket"))


@query("F17_token_proxy", "SELECT doc_id, greatest(1, CAST(round_even(strlen(text) / 4, 0) AS BIGINT)) AS n_tokens FROM documents")
def f17(spark, d):
    return table(spark, d, "documents").select("doc_id", t.token_proxy(F.octet_length("text")).alias("n_tokens"))


@query("F19_strip_tags", "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS value FROM pages")
def f19(spark, d):
    return table(spark, d, "pages").select("page_id", t.strip_tags(F.col("html")).alias("value"))


@query("F20_attributes", "SELECT page_id, array_to_string(regexp_extract_all(html, '\\bhref=\"([^\"]*)\"', 1), ' ') AS hrefs FROM pages")
def f20(spark, d):
    return table(spark, d, "pages").select("page_id", F.array_join(t.attributes(F.col("html"), "href"), " ").alias("hrefs"))


@query("F21_escape_html", "SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS value FROM pages")
def f21(spark, d):
    return table(spark, d, "pages").select("page_id", t.escape_html(F.col("html")).alias("value"))


@query("F22_inline_markup", "SELECT p_partkey, '<strong class=\"emphasis\">' || p_name || '</strong> <em class=\"term\">' || p_brand || '</em> <span class=\"reader-annotation\">' || p_type || '</span>' AS value FROM part")
def f22(spark, d):
    return table(spark, d, "part").select("p_partkey", t.inline_markup(F.concat(F.lit("**"), "p_name", F.lit("** *"), "p_brand", F.lit("* [["), "p_type", F.lit("]]"))).alias("value"))


@query("F24_parenthesis_balance", "SELECT page_id, CAST(len(html) - len(replace(html, '(', '')) + len(html) - len(replace(html, '（', '')) - len(html) + len(replace(html, ')', '')) - len(html) + len(replace(html, '）', '')) AS INTEGER) AS balance FROM pages")
def f24(spark, d):
    return table(spark, d, "pages").select("page_id", t.parenthesis_balance(F.col("html")).cast("int").alias("balance"))


@query("F25_padded_id", "SELECT conv_id, turn, printf('p%03d-e%03d', conv_id, turn) AS id FROM conversations")
def f25(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", F.format_string("p%03d-e%03d", "conv_id", "turn").alias("id"))


@query("F26_slug", "SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'item') AS slug FROM pages")
def f26(spark, d):
    return table(spark, d, "pages").select("page_id", t.slug(F.col("url")).alias("slug"))


@query("F30_page_number", f"SELECT doc_id, line_no, CASE WHEN regexp_full_match(line, '\\d{{1,9}}\\.?') THEN CAST(regexp_extract(line, '^(\\d+)', 1) AS INTEGER) END AS page FROM {LINES}")
def f30(spark, d):
    return lines(spark, d).select("doc_id", "line_no", t.page_number(F.col("line")).alias("page"))


@query("F37_digest", "SELECT doc_id, sha256(text) AS digest FROM documents")
def f37(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))


@query("P02_page_range", "SELECT doc_id, source FROM documents WHERE doc_id BETWEEN 100 AND 400")
def p02(spark, d):
    return table(spark, d, "documents").filter(F.col("doc_id").between(100, 400)).select("doc_id", "source")


@query("P12_upperish", f"SELECT doc_id, line_no FROM {LINES} WHERE length(regexp_replace(line, '[^A-Za-z]', '', 'g')) > 0 AND length(regexp_replace(line, '[^A-Z]', '', 'g')) / length(regexp_replace(line, '[^A-Za-z]', '', 'g')) > 0.8")
def p12(spark, d):
    return lines(spark, d).filter(t.upper_share(F.col("line")) > 0.8).select("doc_id", "line_no")


@query("P15_line_kind", "SELECT doc_id, CASE WHEN regexp_matches(text, '[\\x{4e00}-\\x{9fff}]') AND regexp_matches(text, '[A-Za-z]') THEN 'mixed' WHEN regexp_matches(text, '[\\x{4e00}-\\x{9fff}]') THEN 'cjk' WHEN regexp_matches(text, '[A-Za-z]') THEN 'latin' ELSE 'none' END AS kind FROM documents")
def p15(spark, d):
    cjk, latin = F.col("text").rlike(f"[{t.CJK}]"), F.col("text").rlike("[A-Za-z]")
    return table(spark, d, "documents").select("doc_id", F.when(cjk & latin, "mixed").when(cjk, "cjk").when(latin, "latin").otherwise("none").alias("kind"))


@query("P32_level_state", "SELECT event_type, CASE event_type WHEN 'error' THEN 'FAIL' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END AS state, count(*) AS n FROM events GROUP BY ALL")
def p32(spark, d):
    state = F.when(F.col("event_type") == "error", "FAIL").when(F.col("event_type") == "signup", "WARN").otherwise("INFO")
    return table(spark, d, "events").groupBy("event_type", state.alias("state")).agg(F.count("*").alias("n"))


@query("P33_frequency", "SELECT user_id, count(*) AS n, CASE WHEN count(*) >= 50 THEN 'high' WHEN count(*) >= 10 THEN 'medium' ELSE 'low' END AS frequency FROM events GROUP BY user_id")
def p33(spark, d):
    n = F.count("*")
    return table(spark, d, "events").groupBy("user_id").agg(n.alias("n"), F.when(n >= 50, "high").when(n >= 10, "medium").otherwise("low").alias("frequency"))
