"""Text functions as column expressions; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptorium.functions import fixed

LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LATIN_WORD = "[A-Za-z][A-Za-z'-]*"
#: CJK characters that matching keeps.
MATCH_CJK = "\\x{3400}-\\x{9fff}"
CJK = "\\x{4e00}-\\x{9fff}"


def collapse_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "\\s+", " "))


def drop_space(c: Column) -> Column:
    return F.regexp_replace(c, "\\s+", "")


def clean_caption(c: Column) -> Column:
    """Caption text without override blocks, tags and hard line breaks."""
    c = F.regexp_replace(c, "\\\\[Nn]", " ")
    return collapse_space(F.regexp_replace(c, "\\{[^}]*\\}|<[^>]*>", ""))


def parse_timecode(c: Column) -> Column:
    """Seconds of the first H:MM:SS with optional fraction in a text; null without one."""
    pattern = "(\\d+):(\\d{1,2}):(\\d{1,2})(?:[.,:](\\d+))?"
    part = [F.regexp_extract(c, pattern, k) for k in range(1, 5)]
    fraction = F.when(part[3] != "", F.concat(F.lit("0."), part[3]).cast("double")).otherwise(0.0)
    whole = part[0].cast("long") * 3600 + part[1].cast("long") * 60 + part[2].cast("long")
    return F.when(part[0] != "", whole + fraction)


def format_timecode(c: Column) -> Column:
    """MM:SS, or HH:MM:SS from an hour on; empty for null or negative."""
    s = F.floor(c)
    short = F.format_string("%02d:%02d", F.floor(s / 60), s % 60)
    long = F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
    return F.when(c.isNull() | (c < 0), "").when(s >= 3600, long).otherwise(short)


def match_key(c: Column) -> Column:
    """Lower case, straight apostrophes, everything but letters, digits and CJK as one space."""
    return F.trim(F.regexp_replace(F.lower(F.translate(c, "’‘", "''")), f"[^a-z0-9{MATCH_CJK}]+", " "))


def has_match_key(c: Column) -> Column:
    """Whether ``match_key`` is not empty; reads no further than the first character it keeps."""
    return F.lower(c).rlike(f"[a-z0-9{MATCH_CJK}]")


def plain_lower(c: Column) -> Column:
    """Lower case with straight apostrophes."""
    return F.lower(F.translate(c, "’‘", "''"))


def compact_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")


def latin_words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(LATIN_WORD), F.lit(0))


def match_terms(c: Column) -> Column:
    """Distinct lower-case words that matching compares: three characters and more, straight apostrophes, no stop words."""
    # letters are folded once a text: a word holds ASCII letters alone, and those outside must not become such
    words = F.regexp_extract_all(F.translate(c, UPPER + "’", LOWER + "'"), F.lit("[a-z][a-z'-]{2,}"), F.lit(0))
    return F.array_except(words, F.array(*map(F.lit, fixed.MATCH_STOP_WORDS)))


def canonical_label(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, "[\\s._/-]", ""))


def bucket(c: Column, width: int) -> Column:
    """Nearest multiple of ``width``, halves to even."""
    return F.rint(c / width) * width


def token_proxy(n_bytes: Column) -> Column:
    return F.greatest(F.lit(1), F.rint(n_bytes / 4).cast("long"))


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", "")


def attributes(html: Column, name: str) -> Column:
    return F.regexp_extract_all(html, F.lit(f'\\b{name}="([^"]*)"'), F.lit(1))


def escape_html(c: Column) -> Column:
    for plain, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def parenthesis_balance(c: Column) -> Column:
    def count(x: str) -> Column:
        return F.length(c) - F.length(F.replace(c, F.lit(x), F.lit("")))

    return count("(") + count("（") - count(")") - count("）")


def slug(c: Column) -> Column:
    made = F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"))
    return F.coalesce(F.nullif(F.regexp_replace(made, "^-+|-+$", ""), F.lit("")), F.lit("item"))


def upper_share(c: Column) -> Column:
    """Upper-case share of the ASCII letters; null without one."""
    letters = F.length(F.regexp_replace(c, "[^A-Za-z]+", ""))
    return F.when(letters > 0, F.length(F.regexp_replace(c, "[^A-Z]+", "")) / letters)


def page_number(c: Column) -> Column:
    """The number a text is, with an optional final point; else null."""
    return F.when(c.rlike("^\\d{1,9}\\.?$"), F.regexp_extract(c, "^(\\d+)", 1).cast("int"))


def inline_markup(c: Column) -> Column:
    """Marks for annotation, proper name, emphasis and term as elements, in that order; a term's stars stand alone."""
    for mark, element, kind in (
        ("\\[\\[(.+?)\\]\\]", "span", "reader-annotation"),
        ("__(.+?)__", "span", "proper-name"),
        ("\\*\\*(.+?)\\*\\*", "strong", "emphasis"),
        ("(?<!\\*)\\*(?!\\*)(.+?)(?<!\\*)\\*(?!\\*)", "em", "term"),
    ):
        c = F.regexp_replace(c, mark, f'<{element} class="{kind}">$1</{element}>')
    return c


def seconds(c: Column) -> Column:
    """Seconds since the epoch as double, for timestamps with or without a zone (UTC session)."""
    return F.unix_micros(c.cast("timestamp")) / 1000000
