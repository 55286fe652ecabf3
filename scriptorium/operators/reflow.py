"""Display units: runs of entries that a reader sees as one, and entries that keep their own line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.operators import runs

# Types that are always protected, list marks, words that begin text on a screen, the mark of a revised line.
PROTECTED_TYPES = ("page_heading", "scene_heading", "character", "parenthetical", "transition", "format_marker", "note")
LIST_MARK = "^\\s*([-+•]|[0-9]+[.)])\\s+"
SCREEN_WORDS = ("SUPER", "TITLE", "TITLES", "CHYRON", "CAPTION", "SUBTITLE", "TEXT", "ON SCREEN")
SCREEN_TEXT = "(?i)^\\s*(" + "|".join(SCREEN_WORDS) + ")($|[^\\p{L}\\p{N}_])"
REVISED = "\\[\\[\\*\\]\\]\\s*$"
LYRIC = "♪"
SPACE = " \t\n\x0b\f\r"


def stripped(c: Column) -> Column:
    return F.btrim(F.coalesce(c, F.lit("")), F.lit(SPACE))


def protected(e: dict[str, Column]) -> Column:
    """Whether an entry keeps its own line, by any of eight tests.

    ``e``: ``kind, source, translation, n_markers, preserve_line_breaks, reflow, has_layout``; nulls speak for no test.
    """
    text = stripped(e["translation"])
    tests = [
        e["kind"].isin(*PROTECTED_TYPES),
        e["n_markers"] > 0,
        e["translation"].rlike(REVISED),
        e["preserve_line_breaks"] | ~F.coalesce(e["reflow"], F.lit(True)),
        text.rlike(LIST_MARK) & ~((e["kind"] == "action") & text.rlike("^\\s*-\\s+")),
        e["source"].rlike(SCREEN_TEXT) | text.rlike(SCREEN_TEXT),
        text.contains(LYRIC) | text.contains("\n"),
        e["has_layout"],
    ]
    hit = F.lit(False)
    for test in tests:
        hit = hit | F.coalesce(test, F.lit(False))
    return hit


def unit_type(kind: Column) -> Column:
    return F.when(kind == "dialogue", "dialogue").when(kind == "action", "prose").otherwise("protected")


def mergeable(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds ``merges``: whether an entry goes on from the one before, from ``kind, page, label, kept``.

    Both are on one page, neither is protected, and both are action, or dialogue with one label (none: the empty one).
    """
    w = Window.partitionBy(*keys).orderBy(order)
    label = F.coalesce("label", F.lit(""))
    both = F.struct("kind", "page", label.alias("label"), "kept")
    before = F.lag(both).over(w)
    same = (F.col("page") == before["page"]) & ~F.col("kept") & ~before["kept"] & (F.col("kind") == before["kind"])
    return rows.withColumn("merges", F.coalesce(same & ((F.col("kind") == "action") | ((F.col("kind") == "dialogue") & (label == before["label"]))), F.lit(False)))


def display_units(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``keys, unit, first, n, type, ids, text`` from ``keys, order, id, kind, page, label, translation, hidden, kept``; hidden entries are left out."""
    shown = rows.filter(~F.coalesce("hidden", F.lit(False)))
    numbered = runs.islands(mergeable(shown, keys, order), keys, [order], ~F.col("merges"), "unit")
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), "id", stripped(F.col("translation")).alias("text"), "kind", "kept")))
    units = numbered.groupBy(*keys, "unit").agg(parts.alias("p"))
    head = F.col("p")[0]
    kind = F.when(head["kept"], "protected").otherwise(unit_type(head["kind"]))
    listed = lambda name: F.transform("p", lambda x: x[name])
    return units.select(*keys, "unit", head["at"].alias("first"), F.size("p").cast("long").alias("n"), kind.alias("type"), F.array_join(listed("id"), ",").alias("ids"), stripped(F.array_join(listed("text"), "")).alias("text"))
