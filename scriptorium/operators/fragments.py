"""Text fragments with a place on a page to lines, with the style spans of each fragment moved to the line."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import text as t

# Fixed values, in points: height of a line's cell, gap that stands for a space, left end of the body, top band of page numbers.
CELL, WORD_GAP, BODY_X, NUMBER_Y = 3, 10, 90, 720
STYLES = ("bold", "italic", "underline")


#: Every set of styles, in order, so that the place of one stands for it.
SETS = sorted([x for k, x in enumerate(STYLES) if code >> k & 1] for code in range(1 << len(STYLES)))


def _kept_spans(spans: Column) -> Column:
    """Spans that are not empty, with the place of their known styles in SETS; those without one (place 0) go."""
    mask = lambda styles: sum((F.when(F.array_contains(styles, x), 1 << k).otherwise(0) for k, x in enumerate(STYLES)), F.lit(0))
    places = F.array(*[F.lit(SETS.index([x for k, x in enumerate(STYLES) if code >> k & 1])).cast("byte") for code in range(len(SETS))])
    clean = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.element_at(places, mask(s["styles"]) + 1).alias("style")))
    return F.filter(clean, lambda s: (s["style"] > 0) & (s["start"] >= 0) & (s["end"] > s["start"]))


def _joined(spans: str) -> Column:
    """Sorted spans; touching ones of one style are one. Null without one."""
    apart = lambda a, b: F.coalesce((a["end"] != b["start"]) | (a["style"] != b["style"]), F.lit(True))
    first = F.filter(spans, lambda s, i: apart(F.get(spans, i - 1), s))
    last = F.filter(spans, lambda s, i: apart(s, F.get(spans, i + 1)))
    sets = F.array(*[F.array(*map(F.lit, x)).cast("array<string>") for x in SETS])
    return F.when(F.size(spans) > 0, F.zip_with(first, last, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end"), F.element_at(sets, a["style"].cast("int") + 1).alias("styles"))))


def zone(text: Column, x: Column, y: Column) -> Column:
    number = F.trim(text).rlike("^\\d+\\.?$") & (y >= NUMBER_Y)
    return F.when(number, "page_number").when(x >= BODY_X, "body").otherwise("margin")


def _running(lengths: str) -> Column:
    """Running sums of an array, over twice as many elements with each step, so that none is copied once for each that follows."""
    steps = F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda s: s < F.size(lengths))
    return F.aggregate(steps, F.col(lengths), lambda sums, s: F.transform(sums, lambda n, i: n + F.coalesce(F.get(sums, i - s), F.lit(0))))


def lines_of(fragments: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, cell, text, x, y, parts, zone, spans`` from ``keys, seq, x, y, text, spans``: each fragment is a run of its own."""
    return lines_of_runs(fragments, keys, ["x", "seq", "y", "text", "spans"], F.array, lambda run, piece, k: piece)


def lines_of_runs(runs: DataFrame, keys: list[str], held: list[str], pieces: Callable[[Column], Column], fragment: Callable[[Column, Column, Column], Column]) -> DataFrame:
    """``keys, cell, text, x, y, parts, zone, spans`` from ``keys, y`` and the columns ``held`` of runs of fragments in one cell of y.

    ``pieces`` takes a run, given as a struct of ``held``, apart into an array of one or more; ``fragment`` makes a run, a piece and
    its place there a struct of ``x, seq, y, text, spans``.  That happens after the only shuffle: what is shuffled and sorted are runs
    as they came, and no fragment ever has a row of its own.
    Fragments of one cell of y make a line, from left to right, then by ``seq``; one that begins more than WORD_GAP right of
    the one before brings a space.  A span moves by what stands before its fragment; touching spans of one style are one.
    Null texts are empty; a line holds what one page has at one height, so a task never holds more than that.
    """
    key = [*keys, "cell"]
    lines = runs.withColumn("cell", t.bucket(F.col("y"), CELL).cast("long")).groupBy(*key).agg(F.collect_list(F.struct(*held)).alias("runs"))
    part = lambda f: F.struct(f["x"].alias("x"), f["seq"].alias("seq"), f["y"].alias("y"), F.coalesce(f["text"], F.lit("")).alias("text"), F.coalesce(_kept_spans(f["spans"]), F.array()).alias("spans"))
    made = F.transform("runs", lambda run: F.transform(pieces(run), lambda piece, k: part(fragment(run, piece, k))))
    lines = lines.select(*key, F.sort_array(F.flatten(made)).alias("p"))
    gap = lambda f, i: F.when(f["x"] - F.get("p", i - 1)["x"] > WORD_GAP, " ").otherwise("")
    lines = lines.withColumn("pieces", F.transform("p", lambda f, i: F.concat(gap(f, i), f["text"])))
    lines = lines.withColumn("lengths", F.transform("pieces", lambda x: F.length(x)))
    begins = F.zip_with("p", _running("lengths"), lambda f, end: end - F.length(f["text"]))
    moved = F.zip_with("p", begins, lambda f, begin: F.transform(f["spans"], lambda s: F.struct((begin + s["start"]).alias("start"), (begin + s["end"]).alias("end"), s["style"].alias("style"))))
    lines = lines.select(*key, F.array_join("pieces", "").alias("text"), F.col("p")[0]["x"].alias("x"), F.col("p")[0]["y"].alias("y"), F.size("p").alias("parts"), F.sort_array(F.flatten(moved)).alias("spans"))
    return lines.select(*key, "text", "x", "y", "parts", zone(F.col("text"), F.col("x"), F.col("y")).alias("zone"), _joined("spans").alias("spans"))


def styled(spans: Column) -> Column:
    """Spans as text, ``0-5:bold,6-9:bold+italic``; empty without one."""
    return F.coalesce(F.array_join(F.transform(spans, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"), F.lit(":"), F.array_join(s["styles"], "+"))), ","), F.lit(""))
