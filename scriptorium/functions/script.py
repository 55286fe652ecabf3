"""Classification of script lines as column expressions; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptorium.functions import text as t

# Page geometry in points, and lengths in characters.
PAGE_WIDTH, MARGIN_WIDTH = 612, 96
SHAPE_LENGTH, LABEL_LENGTH, CUE_LENGTH, UPPER_SHARE = 80, 24, 40, 0.8
# How script lines begin or end, and what is no label though it looks like one.
HEADING = "^(INT|EXT|INT/EXT|I/E)[. ]"
TRANSITION = "^(CUT TO|FADE|DISSOLVE|SMASH CUT|MATCH CUT|BACK TO|JUMP CUT)($|[^\\p{L}\\p{N}_])|:$"
NO_LABEL = ("MORE", "(MORE)", "OMITTED", "OMMITTED")
SHAPE = "^[A-Z0-9][A-Z0-9 ./_'()-]*$"
LABEL = "^[A-Z0-9][A-Z0-9 ./_-]*$"
#: A word of capitals, digits and ./'- that begins with a capital, anywhere in a line; its ends are word boundaries.
CAPITALS = "(^|[^\\p{L}\\p{N}_])[A-Z][A-Z0-9./'-]*([A-Z0-9]($|[^\\p{L}\\p{N}_])|[./'-][\\p{L}\\p{N}_])"
CUE_X, DIALOGUE_X = 220, 160


def margin_side(x: Column) -> Column:
    """``left`` or ``right`` for text in a margin of the page, else null."""
    return F.when(x <= MARGIN_WIDTH, "left").when(x >= PAGE_WIDTH - MARGIN_WIDTH, "right")


def line_zone(text: Column, x: Column) -> Column:
    return F.when(t.page_number(text).isNotNull(), "page_number").when(margin_side(x).isNotNull(), "margin").otherwise("body")


def _longer(c: Column, length: int) -> Column:
    """Whether more than so many characters are not white space; reads no further."""
    return c.rlike(f"^(?:\\s*+\\S){{{length + 1}}}")


def structural_shape(c: Column) -> Column:
    """A short line that is all capitals, digits and label signs, or holds a word of capitals."""
    long, c = _longer(c, SHAPE_LENGTH), t.collapse_space(c)
    return ~long & (F.length(c) <= SHAPE_LENGTH) & (c.rlike(SHAPE) | c.rlike(CAPITALS))


def scene_label(c: Column) -> Column:
    """``scene_no`` for digits, a Roman number or one letter; ``split_scene`` for other short labels with a digit; else null."""
    label = F.upper(t.collapse_space(c))
    fits = ~_longer(c, LABEL_LENGTH) & (F.length(label) <= LABEL_LENGTH) & ~label.isin(*NO_LABEL) & label.rlike(LABEL)
    return F.when(fits & label.rlike("^([0-9]+|[IVXLCDM]+|[A-Z])$"), "scene_no").when(fits & label.rlike("[0-9]"), "split_scene")


def text_marker(text: Column) -> Column:
    """What a text says of itself: ``contd``, ``more``, ``omitted``, ``voice_or_position``, or null."""
    upper = F.upper(F.translate(text, "’", "'"))
    return (
        F.when(upper.contains("CONT'D") | upper.contains("CONTINUED"), "contd")
        .when(F.trim(upper).isin("MORE", "(MORE)"), "more")
        .when(F.trim(upper).isin("OMITTED", "OMMITTED"), "omitted")
        .when(upper.rlike("V\\.O\\.|O\\.S\\.|O\\.C\\."), "voice_or_position")
    )


def signal_route(text: Column, x: Column) -> Column:
    """``marker`` for a label in a margin, ``noise`` for a label elsewhere or other margin text, ``unclassified`` for other structural lines, else null."""
    label, margin = scene_label(text).isNotNull(), margin_side(x).isNotNull()
    return F.when(label & margin, "marker").when(label | margin, "noise").when(structural_shape(text), "unclassified")


def entry_kind(text: Column, x: Column) -> Column:
    """Kind of a line by itself; ``dialogue`` is known only from its neighbours (see ``with_dialogue``)."""
    text = F.trim(text)
    upper = F.coalesce(t.upper_share(text) > UPPER_SHARE, F.lit(False))
    return (
        F.when(t.page_number(text).isNotNull(), "page_heading")
        .when(text.rlike(HEADING), "scene_heading")
        .when(text.startswith("("), "parenthetical")
        .when(text.rlike(TRANSITION) & upper, "transition")  # letters are counted only where the rest fits
        .when((x >= CUE_X) & (F.length(text) <= CUE_LENGTH) & upper, "character")
        .when((F.length(text) <= CUE_LENGTH) & upper, "format_marker")
        .otherwise("action")
    )


def asterisk(text: Column) -> Column:
    """Whether a line ends in a revision mark."""
    return text.rlike("\\s\\*$")


def split_asterisk(text: Column) -> Column:
    """A text without its final ``[[*]]``, and whether it had one."""
    return F.struct(F.regexp_replace(text, "\\s*\\[\\[\\*\\]\\]\\s*$", "").alias("body"), text.rlike("\\[\\[\\*\\]\\]\\s*$").alias("revised"))


def repair_glyphs(c: Column) -> Column:
    """Glyphs that a font without an encoding shows for quotation marks, ellipsis and dash."""
    return F.translate(F.replace(c, F.lit("É"), F.lit("...")), "ÕÒÓÑ", "’\"\"-")


def strip_ends(c: Column, characters: str) -> Column:
    return F.btrim(c, F.lit(characters))


def to_millimetres(points: Column) -> Column:
    return F.bround(points * 25.4 / 72, 1)


def font_styles(name: Column) -> Column:
    """Styles in a font name behind its subset prefix: ``bold``, ``italic``, both (comma between), or empty."""
    plain = F.lower(F.element_at(F.split(name, "\\+"), -1))
    return F.concat_ws(",", F.when(plain.rlike("bold|black|heavy"), "bold"), F.when(plain.rlike("italic|oblique"), "italic"))


def divergence_label(changed: Column, unseen: Column) -> Column:
    """Counts above zero as text, in the given order."""
    return F.concat_ws("·", F.when(changed > 0, F.concat(changed.cast("string"), F.lit("改"))), F.when(unseen > 0, F.concat(unseen.cast("string"), F.lit("未见"))))


def table_cells(line: Column) -> Column:
    """Trimmed cells of a markdown table row."""
    return F.transform(F.split(F.regexp_replace(F.trim(line), "^\\||\\|$", ""), "\\|"), lambda cell: F.trim(cell))


def is_table_rule(cells: Column) -> Column:
    return F.forall(cells, lambda c: c.rlike("^:?-+:?$"))


def token_key(c: Column) -> Column:
    return F.lower(F.translate(c, "’", "'"))


def structure_preview(kind: Column, texts: Column) -> Column:
    return F.concat(F.lit("STRUCTURE PREVIEW "), kind, F.lit(": "), F.array_join(texts, " / "))
