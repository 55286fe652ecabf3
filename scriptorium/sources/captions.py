"""Timed-text, markdown, report and configuration sources, each as a DataFrame over whole files.

A file is one row of ``binaryFile``/``wholetext`` input (caption files are small); everything behind the
read is expressions, so files are dealt over the cluster and no row meets Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.functions import script
from scriptorium.functions import text as t

#: Margin, in the file's units, from which a line of an ASS file counts as an annotation.
ANNOTATION_MARGIN = 20
TIME = "\\d+:\\d{1,2}:\\d{1,2}(?:[.,]\\d+)?"


def files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Whole text files: ``path, text``; line ends become line feeds and a byte-order mark goes."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    rows = reader.text(path, wholetext=True)
    text = F.regexp_replace(F.regexp_replace(F.col("value"), "^\\x{feff}", ""), "\\r\\n?", "\n")
    return rows.select(F.col("_metadata.file_path").alias("path"), text.alias("text"))


def file_sizes(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``path, bytes`` of files; their content is not read."""
    reader = spark.read.format("binaryFile")
    rows = (reader.option("pathGlobFilter", glob) if glob else reader).load(path)
    return rows.select("path", F.col("length").alias("bytes"))


def page_ranges(paths: DataFrame) -> DataFrame:
    """``path, start, stop`` of files named ``translated-pNNN[-MMM].json``; others are left out."""
    pattern = "translated-p(\\d+)(?:-p?(\\d+))?\\.json$"
    start, stop = F.regexp_extract("path", pattern, 1), F.regexp_extract("path", pattern, 2)
    return paths.filter(F.col("path").rlike(pattern)).select("path", start.cast("int").alias("start"), F.coalesce(F.nullif(stop, F.lit("")), start).cast("int").alias("stop"))


def _numbered(events: DataFrame, order: list[str]) -> DataFrame:
    index = F.row_number().over(Window.partitionBy("path").orderBy(*order)) - 1
    return events.select("path", index.alias("event_index"), "start", "end", "text", "annotation")


def parse_cues(texts: DataFrame) -> DataFrame:
    """SRT and WebVTT: ``path, event_index, start, end, text, annotation`` from rows of ``path, text``.

    A cue is a block with an arrow line; a block without one (header, note, style) gives no row.  A cue
    without text stays, with an empty text.  Hours may be left out.
    """
    blocks = texts.select("path", F.posexplode(F.split("text", "\\n[ \\t]*\\n")).alias("block_no", "block"))
    time = "((?:\\d+:)?\\d{1,2}:\\d{1,2}(?:[.,]\\d+)?)"
    arrow = f"(?m)^[ \\t]*{time}[ \\t]+-->[ \\t]+{time}.*$"
    body = F.regexp_extract("block", "(?s)-->[^\\n]*\\n(.*)$", 1)
    cues = blocks.filter(F.col("block").rlike(arrow))

    def at(group: int) -> Column:
        value = F.regexp_extract("block", arrow, group)
        return t.parse_timecode(F.when(value.rlike("^\\d+:\\d+:"), value).otherwise(F.concat(F.lit("0:"), value)))

    rows = cues.select("path", "block_no", at(1).alias("start"), at(2).alias("end"), t.clean_caption(body).alias("text"), F.lit(False).alias("annotation"))
    return _numbered(rows, ["block_no"])


def parse_ass(texts: DataFrame) -> DataFrame:
    """ASS: the same columns; ``Format`` lines name the fields, the last field keeps its commas.

    An event is an annotation when its style or name says so, when it or its style is aligned to the top,
    or when its vertical margin is ``ANNOTATION_MARGIN`` or more.
    """
    w = Window.partitionBy("path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    lines = texts.select("path", F.posexplode(F.split("text", "\\n")).alias("line_no", "line"))
    line = F.trim("line")
    section = F.when(line.rlike("^\\[.*\\]$"), F.lower(F.regexp_extract(line, "^\\[(.*)\\]$", 1)))
    lines = lines.withColumn("section", F.last(section, True).over(w))
    named = F.when(line.rlike("(?i)^format:"), F.transform(F.split(F.regexp_replace(line, "(?i)^format:", ""), ","), lambda f: F.lower(F.trim(f))))
    w_section = Window.partitionBy("path", "section").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("fields", F.last(named, True).over(w_section))

    def records(kind: str, part: str) -> DataFrame:
        body = F.ltrim(F.regexp_replace(line, f"(?i)^{kind}:", ""))
        own = lines.filter(line.rlike(f"(?i)^{kind}:") & F.col("section").rlike(part) & F.col("fields").isNotNull())
        return own.select("path", "line_no", "fields", F.split(body, ",", -1).alias("parts"))

    def field(name: str) -> Column:
        place = F.array_position("fields", name).cast("int")
        return F.when(place > 0, F.trim(F.get("parts", place - 1)))

    n = F.size("fields")
    rest = F.array_join(F.slice("parts", n, F.greatest(F.size("parts") - n + 1, F.lit(0))), ",")
    events = records("dialogue", "events").filter(F.size("parts") >= n)
    events = events.select("path", "line_no", field("start").alias("s"), field("end").alias("e"), field("style").alias("style"), field("name").alias("name"), field("marginv").alias("margin"), rest.alias("raw"))
    styles = records("style", "styles").select("path", field("name").alias("style"), field("alignment").alias("alignment")).dropDuplicates(["path", "style"])
    joined = events.join(styles, ["path", "style"], "left")
    noted = F.lower(F.concat_ws(" ", "style", "name")).rlike("note|annotation|comment")
    top = F.col("raw").contains("\\an8") | F.coalesce(F.col("alignment") == "8", F.lit(False))
    margin = F.coalesce(F.col("margin").try_cast("int") >= ANNOTATION_MARGIN, F.lit(False))
    rows = joined.select("path", "line_no", t.parse_timecode(F.col("s")).alias("start"), t.parse_timecode(F.col("e")).alias("end"), t.clean_caption(F.col("raw")).alias("text"), (noted | top | margin).alias("annotation"))
    return _numbered(rows.filter("start is not null and end is not null"), ["line_no"])


def read_captions(spark: SparkSession, path: str) -> DataFrame:
    """All ``.ass``, ``.srt`` and ``.vtt`` files below a path, by their suffix."""
    return parse_captions(files(spark, path, "*.{ass,srt,vtt,ASS,SRT,VTT}"))


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, "(\\.[^./]*)$", 1))


def parse_captions(texts: DataFrame) -> DataFrame:
    """Events of ``path, text`` by the suffix of the path; others have none (``unsupported`` names them)."""
    kind = suffix(F.col("path"))
    return parse_ass(texts.filter(kind == ".ass")).unionByName(parse_cues(texts.filter(kind.isin(".srt", ".vtt"))))


def unsupported(paths: DataFrame) -> DataFrame:
    """``path, suffix`` of files that no reader of captions takes."""
    kind = suffix(F.col("path"))
    return paths.filter(~kind.isin(".ass", ".srt", ".vtt")).select("path", kind.alias("suffix"))


def parse_terms(texts: DataFrame) -> DataFrame:
    """Terms of markdown tables: ``path, line_no, source, target, notes``; header and rule rows are left out."""
    lines = texts.select("path", F.posexplode(F.split("text", "\\n")).alias("line_no", "line")).filter(F.trim("line").rlike("^\\|.*\\|$"))
    w = Window.partitionBy("path").orderBy("line_no")
    rows = lines.select("path", "line_no", script.table_cells(F.col("line")).alias("cells"))
    rows = rows.withColumn("rule", script.is_table_rule(F.col("cells"))).withColumn("header", F.coalesce(F.lead("rule").over(w), F.lit(False)))
    rows = rows.filter("not rule and not header and size(cells) >= 2")
    return rows.select("path", "line_no", F.get("cells", 0).alias("source"), F.get("cells", 1).alias("target"), F.coalesce(F.get("cells", 2), F.lit("")).alias("notes"))


def parse_first_terms(texts: DataFrame) -> DataFrame:
    """Terms of a file's first English and Chinese table alone, up to the first line that is no table row: ``path, source, target``.

    Of rows with one source the last counts.
    """
    lines = texts.select("path", F.posexplode(F.split("text", "\\n")).alias("line_no", "line"))
    by_path, after = Window.partitionBy("path"), Window.partitionBy("path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    head = F.col("line").rlike("^\\|\\s*English\\s*\\|\\s*Chinese\\s*\\|")
    rows = lines.withColumn("head", F.min(F.when(head, F.col("line_no"))).over(by_path)).filter(F.col("line_no") > F.col("head"))
    rows = rows.withColumn("ended", F.count_if(~F.trim("line").startswith("|")).over(after)).filter("ended = 0")
    rows = rows.select("path", "line_no", script.table_cells(F.col("line")).alias("cells"))
    rows = rows.filter(~script.is_table_rule(F.col("cells")) & (F.size("cells") >= 2) & (F.get("cells", 0) != ""))
    last = F.row_number().over(Window.partitionBy("path", F.get("cells", 0)).orderBy(F.desc("line_no")))
    return rows.withColumn("k", last).filter("k = 1").select("path", F.get("cells", 0).alias("source"), F.get("cells", 1).alias("target"))


def parse_findings(lines: Column) -> Column:
    """A report line ``LEVEL CODE message`` as a struct; missing parts are null."""
    parts = F.split(F.trim(lines), "\\s+", 3)
    return F.struct(F.get(parts, 0).alias("level"), F.get(parts, 1).alias("code"), F.get(parts, 2).alias("message"))


def parse_config(texts: DataFrame) -> DataFrame:
    """A two-level configuration as rows ``path, section, key, value``; comments go, quotes around a value too."""
    lines = texts.select("path", F.posexplode(F.split("text", "\\n")).alias("line_no", "line"))
    plain = F.rtrim(F.regexp_replace("line", "(^|\\s)#.*$", ""))
    lines = lines.select("path", "line_no", plain.alias("line")).filter(F.col("line").rlike("^\\s*[^:\\s][^:]*:"))
    nested = F.col("line").rlike("^\\s")
    key = F.trim(F.regexp_extract("line", "^\\s*([^:]+):", 1))
    value = F.trim(F.regexp_extract("line", "^[^:]+:(.*)$", 1))
    bare = F.regexp_replace(value, "^([\"'])(.*)\\1$", "$2")
    rows = lines.select("path", "line_no", nested.alias("nested"), key.alias("key"), F.when(~value.isin("", "null", "~"), bare).alias("value"), (value == "").alias("opens"))
    w = Window.partitionBy("path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    section = F.last(F.when(~F.col("nested"), F.col("key")), True).over(w)
    rows = rows.withColumn("section", F.when(F.col("nested"), section))
    return rows.filter(F.col("nested") | ~F.col("opens")).select("path", "section", "key", "value")
