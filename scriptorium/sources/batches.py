"""Batch, line, marker, event and report artifacts as JSON: sources with fixed schemas, and their sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.sources.captions import files

_MARKER = "struct<type:string,text:string,scene_no:string,position:string,pdf_page:int,display_page:int,x:double,y:double>"
_LAYOUT = "struct<type:string,source_entry_ids:array<string>,columns:array<struct<speaker:string,lines:array<string>>>>"
ENTRY = (
    f"struct<id:string,type:string,pdf_page:int,display_page:int,source:string,translation:string,markers:array<{_MARKER}>,subtitle_label:string,"
    f"subtitle_event_index:int,subtitle_start:double,subtitle_end:double,subtitle_match_confidence:string,layout_hidden:boolean,reflow:boolean,layout:{_LAYOUT}>"
)
BATCH = f"version int, batch_id string, source_pages struct<start:int,end:int>, has_subtitles boolean, title string, front_matter array<{ENTRY}>, entries array<{ENTRY}>, note string"
LINE = "struct<pdf_page:int,display_page:int,printed_page:int,text:string,x:double,y:double,source_layer:string,parts:int,zone:string>"
EVENT = "struct<start:double,end:double,text:string,type:string,speaker:string,annotation:string>"
# Types of a caption event that mark it as an annotation.
ANNOTATION_TYPES = ("annotation", "comment", "note")


def _documents(texts: DataFrame, schema: str) -> DataFrame:
    """One row per JSON text of ``path, text``; ``damaged`` holds a text that is no JSON object."""
    parsed = texts.select("path", F.from_json("text", f"{schema}, damaged string", {"columnNameOfCorruptRecord": "damaged"}).alias("doc"))
    return parsed.select("path", "doc.*")


def read_batches(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    return parse_batches(files(spark, path, glob))


def parse_batches(texts: DataFrame) -> DataFrame:
    return _documents(texts, BATCH)


def entries(batches: DataFrame, key: str = "batch_id") -> DataFrame:
    """Front matter and body, one row per entry: ``key, has_subtitles, part, ordinal`` and the entry's fields."""

    def part(name: str, array: str) -> DataFrame:
        rows = batches.select(key, "has_subtitles", F.lit(name).alias("part"), F.posexplode(array).alias("ordinal", "entry"))
        return rows.select(key, "has_subtitles", "part", "ordinal", "entry.*")

    return part("front", "front_matter").unionByName(part("body", "entries"))


def read_lines(spark: SparkSession, path: str, glob: str = "source-lines.json") -> DataFrame:
    return parse_lines(files(spark, path, glob))


def parse_lines(texts: DataFrame) -> DataFrame:
    rows = _documents(texts, f"version int, source string, rows array<{LINE}>")
    return rows.select("path", F.posexplode("rows").alias("line_no", "row")).select("path", "line_no", "row.*")


def read_markers(spark: SparkSession, path: str, glob: str = "source-markers.json") -> DataFrame:
    return parse_markers(files(spark, path, glob))


def parse_markers(texts: DataFrame) -> DataFrame:
    """Markers under ``markers``, or under ``known_markers`` in older files."""
    rows = _documents(texts, f"version int, source string, markers array<{_MARKER}>, known_markers array<{_MARKER}>")
    return rows.select("path", F.posexplode(F.coalesce("markers", "known_markers")).alias("marker_no", "marker")).select("path", "marker_no", "marker.*")


def read_events(spark: SparkSession, path: str, glob: str = "subtitles.json") -> DataFrame:
    """Caption events; a folder without such a file gives an empty table of the same columns."""
    return parse_events(files(spark, path, glob))


def parse_events(texts: DataFrame) -> DataFrame:
    rows = _documents(texts, f"version int, source string, events array<{EVENT}>")
    return rows.select("path", F.posexplode("events").alias("event_index", "event")).select("path", "event_index", "event.*")


def annotations(events: DataFrame) -> DataFrame:
    """Texts of annotation events, and texts noted on other events; blank ones are left out."""
    own = F.when(F.lower("type").isin(*ANNOTATION_TYPES), F.col("text"))
    rows = events.select("path", "event_index", F.trim(F.coalesce(F.nullif(F.trim("annotation"), F.lit("")), own)).alias("text"))
    return rows.filter("text <> ''")


def failure_modes(texts: DataFrame) -> DataFrame:
    """Ids of headings ``## FM-000`` in markdown: ``path, failure_mode``."""
    ids = F.regexp_extract_all("text", F.lit("(?m)^## (FM-[0-9]{3})"), F.lit(1))
    return texts.select("path", F.explode(F.array_distinct(ids)).alias("failure_mode"))


def write_json(rows: DataFrame, path: str) -> None:
    """JSON lines, absent fields left out."""
    rows.write.option("ignoreNullFields", "true").mode("errorifexists").json(path)


def write_report(findings: DataFrame, path: str) -> None:
    """A finding per line: ``LEVEL CODE message``."""
    findings.select(F.concat_ws(" ", "level", "code", "message").alias("value")).write.mode("errorifexists").text(path)


def has_failures(findings: DataFrame) -> bool:
    """Whether any finding fails; the scan stops at the first one."""
    return not findings.filter("level = 'FAIL'").isEmpty()
