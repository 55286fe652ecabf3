"""Draft entries from classified lines and the markers of their pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions import text as t

# How far, in points, a marker may stand above or below its line, types of scene markers, placeholders by kind.
NEAR, SCENE_TYPES, OTHER = 3, ("scene_no", "split_scene"), "待译文本"
PLACEHOLDERS = {
    "scene_heading": "待译场景标题", "action": "待译动作描写", "character": "待译角色提示", "parenthetical": "待译括号说明",
    "dialogue": "待译对白", "transition": "待译转场", "format_marker": "待译格式标记", "page_heading": "待处理页码",
}


def placeholder(kind: Column, source: Column) -> Column:
    label = F.coalesce(F.create_map(*[F.lit(x) for pair in PLACEHOLDERS.items() for x in pair])[kind], F.lit(OTHER))
    return F.concat(label, F.lit("："), source)


def attached(lines: DataFrame, markers: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, page, at, marker_no`` of each line and each marker at most NEAR above or below it, on one page.

    Lines and markers meet on cells of NEAR points, a marker on its own and the two beside it, so a pair meets once.
    """
    cell = lambda y: F.floor(y / NEAR)
    left = lines.select(*keys, "page", "at", F.col("y").alias("line_y"), cell(F.col("y")).alias("cell"))
    own = cell(F.col("y"))
    right = markers.select(*keys, "page", "marker_no", F.col("y").alias("marker_y"), F.explode(F.array(own - 1, own, own + 1)).alias("cell"))
    return left.join(right, [*keys, "page", "cell"]).filter(F.abs(F.col("line_y") - F.col("marker_y")) <= NEAR).select(*keys, "page", "at", "marker_no")


def draft_entries(lines: DataFrame, markers: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, page, id, kind, source, translation, markers`` of a draft, the latter as ``array<struct<type, text>>`` from the top of the page.

    ``lines``: ``keys, page, at, kind, text, y``; ``markers``: ``keys, page, marker_no, type, text, scene_key, x, y``.  Lines that are page numbers go.
    Markers that no line takes become entries of their own: scene markers of one number and height share one.  Entries of
    a key are numbered on: lines in their order, then such groups from the top of each page.
    """
    body = lines.filter(~(F.coalesce("zone", F.lit("")) == "page_number")) if "zone" in lines.columns else lines
    w = Window.partitionBy(*keys)
    body = body.withColumn("index", F.row_number().over(w.orderBy("at"))).withColumn("n", F.count(F.lit(1)).over(w))
    taken = attached(body, markers, keys)
    listed = lambda: F.transform(F.array_sort(F.collect_list(F.struct((-F.col("y")).alias("up"), "x", "marker_no", "type", "text"))), lambda m: F.struct(m["type"].alias("type"), m["text"].alias("text")))
    named = markers.select(*keys, "marker_no", "type", "text", "x", "y")
    own = taken.join(named, [*keys, "marker_no"]).groupBy(*keys, "at").agg(listed().alias("markers"))
    rows = body.join(own, [*keys, "at"], "left")
    from_lines = rows.select(*keys, "page", F.format_string("p%03d-e%03d", "page", "index").alias("id"), "kind", F.col("text").alias("source"), placeholder(F.col("kind"), F.col("text")).alias("translation"), "markers")
    loose = markers.join(taken.select(*keys, "marker_no").distinct(), [*keys, "marker_no"], "left_anti")
    scene = F.col("type").isin(*SCENE_TYPES)
    alone = F.when(scene, F.coalesce("scene_key", "text")).otherwise(F.concat(F.lit("#"), F.col("marker_no").cast("string")))
    grouped = loose.groupBy(*keys, "page", "type", alone.alias("of"), t.bucket(F.col("y"), NEAR).alias("cell")).agg(
        listed().alias("markers"), F.min(F.struct("marker_no", "x", "y")).alias("first")
    )
    counts = body.groupBy(*keys).agg(F.max("n").alias("n"))
    place = F.row_number().over(w.orderBy("page", F.desc("first.y"), "first.x", "first.marker_no"))
    made = grouped.withColumn("place", place).join(counts, keys, "left")
    kind = F.when(F.col("type").isin(*SCENE_TYPES), "scene_heading").otherwise("format_marker")
    texts = F.array_join(F.transform("markers", lambda m: m["text"]), " / ")
    extra = made.select(*keys, "page", F.format_string("p%03d-m%03d", "page", F.coalesce("n", F.lit(0)) + F.col("place")).alias("id"), kind.alias("kind"), F.concat(F.lit("STRUCTURE MARKER: "), texts).alias("source"), placeholder(kind, texts).alias("translation"), "markers")
    return from_lines.unionByName(extra)
