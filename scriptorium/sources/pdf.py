"""Positioned text of PDF files, and lines made of it.

A file is one row of ``binaryFile`` input; a reader of PDF syntax turns it into text operations in Arrow
batches (no built-in function can), and everything behind that is expressions.  Read are objects of
generation 0 with plain or Flate streams; encrypted files, object streams and character maps are not.
A damaged stream gives no rows and no error.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.functions import script
from scriptorium.functions import text as t
from scriptorium.operators import runs

OPS = "path string, pdf_page int, op_seq int, text string, x double, y double, source_layer string, font_resource string, font_size double, font_names array<string>"
PAGE_HEIGHT = 792.0
#: A gap between starts that separates words, and the height of a line's cell, in points.
WORD_GAP, LINE_CELL = 10, 3

_DELIMITER = rb"\x00\t\n\x0c\r ()<>\[\]{}/%"
_TOKEN = re.compile(
    rb"(?P<skip>[\x00\t\n\x0c\r ]+|%[^\r\n]*)|(?P<open><<|\[)|(?P<close>>>|\])|<(?P<hex>[0-9A-Fa-f\s]*)>|(?P<string>\()"
    rb"|/(?P<name>[^" + _DELIMITER + rb"]*)|(?P<number>[+-]?(?:\d+\.?\d*|\.\d+))(?=[" + _DELIMITER + rb"]|\Z)|(?P<word>[^" + _DELIMITER + rb"]+)|(?P<other>.)",
    re.S,
)
_ESCAPES = {ord("n"): b"\n", ord("r"): b"\r", ord("t"): b"\t", ord("b"): b"\b", ord("f"): b"\f"}


class Name(str):
    """A PDF name."""


class Word(str):
    """An operator or keyword."""


class Ref(int):
    """A reference to an object."""


def _string(data: bytes, at: int) -> tuple[bytes, int]:
    """A string whose opening parenthesis is before ``at``, and the place behind it."""
    out, depth, n = bytearray(), 1, len(data)
    while at < n:
        c = data[at]
        at += 1
        if c == 0x5C and at < n:
            c = data[at]
            at += 1
            if 0x30 <= c <= 0x37:
                digits = re.compile(rb"[0-7]{1,3}").match(data, at - 1).group()
                out.append(int(digits, 8) & 255)
                at += len(digits) - 1
            elif c == 0x0D:
                at += data[at : at + 1] == b"\n"
            elif c != 0x0A:
                out += _ESCAPES.get(c, bytes([c]))
            continue
        depth += (c == 0x28) - (c == 0x29)
        if not depth:
            break
        out.append(c)
    return bytes(out), at


def items(data: bytes, at: int = 0) -> Iterator[tuple[object, int]]:
    """Values and words of PDF syntax with the place behind each; containers come as a whole, unclosed ones not at all."""
    stack: list[list] = []
    n = len(data)
    while at < n:
        m = _TOKEN.match(data, at)
        kind, at = m.lastgroup, m.end()
        if kind in ("skip", "other"):
            continue
        if kind == "open":
            stack.append([m.group()])
            continue
        if kind == "close":
            if not stack:
                continue
            opened, *values = stack.pop()
            value = values if opened == b"[" else {k: v for k, v in zip(values[::2], values[1::2]) if isinstance(k, str)}
        elif kind == "string":
            value, at = _string(data, at)
        elif kind == "hex":
            digits = re.sub(rb"\s", b"", m.group("hex"))
            value = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        elif kind == "number":
            raw = m.group()
            value = float(raw) if b"." in raw else int(raw)
        else:
            value = (Name if kind == "name" else Word)(m.group(kind).decode("latin-1"))
            if value == "R" and stack and len(stack[-1]) > 2:
                *rest, number, _ = stack[-1]
                stack[-1][:] = rest
                value = Ref(number)
        if stack:
            stack[-1].append(value)
        else:
            yield value, at


class File:
    """Objects of one file, read when asked for."""

    def __init__(self, data: bytes):
        self.data = data
        self.places = {int(m.group(1)): m.end() for m in re.finditer(rb"(?<!\d)(\d+)\s+0\s+obj\b", data)}
        self.known: dict[int, tuple[object, int]] = {}

    def get(self, value: object) -> object:
        for _ in range(32):  # chains of references end, even when they turn in a circle
            if not isinstance(value, Ref):
                return value
            value = self._object(value)[0]
        return None

    def _object(self, number: int) -> tuple[object, int]:
        if number not in self.known:
            at = self.places.get(number)
            self.known[number] = (None, 0) if at is None else next(items(self.data, at), (None, 0))
        return self.known[number]

    def dictionary(self, value: object) -> dict:
        found = self.get(value)
        return found if isinstance(found, dict) else {}

    def pages(self) -> list[dict]:
        """Pages in reading order; by number of their objects where the tree names none."""
        every = {n: self.dictionary(Ref(n)) for n in sorted(self.places)}
        root = next((d["Pages"] for d in every.values() if d.get("Type") == "Catalog" and "Pages" in d), None)
        out, seen, stack = [], set(), [root]
        while stack:
            at = stack.pop()
            if not isinstance(at, Ref) or at in seen:
                continue
            seen.add(at)
            node = self.dictionary(at)
            kids = self.get(node.get("Kids"))
            if node.get("Type") == "Page":
                out.append(node)
            elif node.get("Type") == "Pages" and isinstance(kids, list):
                stack.extend(reversed(kids))
        return out or [d for d in every.values() if d.get("Type") == "Page"]

    def stream(self, value: object) -> bytes:
        if not isinstance(value, Ref):
            return b""
        about, end = self._object(value)
        begin = re.compile(rb"\s*stream(?:\r\n|\n|\r)").match(self.data, end) if isinstance(about, dict) else None
        if begin is None:
            return b""
        length = self.get(about.get("Length"))
        stop = begin.end() + length if isinstance(length, int) and length >= 0 else -1
        if stop < 0 or not re.compile(rb"\s*endstream").match(self.data, stop):
            stop = self.data.find(b"endstream", begin.end())
        raw = self.data[begin.end() : max(stop, begin.end())]
        filters = self.get(about.get("Filter"))
        if filters is None or filters == []:
            return raw
        if filters not in ("FlateDecode", ["FlateDecode"]):
            return b""
        try:
            return zlib.decompressobj().decompress(raw)  # bytes behind the stream are left alone
        except zlib.error:
            return b""

    def font_names(self, value: object, depth: int = 0) -> set[str]:
        font = self.dictionary(value)
        names = {str(font[k]) for k in ("BaseFont", "FontName") if isinstance(font.get(k), Name)}
        for below in [font.get("FontDescriptor"), *(self.get(font.get("DescendantFonts")) or [])]:
            if depth < 4 and below is not None:
                names |= self.font_names(below, depth + 1)
        return names


def _numbers(operands: list, n: int) -> list[float] | None:
    last = operands[-n:]
    return [float(v) for v in last] if len(last) == n and all(isinstance(v, (int, float)) for v in last) else None


def _shown(operand: object) -> bytes | None:
    if isinstance(operand, bytes):
        return operand
    return b"".join(v for v in operand if isinstance(v, bytes)) if isinstance(operand, list) else None


def show(content: bytes) -> Iterator[tuple[str, float, float, str, str | None, float | None]]:
    """Text operations of a content stream: text, x, y, layer, font, size.  Text before the first text matrix has no place and is left out."""
    operands: list[object] = []
    height, saved = None, []
    matrix = font = size = None
    for value, _ in items(content):
        if not isinstance(value, Word):
            operands.append(value)
            continue
        if value == "q":
            saved.append(height)
        elif value == "Q":
            height = saved.pop() if saved else None
        elif value == "cm" and (v := _numbers(operands, 6)):
            height = v[5] if v[:5] == [1, 0, 0, -1, 0] else None
        elif value == "BT":
            matrix = font = size = None
        elif value == "Tm" and (v := _numbers(operands, 6)):
            matrix = [v[0], v[3], v[4], v[5]]
        elif value == "Tf" and len(operands) > 1 and isinstance(operands[-2], Name) and (v := _numbers(operands, 1)):
            font, size = str(operands[-2]), v[0]
        elif value in ("Td", "TD") and matrix and (v := _numbers(operands, 2)):
            matrix = [*matrix[:2], matrix[2] + v[0] * matrix[0], matrix[3] + v[1] * matrix[1]]
        elif value in ("Tj", "TJ") and matrix and operands and (raw := _shown(operands[-1])) is not None:
            flipped = height is not None or matrix[1] < 0
            y = (PAGE_HEIGHT if height is None else height) - matrix[3] if flipped else matrix[3]
            yield raw.decode("latin-1"), matrix[2], y, "flipped" if flipped else "normal", font, size
        operands.clear()


def read_file(data: bytes) -> Iterator[tuple]:
    """Rows of ``OPS`` behind the path."""
    file = File(data)
    for number, page in enumerate(file.pages(), 1):
        fonts = file.dictionary(file.dictionary(page.get("Resources")).get("Font"))
        contents = file.get(page.get("Contents"))
        streams = contents if isinstance(contents, list) else [page.get("Contents")]
        names = {k: sorted(file.font_names(v)) for k, v in fonts.items()}
        found = (op for one in streams for op in show(file.stream(one)))
        for seq, (text, x, y, layer, font, size) in enumerate(found):
            yield number, seq, text, x, y, layer, font, size, names.get(font, [])


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in OPS.split(", ")]
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            if content is None:
                continue
            yield pd.DataFrame([(path, *row) for row in read_file(bytes(content))], columns=columns)


def text_ops(spark: SparkSession, path: str) -> DataFrame:
    """Text operations of all PDF files below a path."""
    return parse(spark.read.format("binaryFile").option("pathGlobFilter", "*.{pdf,PDF}").load(path))


def parse(files: DataFrame) -> DataFrame:
    """Text operations of ``path, content``, glyphs repaired, with the styles that their fonts' names tell."""
    ops = files.select("path", "content").mapInPandas(_read, OPS)
    styles = F.array_sort(F.array_distinct(F.filter(F.flatten(F.transform("font_names", lambda n: F.split(script.font_styles(n), ","))), lambda x: x != "")))
    return ops.withColumn("text", script.repair_glyphs(F.col("text"))).withColumn("styles", styles).drop("font_names")


def text_rows(ops: DataFrame) -> DataFrame:
    """Operations without blank ones, and once where a text is drawn again at the same place."""
    place = [F.rint("x"), F.rint("y")]
    w = Window.partitionBy("path", "pdf_page", "text", *place).orderBy("op_seq")
    return ops.filter(F.trim("text") != "").withColumn("k", F.row_number().over(w)).filter("k = 1").drop("k")


def source_lines(rows: DataFrame, page_offset: int = 0) -> DataFrame:
    """Lines of a page from top to bottom, their parts joined from left to right, a space at each wide gap."""
    parts = F.array_sort(F.collect_list(F.struct("x", "op_seq", "y", "text", "styles")))
    lines = rows.groupBy("path", "pdf_page", F.rint(F.col("y") / LINE_CELL).alias("cell")).agg(parts.alias("p"))
    joined = F.aggregate(
        "p",
        F.struct(F.lit("").alias("text"), F.lit(None).cast("double").alias("x")),
        lambda acc, part: F.struct(F.concat(acc["text"], F.when(part["x"] - acc["x"] > WORD_GAP, " ").otherwise(""), part["text"]).alias("text"), part["x"].alias("x")),
    )["text"]
    first = F.col("p")[0]
    styles = F.array_sort(F.array_distinct(F.flatten(F.transform("p", lambda part: part["styles"]))))
    out = lines.select("path", "pdf_page", joined.alias("text"), first["x"].alias("x"), first["y"].alias("y"), F.size("p").alias("parts"), styles.alias("styles"))
    line_no = F.row_number().over(runs.ordered(["path", "pdf_page"], [F.desc("y"), "x"])) - 1
    out = out.withColumn("line_no", line_no).withColumn("display_page", F.col("pdf_page") - page_offset)
    number = t.page_number(F.trim("text")).isNotNull() & (F.col("y") >= 720)
    zone = F.when(number, "page_number").when(script.margin_side(F.col("x")).isNotNull() & script.scene_label(F.col("text")).isNotNull(), "margin").otherwise("body")
    return out.withColumn("zone", zone)


def marker_types(lines: DataFrame) -> DataFrame:
    """Lines that mark structure: continued, more, omitted, voice, and scene labels in a margin, with its side."""
    label = F.when(script.margin_side(F.col("x")).isNotNull() & F.col("zone").isin("margin"), script.scene_label(F.col("text")))
    kind = F.coalesce(script.text_marker(F.col("text")), label)
    side = F.when(kind.isin("scene_no", "split_scene"), script.margin_side(F.col("x")))
    return lines.withColumn("type", kind).withColumn("position", side).filter("type is not null").select("path", "type", "pdf_page", "display_page", "text", "x", "y", "position")
