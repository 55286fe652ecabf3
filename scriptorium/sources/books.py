"""EPUB files: made from ordered sections in Arrow batches (a zip archive is no expression), and checked by reading them again."""

from __future__ import annotations

import io
import os
import re
import uuid
import zipfile
from collections.abc import Iterator
from html import escape
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Kinds of sections in their order, titles and notice of a cover, and how a page names its number.
KINDS = ("cover", "reader-notes", "chapter")
COVER, KICKER, NOTICE = "封面", "中文剧本学习版", "本中文剧本学习版仅供个人学习与研究使用，请勿商用或公开传播。"
PAGE_TITLE = "原剧本第\\s*(-?[0-9]+)\\s*页"
#: The date of all members, so that equal sections make equal files.
DATE = (1980, 1, 1, 0, 0, 0)
STYLE = "body{font-family:serif;line-height:1.5}.marker{color:#777}"
SECTION = "book string, title string, source_title string, language string, kind string, file string, heading string, html string, scenes array<struct<href:string,title:string>>"
_CONTAINER = '<?xml version="1.0"?><container version="1.0" xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="content.opf" media-type="application/oebps-package+xml"/></rootfiles></container>'


def sections(rows: DataFrame, order: str) -> DataFrame:
    """Rows of ``SECTION`` with the names of their files, from ``book, title, source_title, language, kind, heading, html, scenes`` and an order.

    A page that shows its number is headed by it.  Null texts are empty; kinds other than ``KINDS`` are left out.
    """
    w = Window.partitionBy("book", "kind")
    n, at = F.count("*").over(w), F.row_number().over(w.orderBy(order, "heading", "html"))
    number = F.regexp_extract("html", PAGE_TITLE, 1)
    heading = F.when((F.col("kind") == "chapter") & (number != ""), F.concat(F.lit("原剧本第 "), number, F.lit(" 页"))).otherwise(F.coalesce("heading", F.lit("")))
    single = (F.col("kind") != "chapter") & (n == 1)
    name = F.when(F.col("kind") == "cover", F.when(at == 1, "cover").otherwise(F.format_string("cover-%02d", at))).when(single, F.col("kind")).otherwise(F.when(F.col("kind") == "chapter", F.format_string("chapter-%03d", at)).otherwise(F.format_string("reader-notes-%02d", at)))
    named = rows.filter(F.col("kind").isin(*KINDS)).withColumns({"file": F.concat(name, F.lit(".xhtml")), "place": at, "heading": heading, "html": F.coalesce("html", F.lit(""))})
    return named.select(*[c.split()[0] for c in SECTION.split(", ")], "place")


def _page(title: str, body: str) -> str:
    if re.search(r"<html\b", body, re.I):
        return body
    return f'<!DOCTYPE html>\n<html xmlns="http://www.w3.org/1999/xhtml"><head><title>{escape(title)}</title><link rel="stylesheet" type="text/css" href="style.css"/></head><body>\n{body}\n</body></html>\n'


class _Writer:
    """An archive that takes one section at a time; what it keeps of each is its name and links."""

    def __init__(self, book: str, title: str, source_title: str, language: str):
        self.book, self.title, self.source_title, self.language = book, title, source_title, language
        self.data, self.items = io.BytesIO(), []
        self.archive = zipfile.ZipFile(self.data, "w", zipfile.ZIP_DEFLATED)
        self._put("mimetype", "application/epub+zip", zipfile.ZIP_STORED)
        self._put("META-INF/container.xml", _CONTAINER)
        self._put("style.css", STYLE)

    def _put(self, name: str, text: str, how: int = zipfile.ZIP_DEFLATED) -> None:
        self.archive.writestr(zipfile.ZipInfo(name, DATE), text.encode(), how)

    def add(self, kind: str, file: str, heading: str, html: str, scenes: list[dict] | None) -> None:
        if not self.items and kind != "cover":
            body = f'<section class="cover"><p>{KICKER}</p><h1>{escape(self.title)}</h1><p>{escape(self.source_title)}</p><p>{NOTICE}</p></section>'
            self.add("cover", "cover.xhtml", COVER, body, None)
        heading = heading or (COVER if kind == "cover" else self.title)
        self._put(file, _page(heading, html))
        self.items.append((file, heading, [(s["href"] or "", s["title"] or "") for s in scenes or () if s]))

    def finish(self) -> bytes:
        ids = [file.removesuffix(".xhtml") for file, _, _ in self.items]
        links = []
        for file, heading, scenes in self.items:
            inner = "".join(f'<li><a href="{file}#{escape(href)}">{escape(title)}</a></li>' for href, title in scenes)
            links.append(f'<li><a href="{file}">{escape(heading)}</a>{f"<ol>{inner}</ol>" if inner else ""}</li>')
        self._put("nav.xhtml", _page(self.title, f'<nav xmlns:epub="http://www.idpf.org/2007/ops" epub:type="toc"><ol>{"".join(links)}</ol></nav>'))
        manifest = "".join(f'<item id="{i}" href="{i}.xhtml" media-type="application/xhtml+xml"/>' for i in ids)
        spine = "".join(f'<itemref idref="{i}"/>' for i in ids)
        identifier = uuid.uuid5(uuid.NAMESPACE_URL, self.book)
        self._put(
            "content.opf",
            f'<?xml version="1.0" encoding="utf-8"?><package xmlns="http://www.idpf.org/2007/opf" version="3.0" unique-identifier="id"><metadata xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:identifier id="id">urn:uuid:{identifier}</dc:identifier><dc:title>{escape(self.title)}</dc:title><dc:language>{escape(self.language)}</dc:language></metadata>'
            f'<manifest><item id="style" href="style.css" media-type="text/css"/><item id="nav" href="nav.xhtml" media-type="application/xhtml+xml" properties="nav"/>{manifest}</manifest><spine>{spine}</spine></package>',
        )
        self.archive.close()
        return self.data.getvalue()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for book, rows in groupby(_rows(batches), lambda r: r["book"]):
        writer = None
        for r in rows:
            writer = writer or _Writer(book or "", r["title"] or "", r["source_title"] or "", r["language"] or "zh-CN")
            writer.add(r["kind"], r["file"], r["heading"], r["html"], r["scenes"])
        yield pa.RecordBatch.from_pylist([{"book": book, "content": writer.finish()}], pa.schema([("book", pa.string()), ("content", pa.binary())]))


def epub_files(named: DataFrame) -> DataFrame:
    """``book, content`` from rows of ``sections``.  A book's sections stream through one task, which holds its compressed file."""
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    rows = named.withColumn("rank", rank).repartition("book").sortWithinPartitions("book", "rank", "place")
    return rows.select(*[c.split()[0] for c in SECTION.split(", ")]).mapInArrow(_write, "book string, content binary")


def check(content: bytes) -> tuple[str | None, list[str], list[str]]:
    """What is wrong with a file (null: nothing), its spine, and the texts of its table of contents."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(content))
        names = archive.namelist()
        if not names or names[0] != "mimetype" or "META-INF/container.xml" not in names:
            return "required files missing", [], []
        package = archive.read(re.search(r'full-path="([^"]+)"', archive.read("META-INF/container.xml").decode())[1]).decode()
        files = dict(re.findall(r'<item id="([^"]+)" href="([^"]+)"', package))
        spine = [files.get(i, "") for i in re.findall(r'<itemref idref="([^"]+)"', package)]
        contents = re.findall(r"<a [^>]*>([^<]*)</a>", archive.read("nav.xhtml").decode())
    except (zipfile.BadZipFile, KeyError, TypeError) as error:
        return f"not readable: {type(error).__name__}", [], []
    wrong = "spine is empty" if not spine else "spine names absent files" if set(spine) - set(names) else None
    return wrong, spine, contents


def checked(books: DataFrame) -> DataFrame:
    """``book, wrong, spine, contents`` of files; see ``check``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("book", pa.string()), ("wrong", pa.string()), ("spine", pa.list_(pa.string())), ("contents", pa.list_(pa.string()))])
        for r in _rows(batches):
            wrong, spine, contents = check(r["content"] or b"")
            yield pa.RecordBatch.from_pylist([{"book": r["book"], "wrong": wrong, "spine": spine, "contents": contents}], schema)

    return books.select("book", "content").mapInArrow(run, "book string, wrong string, spine array<string>, contents array<string>")


def save(books: DataFrame, folder: str) -> int:
    """Writes files below a local folder of the driver, one at a time; a file that its check refuses is not written and raises."""
    os.makedirs(folder, exist_ok=True)
    n = 0
    for r in books.toLocalIterator():
        wrong, _, _ = check(bytes(r.content))
        if wrong:
            raise ValueError(f"{r.book}: {wrong}")
        with open(os.path.join(folder, f"{re.sub(r'[^0-9A-Za-z._-]', '_', r.book or '')}.epub"), "wb") as f:
            f.write(r.content)
        n += 1
    return n


def scene_links(html: Column) -> Column:
    """Anchors of headings in a page, as ``array<struct<href, title>>``."""
    found = F.regexp_extract_all(html, F.lit('<h3 id="([^"]*)">'), F.lit(1))
    titles = F.regexp_extract_all(html, F.lit('<h3 id="[^"]*">([^<]*)'), F.lit(1))
    return F.zip_with(found, titles, lambda a, b: F.struct(a.alias("href"), b.alias("title")))
