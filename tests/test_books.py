"""EPUB files with missing parts, their order and links, and what the check refuses."""

import io
import zipfile

import pytest

from scriptorium.sources import books

ROWS = "book string, title string, source_title string, language string, kind string, n int, heading string, html string, scenes array<struct<href:string,title:string>>"


def test_sections_files_and_check(spark, tmp_path):
    rows = [("a", "A & B", "s", "zh-CN", "chapter", i, None, f"<p>原剧本第 {i} 页</p>" + "x" * (1 << 20 if i == 2 else 1), [("s1", "INT <A>"), None] if i == 1 else None) for i in (2, 1, 10)]
    rows += [("a", None, None, None, "reader-notes", i, "n", None, None) for i in (1, 2)] + [("b", None, None, None, "cover", 1, "c", "<p>own</p>", None), ("b", "t", "s", "l", "other", 1, "x", "x", None)]
    rows += [(None, "t", "s", "l", "chapter", 1, "one", "<p/>", []), (None, "t", "s", "l", "chapter", 1, "one", "<p/>", [])]
    files = books.epub_files(books.sections(spark.createDataFrame(rows, ROWS), "n")).cache()
    made = {r.book: r for r in books.checked(files).collect()}
    assert {b: r.wrong for b, r in made.items()} == {"a": None, "b": None, None: None}
    assert made["a"].spine == ["cover.xhtml", "reader-notes-01.xhtml", "reader-notes-02.xhtml", "chapter-001.xhtml", "chapter-002.xhtml", "chapter-003.xhtml"]
    assert made["a"].contents == ["封面", "n", "n", "原剧本第 1 页", "INT &lt;A&gt;", "原剧本第 2 页", "原剧本第 10 页"]
    assert made["b"].spine == ["cover.xhtml"] and made[None].spine == ["cover.xhtml", "chapter-001.xhtml", "chapter-002.xhtml"]
    content = {r.book: bytes(r.content) for r in files.collect()}
    archive = zipfile.ZipFile(io.BytesIO(content["a"]))
    assert archive.infolist()[0].compress_type == zipfile.ZIP_STORED and archive.read("mimetype") == b"application/epub+zip"
    assert len(archive.read("chapter-002.xhtml")) > 1 << 20 and "own" in zipfile.ZipFile(io.BytesIO(content["b"])).read("cover.xhtml").decode()
    assert books.save(files, str(tmp_path / "out")) == 3 and (tmp_path / "out/a.epub").read_bytes() == content["a"]
    assert books.epub_files(books.sections(spark.createDataFrame([], ROWS), "n")).count() == 0


def test_broken_files_are_refused(spark, tmp_path):
    empty = books._Writer("b", "t", "s", "l").finish()
    other = io.BytesIO()
    zipfile.ZipFile(other, "w").close()
    assert [books.check(c)[0] for c in (b"", empty, other.getvalue())] == ["not readable: BadZipFile", "spine is empty", "required files missing"]
    with pytest.raises(ValueError, match="spine is empty"):
        books.save(spark.createDataFrame([("b", bytearray(empty))], "book string, content binary"), str(tmp_path))
