"""The PDF source on small files written here."""

import zlib

from scriptorium.sources import pdf


def write(path, pages, flate=False, fonts="/F1 90 0 R"):
    """A file with one content stream a page; ``pages`` holds the streams."""
    n = len(pages)
    objects = [b"1 0 obj\n<< /Type /Catalog /Pages 2 0 R >>\nendobj", b"2 0 obj\n<< /Type /Pages /Kids [%s] /Count %d >>\nendobj" % (b" ".join(b"%d 0 R" % (10 + 2 * k) for k in range(n)), n)]
    objects.append(b"90 0 obj << /Type /Font /BaseFont /ABCDEF+Courier-BoldOblique >> endobj")
    for k, content in reversed(list(enumerate(pages))):  # out of order: the tree decides
        objects.append(b"%d 0 obj << /Type /Page /Parent 2 0 R /Resources << /Font << %s >> >> /Contents [%d 0 R] >> endobj" % (10 + 2 * k, fonts.encode(), 11 + 2 * k))
        data = zlib.compress(content) if flate else content
        objects.append(b"%d 0 obj << /Length %d %s >>\nstream\n" % (11 + 2 * k, len(data), b"/Filter /FlateDecode" if flate else b"") + data + b"\nendstream\nendobj")
    path.write_bytes(b"%PDF-1.4\n" + b"\n".join(objects) + b"\n%%EOF")


PAGE = rb"""BT /F1 12 Tf 1 0 0 1 220 700 Tm (ANNA \(CONT'D\)) Tj 0 -20 Td [(Hel) -20 (lo)] TJ 1 0 0 1 260 680 Tm (you\041) Tj ET
BT 1 0 0 1 36 640 Tm (12) Tj 1 0 0 1 560 640 Tm (12) Tj 1 0 0 1 36 640 Tm (12) Tj ET
q 1 0 0 -1 0 792 cm BT 1 0 0 -1 100 192 Tm <466C6970> Tj ET Q BT (nowhere) Tj ET BT 1 0 0 1 540 750 Tm (3.) Tj ET"""


def test_ops_rows_lines_and_markers(spark, tmp_path):
    for flate in (False, True):
        write(tmp_path / f"{flate}.pdf", [PAGE, b"", b"BT 1 0 0 1 100 500 Tm (third) Tj ET"], flate)
    (tmp_path / "broken.pdf").write_bytes(b"%PDF-1.4 1 0 obj << /Type /Page /Contents 2 0 R >> endobj 2 0 obj << /Filter /FlateDecode /Length 3 >> stream\nabc\nendstream endobj (((")
    (tmp_path / "empty.pdf").write_bytes(b"")
    ops = pdf.text_ops(spark, str(tmp_path)).cache()
    assert {r[0].rsplit("/", 1)[1] for r in ops.select("path").collect()} == {"False.pdf", "True.pdf"}
    one = ops.filter("path like '%True.pdf'").orderBy("pdf_page", "op_seq").collect()
    assert [(r.text, r.x, r.y, r.source_layer) for r in one] == [
        ("ANNA (CONT'D)", 220, 700, "normal"), ("Hello", 220, 680, "normal"), ("you!", 260, 680, "normal"), ("12", 36, 640, "normal"), ("12", 560, 640, "normal"), ("12", 36, 640, "normal"),
        ("Flip", 100, 600, "flipped"), ("3.", 540, 750, "normal"), ("third", 100, 500, "normal"),
    ]
    assert one[0].styles == ["bold", "italic"] and one[3].styles == [] and one[-1].pdf_page == 3
    lines = pdf.source_lines(pdf.text_rows(ops), 1).filter("path like '%False.pdf'")
    got = lines.orderBy("pdf_page", "line_no").collect()
    assert [(r.text, r.zone, r.parts) for r in got] == [("3.", "page_number", 1), ("ANNA (CONT'D)", "body", 1), ("Hello you!", "body", 2), ("12 12", "margin", 2), ("Flip", "body", 1), ("third", "body", 1)]
    assert got[0].display_page == 0
    marks = pdf.marker_types(pdf.text_rows(ops).withColumn("display_page", pdf.F.col("pdf_page")).withColumn("zone", pdf.F.lit("margin"))).filter("path like '%False.pdf'")
    # "3." in a margin has a digit but is no run of digits, so the surveyed rule (P08) makes it a split number
    assert sorted((r.type, r.position) for r in marks.collect()) == [("contd", None), ("scene_no", "left"), ("scene_no", "right"), ("split_scene", "right")]


def test_lines_shuffle_fragments_once(spark):
    """Spans travel with their fragments, in one exchange; ties of place go by the order of the style sets, and foreign spans keep touching ones apart."""
    from pyspark.sql import functions as F

    from scriptorium.operators import fragments

    assert fragments.SETS == sorted(fragments.SETS) and len(fragments.SETS) == 8
    schema = "doc int, seq int, x double, y double, text string, spans array<struct<start:int,end:int,styles:array<string>>>"
    b, i, none = ["bold"], ["italic", "shadow"], []
    rows = [(1, 0, 1.0, 9.0, "abcd", [(0, 2, b), (2, 4, b)]), (1, 1, 2.0, 9.1, "ef", [(0, 1, b), (0, 1, i), (1, 2, none)]), (1, 2, 50.0, 9.0, None, None), (2, 0, 1.0, 9.0, "x", [])]
    out = fragments.lines_of(spark.createDataFrame(rows, schema), ["doc"])
    got = {r.doc: (r.text, r.parts, r.s) for r in out.select("doc", "text", "parts", fragments.styled(F.col("spans")).alias("s")).collect()}
    assert got == {1: ("abcdef ", 3, "0-5:bold,4-5:italic"), 2: ("x", 1, "")}
    assert out._jdf.queryExecution().sparkPlan().toString().count("Exchange") == 0 and out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1


def test_first_lines_shuffle_lines_not_words(spark, tmp_path):
    """Fragments are made after the only shuffle and never sorted as rows; rows are those of the SQL, with long lines that meet, empty ones and null texts."""
    import duckdb

    from scriptorium.plans import layout

    long = lambda n, w: " ".join(w[k % len(w)] * (k % 3 + 1) for k in range(n))
    texts = [None, "", "one", "\n\n", " a  b ", "12.", long(300, "abc") + "\n" + long(250, "xyü") + "\n" + long(7, "q") + "\n" + long(130, "r"), "\n".join(long(k, "mn") for k in range(1, 40))]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "doc_id long, text string").coalesce(1).write.parquet(path)
    out = layout.g01(spark, str(tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert (plan.count("Exchange hashpartitioning"), plan.count("Generate "), plan.count("Window"), plan.count("Sort ")) == (1, 1, 0, 0)
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
        want = con.execute(layout.SQL["G01_first_lines"]).fetchall()
    assert len(want) > 30 and sorted(map(tuple, out.collect())) == sorted(want)
