import io
import tempfile
import zipfile
from email.message import EmailMessage

import pytest

from claimlake.operators import locate
from claimlake.sources import intake, office


def files(spark, rows):
    return spark.createDataFrame([(p, bytearray(c)) for p, c in rows], "path string, content binary")


def test_registry_and_quarantine(spark):
    rows = {r.filename: r for r in intake.ingest(files(spark, [
        ("/a/n.md", b"first line\n\nthird line\n"), ("/a/p.html", b"<style>x{}</style><script>var t='</p>';</script><p>One &amp; two</p><p>Three</p>"),
        ("/a/z.xyz", b"x"), ("/a/e.txt", b""), ("/a/b.txt", b"a\x00b"), ("/a/bad.txt", b"\xff\xfe\xfd\xfc"), ("/a/pic.png", b"\x89PNG"),
    ]), "r", "t").collect()}
    assert rows["p.html"].text == "One & two\nThree"
    assert rows["n.md"].normalization_status == "success" and rows["n.md"].normalized_line_count == 4
    assert {n: r.warnings for n, r in rows.items() if r.normalization_status != "success"} == {"z.xyz": ["unsupported file type"], "e.txt": ["no text"], "b.txt": ["binary content"], "bad.txt": ["undecodable content"]}
    assert rows["pic.png"].text.startswith("[[IMAGE pic.png]]")


def test_references_without_a_semicolon(spark):
    """``html_normalize`` leaves them, as its SQL does; files are read as browsers read them."""
    import duckdb
    from pyspark.sql import functions as F

    from claimlake import queries

    cut = "<h1>a &amp;&amp; b&amp</h1><p>&am &copy 1 &middot; &copy;&quot;x&quot; &ampcopy;</p>&amp"
    with tempfile.TemporaryDirectory() as d:
        spark.createDataFrame([(1, "u", cut)], "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
        got = [tuple(r) for r in queries.html_normalize(spark, d).collect()]
        con = duckdb.connect()
        con.execute(f"CREATE VIEW pages AS SELECT * FROM '{d}/pages.parquet/*.parquet'")
        assert got == con.execute(queries.ORACLES["html_normalize"]).fetchall()
    row = spark.createDataFrame([(cut,)], "h string").select(intake.html_text(F.col("h")).alias("all"), intake.html_text(F.col("h"), ended_only=True).alias("ended")).first()
    assert row.all == 'a && b&\n&am © 1 · ©"x" &copy;\n&' and row.ended == 'a && b&amp\n&am &copy 1 · ©"x" &ampcopy;\n&amp'


def test_same_source_twice_is_refused_but_same_name_is_not(spark):
    reg = intake.ingest(files(spark, [("/a/n.md", b"x"), ("/b/n.md", b"x"), ("/c/n.md", b"y")]), "r", "t")
    assert intake.duplicate_sources(reg).count() == 1
    with pytest.raises(ValueError, match="same source"):
        intake.refuse_duplicates(reg)
    intake.refuse_duplicates(intake.ingest(files(spark, [("/a/n.md", b"x"), ("/b/n.md", b"y")]), "r", "t"))


def test_email_with_attachment():
    m = EmailMessage()
    m["From"], m["Subject"] = "a@example.org", "hi"
    m.set_content("the body\n")
    m.add_attachment(b"1", maintype="application", subtype="pdf", filename="r.pdf")
    assert office.email_text(m.as_bytes()) == "From: a@example.org\nSubject: hi\n\nthe body\n\n[[ATTACHMENTS r.pdf]]"


def zipped(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, xml in parts.items():
            z.writestr(name, xml)
    return out.getvalue()


W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
A = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'
S = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def test_office_files():
    doc = f"<w:document {W}><w:body><w:p><w:r><w:t>Intro</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>"
    assert office.parse("x.docx", zipped({"word/document.xml": doc})) == "Intro\na | b"
    slide = f"<p {A}><a:p><a:r><a:t>Title</a:t></a:r></a:p></p>"
    assert office.parse("x.pptx", zipped({"ppt/slides/slide1.xml": slide, "ppt/notesSlides/notesSlide1.xml": slide.replace("Title", "say")})) == "[[SLIDE 1]]\nTitle\n[[NOTES]] say"
    book = f'<workbook {S}><sheets><sheet name="One"/></sheets></workbook>'
    sheet = f'<worksheet {S}><sheetData><row><c t="s"><v>0</v></c><c><v>7</v></c></row><row><c/></row></sheetData></worksheet>'
    assert office.parse("x.xlsx", zipped({"xl/workbook.xml": book, "xl/worksheets/sheet1.xml": sheet, "xl/sharedStrings.xml": f"<sst {S}><si><t>k</t></si></sst>"})) == "[[SHEET One]]\nk | 7"
    assert office.parse("x.docx", b"no zip") is None and office.parse("x.pdf", b"") is None


def test_jsonl_strict_and_tolerant(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"call_id":"a","response":"1","at":1}\n\n{"call_id":"a","response":"2","at":2}\nnot json\n')
    assert intake.read_jsonl(spark, str(p), "call_id string, response string, at long", strict=False).count() == 2
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        intake.read_jsonl(spark, str(p), "call_id string, response string, at long").collect()
    from claimlake.plans import models

    assert [tuple(r) for r in models.responses(spark, str(p)).collect()] == [("a", "2")]


def test_locator_map_markers_and_offsets(spark):
    text = "[[PAGE 1]]\nfirst é😀\n\n[[PAGE 2]]\nlast"
    rows = locate.locator_map(spark.createDataFrame([("s", text)], "source_id string, text string")).orderBy("segment_id").collect()
    assert [r.segment_id for r in rows] == [f"seg-s-{i:05d}" for i in range(4)]
    assert [text[r.normalized_char_start : r.normalized_char_end] for r in rows] == ["[[PAGE 1]]", "first é😀", "[[PAGE 2]]", "last"]
    assert [r.page for r in rows] == [1, 1, 2, 2]
    spans = locate.page_spans(locate.locator_map(spark.createDataFrame([("s", text)], "source_id string, text string"))).orderBy("page").collect()
    assert [(r.page, r.char_start, r.char_end) for r in spans] == [(1, 0, 19), (2, 21, len(text))]
