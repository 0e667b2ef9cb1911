import io
import os
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from folioframe.operators import structure
from folioframe.sources import files, sinks

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def docx(body):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{body}</w:body></w:document>")
        z.writestr("word/_rels/document.xml.rels", '<Relationships><Relationship Id="r1" Target="http://example.org/"/></Relationships>')
    return out.getvalue()


BODY = (
    '<w:p><w:pPr><w:pStyle w:val="Heading2"/></w:pPr><w:r><w:t>Title</w:t></w:r></w:p><w:p></w:p>'
    '<w:p><w:r><w:rPr><w:b/></w:rPr><w:t>bold</w:t></w:r><w:r><w:t xml:space="preserve"> and </w:t></w:r><w:r><w:rPr><w:i/></w:rPr><w:t>slanted</w:t></w:r><w:hyperlink r:id="r1"><w:r><w:t>link</w:t></w:r></w:hyperlink></w:p>'
    '<w:p><w:pPr><w:numPr><w:ilvl w:val="0"/></w:numPr></w:pPr><w:r><w:t>a</w:t></w:r></w:p><w:p><w:pPr><w:numPr><w:ilvl w:val="1"/></w:numPr></w:pPr><w:r><w:t>b</w:t></w:r></w:p>'
    "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>1</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>2</w:t></w:r></w:p></w:tc></w:tr></w:tbl>"
)


def test_word_files(spark, tmp_path):
    (tmp_path / "good.docx").write_bytes(docx(BODY))
    (tmp_path / "bad.docx").write_bytes(b"no zip")
    got = {os.path.basename(r.path): r for r in files.docx_files(spark, str(tmp_path)).collect()}
    assert got["good.docx"].markdown_content == "## Title\n\n**bold** and *slanted*[link](http://example.org/)\n\n- a\n  - b\n\n| 1 | 2 |"
    assert got["good.docx"].success and got["good.docx"].markdown_words == 14 and not got["bad.docx"].success and "BadZipFile" in got["bad.docx"].error_message
    rows = spark.createDataFrame([("x", bytearray(docx(BODY))), ("n", None)], "name string, content binary")
    assert [r.success for r in files.convert_docx(rows, name="name", content="content").orderBy("name").collect()] == [False, True]
    assert files.docx_paragraphs(docx(BODY))[:2] == ["Title", "bold and slantedlink"]


def test_spreadsheets_go_by_relation_and_round_trip(spark, tmp_path):
    data = sinks.diff_workbook(["k", "diff", "style"], [("1", "ADDED", "green"), (None, "a\x00b", "plain")])
    (tmp_path / "a.xlsx").write_bytes(data)
    assert files.xlsx_sheets(data) == {"diff": [["k", "diff"], ["1", "ADDED"], ["", "ab"]]}
    rows = files.xlsx_rows(spark, str(tmp_path))
    assert files.xlsx_table(rows, "diff").columns == ["k", "diff"] and files.xlsx_table(rows, "diff").count() == 2
    out = io.BytesIO()
    s = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {s}><sheets><sheet name="first" r:id="b"/><sheet name="second" r:id="a"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="a" Target="worksheets/sheet1.xml"/><Relationship Id="b" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
        for n in (1, 2):
            z.writestr(f"xl/worksheets/sheet{n}.xml", f'<worksheet {s}><sheetData><row><c r="B1"><v>{n}</v></c></row></sheetData></worksheet>')
    assert files.xlsx_sheets(out.getvalue()) == {"first": [[None, "2"]], "second": [[None, "1"]]}


def test_text_files_and_stale_ones(spark, tmp_path):
    (tmp_path / "a.md").write_text("é\r\nx")
    (tmp_path / "b.html").write_bytes(b"\xff\xfe")
    (tmp_path / "c.html").write_text("ok")
    assert files.text_files(spark, str(tmp_path)).first().text == "é\r\nx"
    assert {os.path.basename(r.path): r.readable for r in files.readable_files(spark, str(tmp_path)).collect()} == {"b.html": False, "c.html": True}
    old = time.time() - 40 * 60
    os.utime(tmp_path / "a.md", (old, old))
    assert [os.path.basename(r.path) for r in files.stale_files(spark, str(tmp_path), 0.5).collect()] == ["a.md"] and files.stale_files(spark, str(tmp_path), 1).count() == 0
    files.delete_stale(spark, str(tmp_path), 0.5)
    assert not (tmp_path / "a.md").exists() and (tmp_path / "c.html").exists()
    with pytest.raises(Exception):
        files.text_files(spark, str(tmp_path / "missing")).count()


def test_settings(tmp_path, monkeypatch):
    (tmp_path / ".env").write_text("# c\nA=1\nB='two'\nZ=3\n")
    monkeypatch.setenv("C", "env")
    assert files.settings(str(tmp_path / ".env"), {"A": "0", "B": "", "C": "", "D": "d"}) == {"A": "1", "B": "two", "C": "env", "D": "d"}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    where = str(tmp_path / "out")
    assert sinks.write_json_version(df, where) == "" and sinks.write_json_version(df, where).startswith(where + ".backup-")
    assert len(list(tmp_path.iterdir())) == 2 and spark.read.json(where).count() == 1
    names = spark.createDataFrame([("a.md", "é"), ("b.md", None)], "n string, t string")
    got = {r.name: r.bytes for r in sinks.write_markdown_files(names, f"file://{tmp_path}/md", name="n", text="t").collect()}
    assert got == {"a.md": 2, "b.md": 0} and (tmp_path / "md" / "a.md").read_text() == "é"
    assert sinks.output_paths("/r/", "/x/doc.v1.md")["result"] == "/r/output/doc.v1_survey.json"
    chunks = spark.createDataFrame([(1, 0, "# A"), (1, 1, "b")], "doc_id int, chunk_index int, chunk string")
    assert '"total_chunks":2' in sinks.structure_map_json(structure.structure_map(chunks)).first().structure_map
    assert sinks.debug_dump(chunks).orderBy("filename").first().text.startswith("<!-- chunk: 0 -->")
    sinks.write_checkpoints(spark.createDataFrame([("s", "section", "2024-01-01"), ("t", "element", "2024-02-01")], "session_id string, cp_type string, saved_at string"), str(tmp_path / "cp"))
    assert [r.session_id for r in files.sessions(spark, str(tmp_path / "cp")).collect()] == ["t", "s"]
    assert sinks.write_diff_workbook(spark.createDataFrame([(1, "ADDED")], "k int, diff string"), str(tmp_path / "d.xlsx")) and not sinks.write_diff_workbook(spark.createDataFrame([(1, "ADDED"), (2, None)], "k int, diff string"), str(tmp_path / "d.csv"), most=1)
