"""Readers on fixtures built in memory."""

import gzip
import io
import json
import zipfile

import pytest

from specloom.sources.documents import (
    bullets, colon_rows, component_rows, document_kind, extract, layout_tables, matrix_columns, office_tables, panel_rows, parsed_literals, script_literal, stream_section, unpack,
)
from specloom.sources.html import pages, parse_page
from specloom.sources.readers import binary_files, delimited, document_tables, json_lines, table_or_empty
from specloom.sources.web import parse_api, parse_robots, parse_sitemap, robots_allow, robots_allowed, sitemaps

PAGE = """<html><head><title>T</title><link rel=canonical href="/c"></head><body><nav><a href="/x">X</a></nav>
<div class="breadcrumb"><a href="/">Home</a><a href="/p">Power</a></div><h1>Unit</h1><h2>Specifications</h2>
<table><tr><th colspan=2>Main</th></tr><tr><td>Weight<td rowspan="0">5 kg<sup>1</sup></tr><tr><td>Power</td><td>3<table><tr><td>in</td></tr></table></td></tr></table>
<p>1 with cover</p><p><a href="b.pdf#p">sheet</a></p><script>var a="<table>"</script></body></html>"""


def archive(**parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name.replace("__", "/").replace("_DOT_", "."), text)
    return out.getvalue()


def zipped(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
REL = "http://schemas.openxmlformats.org/package/2006/relationships"


def word_cell(text, props=""):
    return f"<w:tc>{f'<w:tcPr>{props}</w:tcPr>' if props else ''}" + "".join(f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>" for t in text.split("|")) + "</w:tc>"


def word_table(*rows):
    return "<w:tbl>" + "".join(f"<w:tr>{''.join(r)}</w:tr>" for r in rows) + "</w:tbl>"


# Two tables with text between them; in the second, spans inside a merged column.
DOCX = zipped({
    "word/document.xml": f"<w:document {W}><w:body>"
    + word_table([word_cell("Rating"), word_cell("first line|second line")])
    + "<w:p><w:r><w:t>between</w:t></w:r></w:p>"
    + word_table([word_cell("Loads", '<w:vMerge w:val="restart"/>'), word_cell("wide", '<w:gridSpan w:val="3"/>')], [word_cell("", "<w:vMerge/>"), word_cell("a"), word_cell("b", '<w:gridSpan w:val="2"/>')])
    + "</w:body></w:document>",
})
S = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
# The sheets' order in the book is not that of their files.
XLSX = zipped({
    "xl/workbook.xml": f'<workbook {S}><sheets><sheet name="Front" sheetId="9" r:id="x2"/><sheet name="Back" sheetId="4" r:id="x1"/><sheet name="Blank" sheetId="5" r:id="x3"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{REL}"><Relationship Id="x1" Target="worksheets/sheet1.xml"/><Relationship Id="x2" Target="worksheets/sheet7.xml"/></Relationships>',
    "xl/sharedStrings.xml": f"<sst {S}><si><t>unused</t></si><si><r><t>Flow </t></r><r><t>rate</t></r></si></sst>",
    "xl/worksheets/sheet1.xml": f'<worksheet {S}><sheetData><row r="4"><c r="AB4"><v>12.5</v></c></row></sheetData></worksheet>',
    "xl/worksheets/sheet7.xml": f'<worksheet {S}><sheetData><row><c r="C2" t="s"><v>1</v></c><c r="E2" t="inlineStr"><is><t>m3/h</t></is></c></row><row><c r="C3"><f>SUM(A1:A2)</f><v>7</v></c></row></sheetData><mergeCells><mergeCell ref="C2:D4"/></mergeCells></worksheet>',
})
A, P = "http://schemas.openxmlformats.org/drawingml/2006/main", "http://schemas.openxmlformats.org/presentationml/2006/main"
PPTX = zipped({
    "ppt/presentation.xml": f'<p:presentation xmlns:p="{P}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><p:sldIdLst><p:sldId id="300" r:id="s2"/><p:sldId id="256" r:id="s1"/></p:sldIdLst></p:presentation>',
    "ppt/_rels/presentation.xml.rels": f'<Relationships xmlns="{REL}"><Relationship Id="s1" Target="slides/slide1.xml"/><Relationship Id="s2" Target="slides/slide2.xml"/></Relationships>',
    "ppt/slides/slide1.xml": f'<p:sld xmlns:p="{P}" xmlns:a="{A}"><a:tbl><a:tr><a:tc gridSpan="2"><a:txBody><a:p><a:r><a:t>Mass</a:t></a:r></a:p></a:txBody></a:tc><a:tc hMerge="1"><a:txBody/></a:tc></a:tr></a:tbl></p:sld>',
    "ppt/slides/slide2.xml": f'<p:sld xmlns:p="{P}" xmlns:a="{A}"/>',
})


def test_page():
    p = parse_page(PAGE, "https://a.example/p/")
    assert (p["title"], p["heading"], p["canonical"], p["breadcrumbs"]) == ("T", "Unit", "https://a.example/c", ["Home", "Power"])
    assert [(x["url"], x["context"]) for x in p["links"]][-1] == ("https://a.example/p/b.pdf", "page_body") and p["links"][0]["context"] == "site_navigation"
    main, inner = p["tables"]
    assert main["section"] == "Main" and main["is_specification"]
    assert main["rows"][0][1] == {"text": "5 kg^{1}", "header": False, "colspan": 1, "rowspan": 1} and main["rows"][1][1]["text"] == "3"
    assert inner["notes"].startswith("1 with cover")
    assert parse_page(None) is None and parse_page("")["tables"] == [] and parse_page("<div>" * 5000)["links"] == []


def test_pages_as_table(spark):
    df = spark.createDataFrame([("s1", PAGE, "https://a/"), ("s1", PAGE, "https://a/"), ("s2", None, None)], "sha string, html string, url string")
    got = {r.sha: r.page for r in pages(df, "sha", "html", "url").collect()}
    assert len(got) == 2 and got["s2"] is None and got["s1"].tables[0].rows[0][0].text == "Weight"


def test_office_and_kinds():
    first, second = office_tables(DOCX, "docx")
    assert [c["text"] for c in first["rows"][0]] == ["Rating", "first line second line"]
    assert [(c["colspan"], c["vertical_merge"]) for r in second["rows"] for c in r] == [(1, "restart"), (3, None), (1, "continue"), (1, None), (2, None)]
    front, back = office_tables(XLSX, "xlsx")
    assert (front["section"], back["section"]) == ("Front", "Back") and back["rows"][0][0]["coordinate"] == "AB4"
    assert [(c["text"], c["colspan"], c["rowspan"]) for c in front["rows"][0]] == [("Flow rate", 2, 3), ("m3/h", 1, 1)] and front["rows"][1][0]["formula"] == "SUM(A1:A2)"
    (slide,) = office_tables(PPTX, "pptx")
    assert slide["section"] == "slide 2" and [(c["text"], c["colspan"], c["hMerge"]) for c in slide["rows"][0]] == [("Mass", 2, 0), ("", 1, 1)]
    assert [document_kind(b, u) for b, u in ((DOCX, ""), (XLSX, ""), (PPTX, ""), (b"%PDF-1.4 x %%EOF", ""), (b"%PDF-1.4 cut", ""), (b"<html>", ""), (b"{}", ""), (b"a,b", "x.csv?y"), (b"", ""), (None, ""), (b"\x1f\x8b", ""))] == [
        "docx", "xlsx", "pptx", "pdf", None, "html", "json", "csv", None, None, "gzip"]
    assert extract(DOCX, "docx")["status"] == "extracted" and extract(b"PK\x03\x04", "docx")["status"] == "failed" and extract(None, None)["status"] == "unreadable"
    evil = zipped({"word/document.xml": "<!DOCTYPE x><w/>"})
    assert extract(evil, "docx")["status"] == "failed"
    assert unpack(gzip.compress(b"x" * 100)) == b"x" * 100 and unpack(gzip.compress(b"x" * 100), 50) is None


def test_large_pages():
    page = b"<html><table><tr><td>Weight</td><td>5</td></tr></table>" + b"x" * (17 << 20) + b"</html>"
    got = extract(page, "html")
    assert got["status"] == "extracted" and [[c["text"] for c in r] for r in got["tables"][0]["rows"]] == [["Weight", "5"]]
    assert extract(gzip.compress(page)[:-9], "html")["status"] == "failed"
    assert extract(page + b" " * (112 << 20), "html")["status"] == "failed"


def test_layout_text():
    text = "Ratings\nModel   A1   A2\nPower  10 kW  20 kW\nWeight   5   6\nDepth  7  8\n* at 25 C\n\nplain text\fNext\nOnly  1\n"
    t = layout_tables(text)
    assert len(t) == 1 and t[0]["section"] == "Ratings" and t[0]["notes"] == "* at 25 C" and len(t[0]["rows"]) == 4
    assert matrix_columns(["Label      A1      A2", "Power      10      20", "Mass                5"]) == [("A1", [("Power", "10")]), ("A2", [("Power", "20"), ("Mass", "5")])]
    assert bullets("• one\n  more\n• two\nx") == ["one more", "two"]
    assert panel_rows("left                    Label   value\n                                 more\n                    Lone", 20)[0] == ("Label", "value more")
    assert colon_rows("A: 1\nno\n:x\n" + "y" * 90 + ": 2") == [("A", "1")]


def test_records():
    rows, status = component_rows(json.dumps({"response-code": "200", "details": [{"name": " a ", "value": "1"}, {"name": "a", "value": "1"}, {"name": "", "value": "2"}, {"name": "n", "value": 3}]}))
    assert rows == [("a", "1")] and status == "extracted"
    for other in ('{"response-code":500,"details":[{"name":"a","value":"1"}]}', '{"response-code":200}', "x", "[1]", "{}"):
        assert component_rows(other) == ([], "nothing_stated")
    assert component_rows('{"code": 200, "rows": [{"name": "a", "value": "b"}]}', "rows", "code")[0] == [("a", "b")]
    assert script_literal("{a:'x\"y',b:[1,!0],\"c\":{d:null}}") == {"a": 'x"y', "b": [1, True], "c": {"d": None}}
    with pytest.raises(ValueError):
        script_literal("{a:f()}")
    assert parsed_literals("x=JSON.parse('{\"a\":1}');JSON.parse('{bad')") == [{"a": 1}]
    assert stream_section(["1:T5,äbc", "2:rest"], "1") == "äbc2" and stream_section(["7:line\n8:x"], "7") == "line"


def test_web(spark):
    body = '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> https://a/1 </loc><lastmod>2026-01-01</lastmod></url><url><lastmod>x</lastmod></url></urlset>'
    got = parse_sitemap(body)
    assert got["entries"] == [{"loc": "https://a/1", "lastmod": "2026-01-01"}] and got["problem"] == "entry without loc"
    assert [parse_sitemap(b)["problem"] for b in (None, "<x", "<!DOCTYPE a><urlset/>", "<urlset/>", "<html/>")] == ["empty", "not well-formed", "declares a document type", "no entries", "unknown root"]
    df = spark.createDataFrame([("k", body)], "k string, b string")
    assert sitemaps(df, "k", "b").first().sitemap.entries[0].loc == "https://a/1"
    robots = "User-agent: *\nDisallow: /\n\nUser-agent: loom\nUser-agent: other\nDisallow: /a*b$\nAllow: /a/open\nDisallow: /a/\nCrawl-delay: 2\nDisallow:\nSitemap: https://a/s.xml"
    r = parse_robots(robots, "specLoom/1")
    assert r["delay"] == 2.0 and r["sitemaps"] == ["https://a/s.xml"]
    assert [robots_allow(r["rules"], u) for u in ("https://h/a/x", "https://h/a/open/1", "https://h/axb", "https://h/axbc", "https://h/")] == [False, True, False, True, True]
    assert robots_allow([(True, "/x"), (False, "/x")], "https://h/x")
    df = spark.createDataFrame([("https://h/a/x", robots), ("https://h/a/x", None), (None, robots)], "u string, r string")
    assert [x.allowed for x in robots_allowed(df, "u", "r", "loom").collect()] == [False, True, None]
    api = parse_api(json.dumps({"info": {"title": "T"}, "paths": {"/b": {"get": {"tags": ["x", 1]}, "note": {}}, "/a": {"post": None}}}))
    assert [(e["path"], e["method"]) for e in api["endpoints"]] == [("/a", "post"), ("/b", "get")] and api["tags"] == ["x"] and api["methods"] == {"post": 1, "get": 1}
    assert parse_api("[")["endpoints"] == []


def test_files(spark, tmp_path):
    (tmp_path / "a.docx").write_bytes(DOCX)
    (tmp_path / "b.docx").write_bytes(DOCX)
    (tmp_path / "c.bin").write_bytes(b"zz")
    got = document_tables(binary_files(spark, str(tmp_path))).collect()
    assert sorted((r.kind or "-", r.status) for r in got) == [("-", "unreadable"), ("docx", "extracted")]
    (tmp_path / "j.jsonl").write_text('{"a": 1}\n{bad\n')
    good, bad = json_lines(spark, str(tmp_path / "j.jsonl"), "a int")
    assert [r.a for r in good.collect()] == [1] and bad.count() == 1
    (tmp_path / "m.tsv").write_text("product\tunit\np\t-\n")
    assert tuple(delimited(spark, str(tmp_path / "m.tsv"), "product string, unit string").first()) == ("p", None)
    assert table_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0


def test_csv_with_quotes():
    got = extract(b'\xef\xbb\xbfa,"b, c",d\r\n\r\n"two\nlines",2\n', "csv")
    assert [[c["text"] for c in r] for r in got["tables"][0]["rows"]] == [["a", "b, c", "d"], ["two\nlines", "2"]]


def test_damaged_files_are_reported():
    """A workbook whose cell names a string that is not there, and a file whose compressed part is no stream, are failures of their own."""
    parts = {n: zipfile.ZipFile(io.BytesIO(XLSX)).read(n).decode() for n in zipfile.ZipFile(io.BytesIO(XLSX)).namelist()}
    got = extract(zipped(parts | {"xl/sharedStrings.xml": f"<sst {S}/>"}), "xlsx")
    assert got["status"] == "failed" and "string 1 of 0" in got["uncertainty"] and got["tables"] == []
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("word/document.xml", "<w/>" * 500)
    broken = bytearray(out.getvalue())
    at = broken.index(b"word/document.xml") + len("word/document.xml")
    broken[at : at + 12] = b"\xff" * 12
    assert extract(bytes(broken), "docx")["status"] == "failed"
