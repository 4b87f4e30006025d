"""Converters on small files made here, and readers and sinks on a small tree."""

import io
import json
import zipfile

from pyspark.sql import functions as F

from folioscope.sources import convert, markup, office, sinks

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
S = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def _docx():
    body = (
        '<w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>Top</w:t></w:r></w:p>'
        '<w:p><w:r><w:rPr><w:b/></w:rPr><w:t>bold</w:t></w:r><w:r><w:t xml:space="preserve"> and </w:t></w:r><w:hyperlink r:id="r1"><w:r><w:t>link</w:t></w:r></w:hyperlink><w:del><w:r><w:delText>gone</w:delText></w:r></w:del><w:r><w:footnoteReference w:id="2"/></w:r></w:p>'
        '<w:tbl><w:tr><w:tc><w:p><w:r><w:t>a|b</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>c</w:t></w:r></w:p></w:tc></w:tr><w:tr><w:tc><w:p><w:r><w:t>d</w:t></w:r></w:p></w:tc></w:tr></w:tbl>'
        '<w:p><w:r><w:pict><v:rect xmlns:v="urn:v"/></w:pict></w:r></w:p>'
    )
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{body}</w:body></w:document>")
        z.writestr("word/_rels/document.xml.rels", '<Relationships><Relationship Id="r1" Type="x/hyperlink" Target="http://e.example"/></Relationships>')
        z.writestr("word/footnotes.xml", f'<w:footnotes {W}><w:footnote w:id="2"><w:p><w:r><w:t>note</w:t></w:r></w:p></w:footnote></w:footnotes>')
    return out.getvalue()


def _xlsx():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {S}><sheets><sheet name="One" r:id="r1"/><sheet name="Two" state="hidden" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/s1.xml"/><Relationship Id="r2" Target="worksheets/s2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {S}><si><t>x|y</t></si></sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {S}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/s1.xml", f'<worksheet {S}><sheetData><row><c r="B2" t="s"><v>0</v></c><c r="C2" s="1"><v>45292</v></c></row><row><c r="B3"><f>SUM(1,2)</f><v>3</v></c></row></sheetData><mergeCells><mergeCell ref="B3:C3"/></mergeCells></worksheet>')
        z.writestr("xl/worksheets/s2.xml", f'<worksheet {S}><sheetData><row><c r="A1" t="b"><v>1</v></c></row></sheetData></worksheet>')
    return out.getvalue()


def test_html():
    page = "<html><head><title>T</title><meta name=author content=Me><script>x()</script></head><body><p>a <b>bold</b> <a href='/u'>link</a></p><ul><li>one<ol><li>in</li></ol></li><li>two</ul><table><tr><th>h<th>i<tr><td><b>c</b>|</td></tr></table><pre>x\n y</pre><blockquote>q</blockquote></body></html>"
    meta, body = markup.html_to_markdown(page)
    assert meta == {"title": "T", "author": "Me"}
    for part in ("# T", "a **bold** [link](/u)", "- one\n  1. in\n- two", "| h | i |", "| **c**\\| |", "```\nx\n y\n```", "> q"):
        assert part in body, (part, body)
    assert "x()" not in body
    assert markup.html_to_markdown(None) == ({}, "\n")


def test_deep_html_does_not_break():
    assert "x" in markup.html_to_markdown("<div>" * 150 + "x" + "</div>" * 150)[1]
    markup.html_to_markdown("<span>" * 3000 + "x")


def test_rtf():
    data = b"{\\rtf1\\ansi\\ansicpg1252{\\fonttbl{\\f0 X;}}\\fs48 Head\\par\\fs24 plain \\b bold\\b0  caf\\'e9 " + b"\\u8212? end\\par}"
    meta, body = markup.rtf_to_markdown(data)
    assert body == "# Head\n\nplain **bold** café — end\n" and meta["word_count"] == 5
    assert markup.rtf_to_markdown(b"") == ({"word_count": 0}, "")
    marked = b'{\\rtf1 see {\\field{\\*\\fldinst HYPERLINK "http://e.example/a"}{\\fldrslt the \\b page\\b0}} and \\ul under\\ulnone  \\strike gone\\strike0 .\\par{\\pntext o}{\\*\\pn\\pnlvlblt}one\\par\\pard plain\\par{\\*\\pn\\pnlvlbody\\pndec}first\\par}'
    assert markup.rtf_to_markdown(marked)[1] == "see [the **page**](http://e.example/a) and <u>under</u> ~~gone~~.\n\n- one\n\nplain\n\n1. first\n"


def test_docx():
    meta, body = office.docx_to_markdown(_docx())
    for part in ("# Top", "**bold** and [link](http://e.example)~~gone~~[^fn2]", "| a\\|b | c |", "| d |   |", "[^fn2]: note"):
        assert part in body, (part, body)
    assert meta["horizontal_rules"] == "1" and "unresolved_images" not in meta


def test_xlsx():
    meta, body = office.xlsx_to_markdown(_xlsx())
    for part in ("## Sheet: One", "| # | B | C |", "| 2 | x\\|y | 2024-01-01 |", "| 3 | 3 | 3 |", "- `B3`: `=SUM(1,2)`", "## Sheet: Two (hidden)", "TRUE"):
        assert part in body, (part, body)
    assert meta["sheet_count"] == "2"


def test_what_stands_beside_the_cells():
    out = io.BytesIO(_xlsx())
    with zipfile.ZipFile(out, "a") as z:
        z.writestr("xl/worksheets/_rels/s2.xml.rels", '<Relationships><Relationship Id="h1" Type="x/hyperlink" Target="http://e.example"/><Relationship Id="c1" Type="x/comments" Target="../comments1.xml"/></Relationships>')
        z.writestr("xl/comments1.xml", f'<comments {S}><authors><author>Ada</author></authors><commentList><comment ref="A1" authorId="0"><text><r><t>why?</t></r></text></comment></commentList></comments>')
    data = io.BytesIO()
    with zipfile.ZipFile(out) as old, zipfile.ZipFile(data, "w") as new:
        for name in old.namelist():
            body = old.read(name)
            new.writestr(name, body.replace(b"</worksheet>", b'<hyperlinks><hyperlink ref="A1" r:id="h1"/></hyperlinks></worksheet>') if name.endswith("s2.xml") else body)
    body = office.xlsx_to_markdown(data.getvalue())[1]
    for part in ("| 1 | [TRUE](http://e.example) |", "### Comments\n\n- **A1** — Ada: why?", "### Merged ranges\n\n- B3:C3"):
        assert part in body, (part, body)


def test_date_formats_and_far_serials():
    assert office.DATE_FORMATS >= {*range(27, 32), 36, *range(50, 59)} and not office.DATE_FORMATS & {18, 19, 20, 21}
    assert office.serial_date(1e12) == "" and office.serial_date(-3) == "" and office.serial_date(45292.5) == "2024-01-01 12:00:00"


def test_tree_of_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "_Tools").mkdir()
    (tmp_path / "a/x.html").write_text("<p>hi</p>")
    (tmp_path / "a/y.docx").write_bytes(b"no zip")
    (tmp_path / "a/z.docx").write_bytes(_docx())
    (tmp_path / "a/n.txt").write_text("text")
    (tmp_path / "_Tools/t.txt").write_text("tool")
    found = convert.content_files(convert.files(spark, str(tmp_path)))
    got = {r["path"]: r for r in convert.converted(found).collect()}
    assert set(got) == {"a/x.html", "a/y.docx", "a/z.docx", "a/n.txt"}
    assert got["a/y.docx"]["error"].startswith("ValueError") and got["a/z.docx"]["error"] is None and got["a/n.txt"]["body"] == "# n\n\ntext"
    written = convert.converted(found).filter("error is null").select(F.concat("path", F.lit(".md")).alias("path"), sinks.digest_text(F.col("meta"), F.col("body")).alias("text"))
    sinks.write_text_files(written, str(tmp_path / "out"))
    assert (tmp_path / "out/a/n.txt.md").read_text() == '---\nsource: "txt"\n---\n\n# n\n\ntext'


def test_chat_exports(spark, tmp_path):
    (tmp_path / "e/projects").mkdir(parents=True)
    conv = [{"uuid": "c", "name": "n", "chat_messages": [{"uuid": "m", "parent_message_uuid": None, "sender": "human", "created_at": "2025-01-01T00:00:00Z", "text": "hi", "content": [{"type": "text", "text": "hi"}]}]}]
    (tmp_path / "e/conversations.json").write_text(json.dumps(conv))
    (tmp_path / "e/users.json").write_text("[]")
    (tmp_path / "e/projects/p.json").write_text("{}")
    (tmp_path / "g").mkdir()
    nodes = {"conversation_id": "k", "current_node": "b", "mapping": {"a": {"parent": None, "message": None}, "b": {"parent": "a", "message": {"author": {"role": "user"}, "create_time": 1.5, "content": {"parts": ["x", "y"]}}}}}
    (tmp_path / "g/conversations.json").write_text(json.dumps([nodes]))
    (tmp_path / "g/user.json").write_text("{}")
    table = convert.files(spark, str(tmp_path))
    assert sorted(tuple(r) for r in convert.export_roots(table).collect()) == [("e", "messages"), ("g", "nodes")]
    assert [(r["conv_uuid"], r["sender"], r["content"][0]["block_type"]) for r in convert.message_conversations(table.filter("path like 'e/%'")).collect()] == [("c", "human", "text")]
    assert sorted((r["node_id"], r["parts"], r["is_current"]) for r in convert.node_conversations(table.filter("path like 'g/%'")).collect()) == [("a", None, False), ("b", ["x", "y"], True)]


def test_word_lists(spark, tmp_path):
    (tmp_path / "l.tsv").write_text("# c\nLoom\tx\nloom\n\nSun\n")
    assert sorted(r["term"] for r in convert.term_list(spark, str(tmp_path / "l.tsv")).collect()) == ["loom", "sun"]
    (tmp_path / "n.tsv").write_text("id1\tName\nbad\nid1\tLater\n")
    assert [(r["id"], r["name"]) for r in convert.name_table(spark, str(tmp_path / "n.tsv")).orderBy("line").collect()] == [("id1", "Name"), ("id1", "Later")]


def test_stream_takes_each_export_once(spark, tmp_path):
    from folioscope.streaming.activity import take_in, windowed

    source = tmp_path / "in"
    spark.createDataFrame([("e1", "f1"), ("e2", "f2")], "export_key string, fingerprint string").coalesce(1).write.parquet(str(source))
    seen = []
    for _ in range(2):
        stream = spark.readStream.schema("export_key string, fingerprint string").parquet(str(source))
        take_in(stream, str(tmp_path / "ledger"), lambda df, name: seen.extend(r["export_key"] for r in df.collect()), str(tmp_path / "cp")).awaitTermination()
        spark.createDataFrame([("e2", "f2"), ("e3", "f3")], "export_key string, fingerprint string").coalesce(1).write.mode("append").parquet(str(source))
    assert sorted(seen) == ["e1", "e2", "e3"]
    stream = spark.readStream.schema("export_key string, fingerprint string").parquet(str(source))
    take_in(stream, str(tmp_path / "ledger"), lambda df, name: seen.extend(r["export_key"] for r in df.collect()), str(tmp_path / "cp")).awaitTermination()
    assert sorted(seen) == ["e1", "e2", "e3"]
    # an intake that fails after it was recorded is handed over again, under the same name
    spark.createDataFrame([("e4", "f4")], "export_key string, fingerprint string").coalesce(1).write.mode("append").parquet(str(source))
    tries = []

    def failing(df, name):
        tries.append((name, sorted(r["export_key"] for r in df.collect())))
        if len(tries) == 1:
            raise RuntimeError("lost")

    for _ in range(2):
        stream = spark.readStream.schema("export_key string, fingerprint string").parquet(str(source))
        try:
            take_in(stream, str(tmp_path / "ledger"), failing, str(tmp_path / "cp")).awaitTermination()
        except Exception:
            pass
    assert len(tries) == 2 and tries[0] == tries[1] and tries[0][1] == ["e4"]
    assert windowed(spark.createDataFrame([], "ts timestamp, user_id long, event_type string, value double")).count() == 0


def test_scanned_pdf_by_all_pages(monkeypatch):
    import sys
    from types import SimpleNamespace

    from folioscope.sources import convert

    def flag(texts):
        pages = [SimpleNamespace(extract_text=lambda t=t: t) for t in texts]
        monkeypatch.setitem(sys.modules, "pypdf", SimpleNamespace(PdfReader=lambda data: SimpleNamespace(pages=pages)))
        return convert.pdf_to_markdown(b"")[0]["likely_scanned"]

    assert flag([""] * 10 + ["x" * 500] * 5) == "false"
    assert flag(["x" * 25] * 10 + [""] * 10) == "true"
