import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from folioscope.operators import assets, catalogue, nodes
from folioscope.plans import corpus
from folioscope.sources import convert, objects, sinks


def _node(parent, role, parts, at=None, name=None, attachments=()):
    return {"parent": parent, "message": {"author": {"role": role, "name": name}, "create_time": at, "content": {"parts": parts}, "metadata": {"attachments": list(attachments)}}}


NODE_EXPORT = [
    {
        "conversation_id": "c1", "title": "Brass kettles", "current_node": "f",
        "mapping": {
            "r": {"parent": None}, "s": _node("r", "system", [""]), "a": _node("s", "user", ["Which kettle?", {"content_type": "image_asset_pointer", "asset_pointer": "sediment://file_0000aaaa1111"}], 1700000000.0, attachments=[{"id": "file-AbCdEf12345", "name": "plan.pdf", "mime_type": "application/pdf"}]),
            "b": _node("a", "assistant", [""], 1700000001.0), "c": _node("b", "assistant", [""], 1700000002.0), "d": _node("c", "tool", [{"content_type": "text", "text": "42"}], 1700000003.0, "python"), "x": _node("a", "assistant", ["An older answer"], 1700000002.5),
            "f": _node("d", "assistant", ["The brass one", {"content_type": "video"}], 1700000004.0),
        },
    }
]
MESSAGE_EXPORT = [
    {
        "uuid": "11111111-2222-4333-8444-555555555555", "name": "Garden plan", "summary": "", "chat_messages": [
            {"uuid": "m1", "parent_message_uuid": None, "sender": "human", "created_at": "2026-01-02T03:04:05Z", "text": "Draw it", "content": [], "attachments": [{"file_name": "soil.txt", "file_type": "txt", "file_size": 12, "extracted_content": "clay"}], "files": [{"file_name": "bed.png", "file_uuid": "u9"}]},
            {"uuid": "m2", "parent_message_uuid": "m1", "sender": "assistant", "created_at": "2026-01-02T03:05:05Z", "text": "", "content": [
                {"type": "thinking", "thinking": "beds first", "summaries": [{"summary": "Beds"}]}, {"type": "text", "text": "Here"}, {"type": "tool_use", "name": "create_file", "input": {"path": "/x/plan.md", "file_text": "# Plan\n```\nbed\n```"}},
                {"type": "tool_result", "name": "create_file", "is_error": True, "content": [{"type": "text", "text": "no room"}]}, {"type": "odd", "k": 1}]},
        ],
    }
]
PROJECT = {"uuid": "aaaaaaaa-bbbb-4ccc-8ddd-eeeeeeeeeeee", "name": "Allotment", "description": "Beds and paths", "docs": [{"uuid": "d1", "filename": "notes.md", "content": "dig twice\n"}, {"uuid": "d2", "filename": "empty.md", "content": " "}]}


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "raw"
    for name, data in {
        "notes/kettle.txt": "Kettles whistle loudly whenever boiling water steams upward.", "notes/page.html": "<html><title>Copper pans</title><body><p>Copper conducts heat evenly</p></body></html>", "notes/page.txt": "A twin by name",
        "notes/seen.md": "---\ntitle: \"Seen\"\n---\n\n# Seen\n\nIronware notes\n", "notes/blob.xyz": "??", "notes/~$lock.docx": "x", "node_modules/skip.txt": "no", "chats/nodes/user.json": "{}", "chats/nodes/conversations.json": json.dumps(NODE_EXPORT),
        "chats/nodes/file_0000aaaa1111-kettle.png": "png", "chats/messages/conversations.json": json.dumps(MESSAGE_EXPORT), "chats/messages/users.json": json.dumps([{"uuid": "u", "full_name": "A B"}]), "chats/messages/projects/p.json": json.dumps(PROJECT),
        "chats/messages/memories.json": json.dumps([{"conversations_memory": "likes clay", "project_memories": {PROJECT["uuid"]: "raised beds"}}]), "old/_recovered-outputs.json": "{}", "old/inner/thing.txt": "recovered",
    }.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(data)
    return root


def test_nodes_as_markdown(spark, folder):
    found = convert.node_conversations(convert.files(spark, str(folder)))
    links = F.create_map(F.lit("file_0000aaaa1111"), F.lit("kettle_media/file_0000aaaa1111.png"))
    row = nodes.rendered_conversations(found, found.select("conv_id", "title").distinct(), links).first()
    body = row["body"]
    assert body.startswith("# Brass kettles\n\n\n\n## User\n*2023-11-14 22:13:20*\n\nWhich kettle?\n![image](kettle_media/file_0000aaaa1111.png)\n**Attachments:**\n- plan.pdf (application/pdf) — not included in the export")
    assert "*[2 reasoning steps]*" in body and "## Tool (python)" in body and body.index("The brass one") < body.index("## Inactive branches") < body.index("An older answer") and "[video: no asset reference in the export]" in body
    assert (row["active_message_count"], row["total_node_count"], row["reasoning_step_count"], row["is_voice"]) == (6, 8, 2, False)


def test_single_and_wrapped_node_files(spark):
    one = NODE_EXPORT[0]
    rows = [(f"{i}/conversations.json", json.dumps(x).encode()) for i, x in enumerate(([one], {"conversations": [one]}, one, {"other": 1}, "x"))]
    found = convert.node_conversations(spark.createDataFrame([*rows, ("5/conversations.json", b"{cut")], "path string, content binary"))
    assert found.groupBy("source_path").count().count() == 3 and found.count() == 24


def test_objects_of_message_exports(spark, folder):
    files = convert.files(spark, str(folder))
    said = {r["msg_uuid"]: r["body"] for r in objects.message_bodies(objects.export_messages(files.filter("path like 'chats/messages/%'"))).collect()}
    assert said["m1"] == "Draw it\n\n**Attachments**\n\n_Attachment 1: `soil.txt` (txt, 12 bytes)_\n\n```\nclay\n```\n\n**Files** _(file bytes not included in Claude export)_\n\n- `bed.png` (u9)"
    assert "- *Beds*\n\nbeds first" in said["m2"] and "````markdown\n# Plan\n```\nbed\n```\n````" in said["m2"] and "(error)**\n\nno room" in said["m2"] and "Unknown content block (`odd`)" in said["m2"]
    shown = {(r["kind"], r["name"]): r["body"] for r in objects.rendered_projects(objects.projects(files)).collect()}
    assert shown["project", "Allotment"] == "# Allotment\n\n## Description\n\nBeds and paths\n\n## Project documents\n\n- notes.md\n- empty.md\n" and shown["document", "notes.md"] == "dig twice\n" and "no text" in shown["document", "empty.md"]
    assert {(r["scope"], r["text"]) for r in objects.memories(files).collect()} == {("", "likes clay"), (PROJECT["uuid"], "raised beds")}
    assert objects.users(files).first()["full_name"] == "A B"


def test_a_whole_run(spark, folder, tmp_path):
    out = tmp_path / "digested"
    found = {r["finding"]: r["n"] for r in corpus.run(spark, str(folder), str(out), f"file://{tmp_path}/index").collect()}
    written = {str(p.relative_to(out)) for p in out.rglob("*.md")}
    assert {"notes/kettle.md", "notes/seen.md", "notes/blob.xyz.md", "notes/page.md", "notes/page-2.md", "conversations/brass-kettles--c1.md", "conversations/garden-plan--11111111.md", "projects/aaaaaaaa.md", "projects/aaaaaaaa_docs/notesmd.md"} <= written
    assert not [w for w in written if "skip" in w or "lock" in w or "thing" in w]
    kettle = (out / "notes/kettle.md").read_text()
    assert 'source_path: "notes/kettle.txt"' in kettle and "keywords: [" in kettle and "<!-- BEGIN AUTO INDEX -->" in kettle and 'title: "' in kettle
    assert found["without digest"] == 0 and found["index differences"] == 0
    # another run leaves everything as it is
    before = {p: p.read_text() for p in out.rglob("*.md")}
    corpus.describe(spark, str(out))
    after = {p: p.read_text() for p in out.rglob("*.md")}
    assert [p for p in before if before[p] != after[p]] == [], [(before[p], after[p]) for p in before if before[p] != after[p]][:1]


def test_assets(spark):
    files = spark.createDataFrame([("g", "b/file-ABCDEFGHIJ12-plan.pdf"), ("g", "a/file-ABCDEFGHIJ12-plan.pdf"), ("g", "file_0000aaaa1111.dat"), ("g", "conversations.json"), ("g", "plain.png")], "root string, path string")
    assert {(r["asset_id"], r["path"]) for r in assets.asset_index(files).collect()} == {("file-ABCDEFGHIJ12", "a/file-ABCDEFGHIJ12-plan.pdf"), ("file_0000aaaa1111", "file_0000aaaa1111.dat")}
    assert tuple(assets.index_counts(files).first()) == ("g", 4, 1)
    rows = [("c1", "a", ["text", '{"content_type":"image","asset_pointer":"sediment://file_0000aaaa1111"}'], [("file-ABCDEFGHIJ12", "plan", None)]), ("c2", "a", ['{"content_type":"image","asset_pointer":"sediment://file_00000000dead"}'], [])]
    parts = assets.content_parts(spark.createDataFrame(rows, "conv_id string, node_id string, parts array<string>, attachments array<struct<id:string,name:string,mime:string>>"))
    found = assets.resolved(assets.referenced(parts), assets.asset_index(files))
    assert {tuple(r) for r in found.collect()} == {("c1", "file_0000aaaa1111", "file_0000aaaa1111.dat"), ("c1", "file-ABCDEFGHIJ12", "a/file-ABCDEFGHIJ12-plan.pdf"), ("c2", "file_00000000dead", None)}
    assert {tuple(r) for r in assets.profile(parts).collect()} >= {("image", None, 2), ("image", "asset_pointer", 2), ("attachment", None, 1)}
    buckets = spark.createDataFrame([("c1", "p"), ("c2", "p")], "conv_id string, bucket string")
    assert [tuple(r) for r in assets.split_assets(assets.referenced(parts), assets.asset_index(files), buckets).collect()] == [("p", 2, 1)]
    placed = assets.placements(found.withColumn("size", F.lit(3)).withColumn("name", F.concat("asset_id", F.lit(".bin"))), spark.createDataFrame([("c1", "conversations/x.md")], "conv_id string, output string"), spark.createDataFrame([("conversations/x_media/file_0000aaaa1111.bin", 3)], "path string, size int"))
    assert {(r["target"], r["action"]) for r in placed.collect()} == {("conversations/x_media/file_0000aaaa1111.bin", "keep"), ("conversations/x_media/file-ABCDEFGHIJ12.bin", "copy")}


def test_catalogue_states(spark):
    full = '---\ntitle: "T"\nkeywords: ["a"]\ndate: "2026-01-01"\nsource: "me"\n---\n\n# T\n'
    rows = [("r/book.pdf", 9, None), ("r/report.md", 5, full), ("r/bare.md", 5, "# Bare\n"), ("r/bare.md.md", 5, "mine"), ("r/~$x.docx", 1, None), ("r/.git/x.txt", 1, None)]
    files = spark.createDataFrame(rows, "path string, size long, content string").withColumn("modified", F.lit("2026-01-02 03:04:00").cast("timestamp")).withColumn("keywords", F.array(F.lit("book")))
    first = {r["path"]: r for r in catalogue.catalogued(files).collect()}
    assert {p: r["status"] for p, r in first.items()} == {"r/book.pdf": "written", "r/report.md": "self_describing", "r/bare.md": "conflict", "r/bare.md.md": "written", "r/~$x.docx": "skipped", "r/.git/x.txt": "skipped"}
    again = files.unionByName(files.filter("path = 'r/book.pdf'").withColumn("path", F.lit("r/book.pdf.md")).withColumn("content", F.lit(first["r/book.pdf"]["record"])))
    states = {r["path"]: r["status"] for r in catalogue.catalogued(again).collect()}
    assert states["r/book.pdf"] == "unchanged" and states["r/book.pdf.md"] == "record"
    done = {r["path"]: r for r in catalogue.stamped(files.filter("content is not null").select("path", "content"), {"title": F.lit('"X"'), "date": F.lit('"2026-01-01"'), "keywords": F.lit("[]"), "source": F.lit(None).cast("string")}).collect()}
    assert done["r/report.md"]["content"] == full and not done["r/report.md"]["changed"]
    assert done["r/bare.md"]["content"].startswith('---\ntitle: "X"\n') and 'source: "authored"' in done["r/bare.md"]["content"] and done["r/bare.md"]["missing"] == ["title", "keywords", "date", "source"]


def test_small_rules(spark):
    shapes = spark.createDataFrame([('{"project_uuid":"p","conversations":[{"uuid":"c"}]}',), ('{"project_uuid":"p","conversations":[]}',), ('{"project_uuid":1,"conversations":[]}',), ('{"project_uuid":"p","conversations":[{"id":"c"}]}',), ('{"uuid":"u","name":"n"}',), ("{cut",), (None,)], "j string")
    got = shapes.select("j", catalogue.manifest_shaped(F.col("j")).alias("m"), catalogue.project_shaped(F.col("j")).alias("p")).collect()
    assert [r["m"] for r in got] == [True, True, False, False, False, False, False] and [r["p"] for r in got] == [False] * 4 + [True, False, False]
    chats = spark.createDataFrame([("a/conversations.json", ""), ("b.json", '{"mapping": {}, "current_node": 1}'), ("c.json", "{}"), ("d.txt", '"mapping" "current_node"')], "p string, c string")
    assert [r[0] for r in chats.select(catalogue.chat_shaped(F.col("p"), F.col("c"))).collect()] == [True, True, False, False]
    people = spark.createDataFrame([("u1", "Politics"), ("u2", "politics "), ("u3", "Garden")], "project string, name string")
    assert catalogue.only_project(people, "u2") == "u2" and catalogue.only_project(people, " garden") == "u3"
    for bad in ("politics", "nothing"):
        with pytest.raises(catalogue.NotOneProject):
            catalogue.only_project(people, bad)
    there = spark.createDataFrame([("old/a.md", "c1", None), ("new/a.md", "c1", None), ("keep/b.md", "c2", None), ("old/a2.md", "c1", "L")], "path string, conversation string, label string")
    assert [r["path"] for r in catalogue.moved_files(there, there.filter("path = 'new/a.md'")).collect()] == ["old/a.md"]
    files = spark.createDataFrame([("mine/a.md", "p1"), ("mine/b.md", "p2"), ("other/a.nlm.md", "p2"), ("other/b.md", "p2")], "path string, id string")
    assert {tuple(r) for r in catalogue.sticky_folders(files, spark.createDataFrame([("p1", "d1"), ("p2", "d2"), ("p3", "d3")], "id string, default string")).collect()} == {("p1", "mine"), ("p2", "other"), ("p3", "d3")}
    docs = spark.createDataFrame([("p", "d", "a", 1, "old"), ("p", "d", "a", 2, "new"), ("p", None, "b", 1, "only")], "project string, doc_uuid string, name string, seen_at int, content string")
    assert {r["content"] for r in catalogue.kept_documents(docs).collect()} == {"new", "only"}
    assert [r["path"] for r in catalogue.by_path(spark.createDataFrame([("a-b/x",), ("a/z",), ("a/b/c",)], "path string")).collect()] == ["a/b/c", "a/z", "a-b/x"]
    pages = spark.createDataFrame([("a", "1", True), ("b", "2", True), ("c", "3", False), ("d", "4", True)], "path string, sha256 string, scanned boolean")
    assert tuple(catalogue.recognition_counts(pages, spark.createDataFrame([("1", "text"), ("2", " ")], "sha256 string, text string")).first()) == (4, 3, 1, 1, 1)
    assert {r["folder"] for r in catalogue.unresolved_folders(spark.createDataFrame([("x/project_g-p-1",), ("x/GPT_g-2",), ("x/mine",)], "folder string")).collect()} == {"x/project_g-p-1", "x/GPT_g-2"}


def test_lists_listings_and_media(spark, tmp_path):
    import base64
    import io
    import zipfile

    (tmp_path / "sel.txt").write_text("# c\nOne\nTwo\n\nOne\n")
    assert [r["name"] for r in convert.selection_list(spark, str(tmp_path / "sel.txt")).orderBy("line").collect()] == ["One", "Two"]
    assert convert.selection_list(spark, str(tmp_path / "sel.txt"), once=False).count() == 3
    (tmp_path / "l.json").write_text(json.dumps([{"Path": "a/x", "IsDir": False, "Size": -1, "ModTime": "2026-01-01T00:00:00Z", "MimeType": "application/vnd.google-apps.spreadsheet"}, {"Path": "a/x.xlsx", "IsDir": False, "Size": 7, "ModTime": "bad", "MimeType": None}, {"Path": "a", "IsDir": True}]))
    got = {r["path"]: (r["folder"], r["is_sheet"], r["modified"] is None) for r in convert.listing(spark, str(tmp_path / "l.json")).collect()}
    assert got == {"a/x": ("a", True, False), "a/x.xlsx": ("a", False, True)}
    png = b"\x89PNG\r\n\x1a\nrest"
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("word/media/image1.png", png)
    rows = [("d/a.docx", data.getvalue()), ("d/bad.docx", b"no zip"), ("d/p.html", b'<img src="data:image/gif;base64,' + base64.b64encode(b"GIF89axx") + b'">'), ("d/n.txt", None)]
    found = convert.embedded_media(spark.createDataFrame(rows, "path string, content binary"))
    assert {r["target"]: bytes(r["content"]) for r in found.collect()} == {"d/a_media/image1.png": png, "d/p_media/image-1.gif": b"GIF89axx"}
    sinks.copy_files(found.select(F.col("target").alias("path"), "content"), str(tmp_path / "out"))
    assert (tmp_path / "out/d/a_media/image1.png").read_bytes() == png
    said = sinks.write_report({"numbers": spark.range(5)}, str(tmp_path / "r.md"), 3)
    assert said == "## numbers (5)\n\n- 0\n- 1\n- 2\n- ... and 2 more\n" == (tmp_path / "r.md").read_text()
    with pytest.raises(Exception, match="outside"):
        sinks.copy_files(spark.createDataFrame([("../x", b"x")], "path string, content binary"), str(tmp_path / "out"))
