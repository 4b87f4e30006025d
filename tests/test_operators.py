"""Operators on small literal tables."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from folioscope.operators import audit, duplicates, exports, graphs, inventory, keywords, provenance, replay, schema_drift, trees


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_structure_classes(spark):
    cases = [
        ("## Human\nhi\n## Assistant\nyo", "any", "turn-structured"), ("## User\nx\n## Tool (y)\nz", "docx", "turn-structured"), ("## User\nonly", "docx", "single-voice"),
        ("**Nick:** a\n**Matt:** b\n**Nick:** c\n**Matt:** d", "x", "speaker-labelled"), ("**Note:** once", "html", "single-voice"), ("plain", "Claude export", "unknown"), ("plain", "", "unknown"),
        ("```\n## Human\n## Assistant\n```", "txt", "single-voice"),
    ]
    df = spark.createDataFrame(cases, "text string, source string, want string")
    assert [r for r in df.select("want", provenance.structure(F.col("text"), F.col("source")).alias("got"), "text").collect() if r["want"] != r["got"]] == []


def test_turns_and_weights(spark):
    df = spark.createDataFrame([(1, "intro words\n## Human\nlantern lantern\n## Assistant\nlantern market", "x")], "doc_id long, text string, source string")
    assert [(t[1], t[2], t[3]) for t in _rows(provenance.turns(df))] == [(0, None, "neutral"), (1, "Human", "subject"), (2, "Assistant", "assistant")]
    assert {(r["term"], r["tf"], r["weighted"]) for r in provenance.weighted_terms(df).collect()} == {("intro", 1, 1), ("words", 1, 1), ("lantern", 3, 384), ("market", 1, 1)}


def test_classes_of_links_by_brute_force(spark):
    r = random.Random(4)
    links = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    parent = {n: n for link in links for n in link}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    linked = {n for a, b in links if a != b for n in (a, b)}
    got = dict(_rows(graphs.classes(spark.createDataFrame(links, "a long, b long"))))
    assert got == {n: top(n) for n in linked}


def test_duplicates_hold_a_copy_and_its_changes(spark):
    base = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    other = [f"else{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(base)), (3, " ".join(base[:100] + other[:20] + base[100:])), (4, " ".join(other)), (5, "short"), (6, None)], "doc_id long, text string")
    assert _rows(duplicates.duplicate_classes(docs)) == [(1, 1, 3), (2, 1, 3), (3, 1, 3)]
    found = {r["doc_id"]: r for r in duplicates.differing_passages(docs).collect()}
    assert found[2]["identical"] and found[3]["only_doc"] == [" ".join(other[:20])[:300]]


def test_branches():
    assert trees.branches([("a", None, 1), ("b", "a", 2), ("c", "a", 3), ("d", "b", 9)]) == [(0, 0, "a"), (0, 1, "b"), (0, 2, "d"), (1, 0, "c")]
    assert trees.branches([("a", None, 3), ("b", None, 1), ("c", None, 2)]) == [(0, 0, "b"), (0, 1, "c"), (0, 2, "a")]
    assert {b[2] for b in trees.branches([("a", "b", 1), ("b", "a", 2), ("r", None, 0)])} == {"a", "b", "r"}
    deep = [(str(i), str(i - 1) if i else None, i) for i in range(5000)]
    assert [b[2] for b in trees.branches(deep)] == [str(i) for i in range(5000)]


def test_branch_table_with_nulls_and_repeats(spark):
    at = datetime(2025, 1, 1)
    rows = [("c", "a", None, at), ("c", "a", None, at), ("c", "b", "a", None), (None, "x", None, at), ("d", None, None, at)]
    df = spark.createDataFrame(rows, "conv_uuid string, msg_uuid string, parent_uuid string, created_at timestamp")
    assert _rows(trees.branch_table(df)) == [("c", 0, 0, "a"), ("c", 0, 1, "b")]


def test_collapsed_runs(spark):
    df = spark.createDataFrame([(1, i, f) for i, f in enumerate([True, True, False, True])], "k long, i long, f boolean")
    assert [(r[2], r[4]) for r in _rows(trees.collapsed_runs(df, ["k"], "i", "f"))] == [(True, 2), (False, 1), (True, 1)]


def test_replay():
    op = lambda seq, kind, path="/mnt/user-data/outputs/a", **kw: {"seq": seq, "op": kind, "file_path": path, "branch": "active", "text": None, "old_str": None, "new_str": None, "failed": False, **kw}
    edits = [op(1, "create", text="x y y"), op(2, "edit", old_str="z", new_str="1"), op(3, "edit", old_str="x", new_str="2"), op(4, "edit", old_str="y", new_str="3"), op(5, "edit", old_str="2", new_str="9", failed=True), op(6, "present")]
    (made,) = replay.replayed(edits)
    assert (made["text"], made["edits_applied"], made["edits_failed"], made["compliant"]) == ("2 y y", 1, 2, True)
    moved = replay.replayed([*edits, op(7, "mv", new_str="/tmp/b")])
    assert [f["file_path"] for f in moved] == ["/tmp/b"] and not moved[0]["compliant"]


def test_newest_and_ledger(spark):
    t = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")], "k string, at int, v string")
    assert _rows(exports.newest(t, ["k"], [F.col("at")])) == [("a", 3, "y"), ("b", 2, "z")]
    now = spark.createDataFrame([("e1", "f1"), ("e2", "f2*")], "export_key string, fingerprint string")
    known = spark.createDataFrame([("e1", "f1"), ("e2", "f2")], "export_key string, fingerprint string")
    assert _rows(exports.ledger_new(now, known)) == [("e2", "f2*")]


def test_gate_stops_unless_lenient(spark):
    import pytest

    bad = spark.createDataFrame([("x", 1), ("y", 0)], "problem string, subjects int")
    with pytest.raises(exports.GateError, match="^x$"):
        exports.gate(bad)
    exports.gate(bad, lenient=True)


def test_allocated_names_are_unique(spark):
    wanted = ["d/notes.md", "d/notes.md", "d/notes-2.md", "d/notes.md", "e/notes.md"]
    df = spark.createDataFrame(list(enumerate(wanted)), "i int, wanted string")
    got = [r["allocated"] for r in inventory.allocated(df, "wanted", ["i"]).orderBy("i").collect()]
    assert len(set(got)) == 5 and got[0] == "d/notes.md" and got[2] == "d/notes-2.md" and got[4] == "e/notes.md"


def test_collisions_mirror_coverage(spark):
    at = [datetime(2025, 1, d) for d in (1, 2, 3)]
    files = spark.createDataFrame([("f/a.xlsx", at[2]), ("f/b.xlsx", at[0]), ("f/c.xlsx", None), ("f/d.xlsx", at[1]), ("f/e.xlsx", at[1])], "path string, modified timestamp")
    sheets = spark.createDataFrame([("f/a", at[1]), ("f/b", at[1]), ("f/c", at[1]), ("f/d.xlsx", at[1])], "path string, modified timestamp")
    assert [(p, v) for p, _, v in _rows(inventory.collisions(files, sheets))] == [("f/a.xlsx", "SAFE"), ("f/b.xlsx", "KEEP"), ("f/c.xlsx", "unknown"), ("f/d.xlsx", "SAFE")]
    a = spark.createDataFrame([("x", 1, "h"), ("y", 1, "h"), ("z", 2, "h")], "path string, size int, digest string")
    b = spark.createDataFrame([("y", 1, "h"), ("z", 2, "g"), ("w", 1, "h")], "path string, size int, digest string")
    assert _rows(inventory.mirror(a, b)) == [("w", "-"), ("x", "+"), ("y", "="), ("z", "~")]
    lists = spark.createDataFrame([("l", "p"), ("l", "gone")], "list_name string, folder string")
    assert [(f, s) for f, _, s in _rows(inventory.coverage(spark.createDataFrame([("p",), ("q",)], "folder string"), lists))] == [("gone", "unmatched"), ("p", "selected"), ("q", "unselected")]


def test_audit_paths(spark):
    df = spark.createDataFrame([("a/b.md",), ("_Tools/x.md",), (".git/x",), ("a/~$x.docx",), ("a/.hidden/x.md",), ("Thumbs.db",)], "path string")
    assert [r["u"] for r in df.select(audit.utility_path(F.col("path")).alias("u")).collect()] == [False, True, True, True, True, True]
    assert _rows(audit.inside(df, spark.createDataFrame([("a",)], "root string"))) == [("a/.hidden/x.md",), ("a/b.md",), ("a/~$x.docx",)]


def test_unaccounted_by_every_rung(spark):
    raw = spark.createDataFrame([("p/a.md", 1, "x"), ("p/b.docx", 1, "x"), ("p/c.bin", 1, "x"), ("p/d.txt", 1, "x"), ("p/e.txt", 1, "x"), ("q/f.md", 1, "x"), ("p/g.txt", 7, "s"), ("p/h.txt", 8, "s")], "path string, size long, sha256 string")
    have = [("p/a.md", None, None, None, None), ("p/b.md", None, None, None, None), ("p/c.bin.md", None, None, None, None), ("z", "d.txt", None, None, None), ("y", None, "p/e.txt", None, None), ("r/f.md", None, None, None, None), ("w", None, None, 7, "s")]
    got = audit.unaccounted(raw, spark.createDataFrame(have, "path string, source_file string, source_path string, source_bytes long, source_sha256 string"))
    assert [r["path"] for r in got.collect()] == ["p/h.txt"]


def test_rejected_terms_and_lexicon(spark):
    docs = spark.createDataFrame([(i, "market lantern kxwoj erlyjewxq candle") for i in range(2)], "doc_id long, text string")
    assert {(r["term"], r["tier"]) for r in keywords.rejected_report(docs).collect()} == {("kxwoj", "soft"), ("erlyjewxq", "hard")}
    lexicon = spark.createDataFrame([("kxwoj",)], "term string")
    assert "kxwoj" in keywords.keywords_filtered(docs, lexicon).first()["keywords"]


# --- schemas that drift --------------------------------------------------------------------------

U = "f596eb31-3708-4118-a19d-c939c2e80eec"


def _files(spark, *jsons):
    rows = [(i, f"{U}_manifest.json", datetime(2025, 1, 1 + i), j) for i, j in enumerate(jsons)]
    return spark.createDataFrame(rows, "file_id long, file_name string, written_at timestamp, raw_json string")


def test_each_kind_of_change(spark):
    files = _files(
        spark,
        f'{{"project_uuid": "{U}", "revision": 3, "generated_at": "2025-01-01T00:00:00Z", "conversations": [{{"uuid": "{U}", "title": "a"}}]}}',
        f'{{"projectUuid": "{U.upper()}", "revision": "r4", "created_on": 1735700000, "conversations": [{{"uuid": "{U}", "name": "a", "starred": true}}]}}',
        "{broken", f'{{"revision": "5", "projectUuid": "urn:uuid:{U}", "created_on": 1735800000, "conversations": []}}',
    )
    assert _rows(schema_drift.found(files)) == [
        (1, "conversations.name", "renamed"), (1, "conversations.starred", "added"), (1, "created_on", "renamed"), (1, "projectUuid", "renamed"), (1, "revision", "retyped"),
    ]


def test_drift_over_range_boundaries_repeats_and_dirt(spark):
    files = _files(spark, *[f'{{"a": {i if i % 2 else chr(34) + str(i) + chr(34)}}}' for i in range(20)])
    found = schema_drift.found(files.unionByName(files).withColumn("extra", F.lit(1)))
    assert _rows(found) == [(i, "a", "retyped") for i in range(1, 20)]
    dirt = spark.createDataFrame([(1, None, None, None), (2, "no uuid", None, "{}"), (3, f"{U}_m.json", None, "[1]"), (None, f"{U}_m.json", None, "{}")], files.schema)
    assert _rows(schema_drift.found(dirt)) == []
    assert _rows(schema_drift.found(files.limit(0))) == []
    assert schema_drift.united(dirt).count() == 2


def test_united_table(spark):
    files = _files(spark, f'{{"project_uuid": "{U}", "revision": 3}}', f'{{"projectUuid": "{U.upper()}", "revision": "4", "conversations": [{{"id": "{U}"}}, {{"id": null}}]}}')
    got = schema_drift.united(files).orderBy("file_id", "entry_uuid").collect()
    assert [(r["project_uuid"], r["revision"]) for r in got] == [(U, 3), (U, 4), (U, 4)]


def test_active_paths(spark):
    nodes = spark.createDataFrame([("k", "r", None, False), ("k", "a", "r", False), ("k", "b", "a", True), ("k", "c", "a", False), ("o", "x", "y", True), ("o", "y", "x", False)], "conv_id string, node_id string, parent string, is_current boolean")
    assert _rows(trees.active_paths(nodes)) == [("k", "a", 2), ("k", "b", 3), ("k", "r", 1), ("o", "x", 2), ("o", "y", 1)]


def test_embedded_manifests(spark):
    from folioscope.operators import render

    made = '{"project_uuid": "p"}'
    rows = [(1, "c", 1, "create", "/mnt/user-data/outputs/m.json", "{", False), (2, "c", 2, "create", "/mnt/user-data/outputs/m.json", made, None), (3, "c", 3, "present", "/mnt/user-data/outputs/m.json", None, False), (4, "c", 4, "edit", "/mnt/user-data/outputs/m.json", None, True), (5, "d", 1, "create", "/tmp/m.json", made, False)]
    got = render.embedded_manifests(spark.createDataFrame(rows, "op_id long, conv_uuid string, seq int, op string, file_path string, text string, failed boolean"))
    assert [tuple(r)[2:] for r in got.collect()] == [(2, "p", True, False)]


def test_json_bullets():
    from folioscope.operators import render

    assert render.json_bullets({"a": 1, "b": {"c": [True, None]}}) == ["- **a:** 1", "- **b:**", "  - **c:**", "    - true", "    - "]
