"""Registered queries of the core, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import artifacts, text, values
from folioscope.operators import assets, audit, catalogue, duplicates, exports, inventory, keywords, nodes, provenance, render, replay, schema_drift, trees
from folioscope.runtime import materialize, spread, table

Query = Callable[[SparkSession, str], DataFrame]


def _documents(s: SparkSession, d: str) -> DataFrame:
    return spread(table(s, d, "documents"))


def _digests(s: SparkSession, d: str) -> DataFrame:
    """digested_docs without its repeated rows."""
    return table(s, d, "digested_docs").dropDuplicates(["digest_id"])


def _files(s: SparkSession, d: str) -> DataFrame:
    """digested_docs as files: (path, size, sha256)."""
    return _digests(s, d).select(F.concat_ws("", "source_path", F.lit("-"), F.col("digest_id").cast("string"), F.lit("."), F.when(F.col("source").rlike("^[a-z]+$"), F.col("source")).otherwise("md")).alias("path"), F.col("source_bytes").alias("size"), F.col("source_sha256").alias("sha256"), "digest_id")


def _per_document(columns: Callable[[Column], dict[str, Column]]) -> Query:
    """doc_id and columns made of the text. They are made when the query runs, as expressions need a session."""
    return lambda s, d: _documents(s, d).select("doc_id", *[c.alias(n) for n, c in columns(F.col("text")).items()])


def _joined(c: Column) -> Column:
    """An array as one string, so that engines compare alike."""
    return F.array_join(c, "\n")


def _emitted(s: SparkSession, d: str) -> DataFrame:
    quoted = lambda n: text.yaml_quote(F.col(n))
    block = text.emit_frontmatter([("title", quoted("title")), ("source", quoted("source")), ("word_count", F.col("word_count").cast("string")), ("keywords_weighted", F.col("keywords_weighted").cast("string"))])
    return _digests(s, d).select("digest_id", block.alias("block"))


def _round_trip(s: SparkSession, d: str) -> DataFrame:
    emitted = _emitted(s, d)
    inner = text.frontmatter(F.concat("block", F.lit("\nbody\n")))
    return emitted.select("digest_id", text.field(inner, "title").alias("title"), text.field(inner, "source").alias("source"), text.field(inner, "word_count").try_cast("long").alias("word_count"))


def _indexed(s: SparkSession, d: str) -> DataFrame:
    docs = _documents(s, d)
    kept = keywords.keywords_tfidf(docs).groupBy("doc_id").agg(F.array_sort(F.collect_list("term")).alias("keywords"))
    joined = docs.select("doc_id", "text").join(kept, "doc_id")
    block = text.index_block(F.col("keywords"), text.outline(F.col("text")))
    return joined.select("doc_id", F.md5(text.with_index(text.body(F.col("text")), block)).alias("digest"))


def _artifacts(reason: Callable[[Column], Column]) -> Query:
    def run(s: SparkSession, d: str) -> DataFrame:
        terms = keywords.document_frequency(keywords.term_frequency(_documents(s, d))).select("term")
        return terms.withColumn("reason", reason(F.col("term"))).filter("reason is not null")

    return run


def _lexicon(s: SparkSession, d: str) -> DataFrame:
    """Terms of the collection's digests in lower case."""
    return _digests(s, d).select(F.explode("keywords").alias("k")).select(F.lower(F.trim("k")).alias("term")).filter("term <> ''").distinct()


def _vetoed(s: SparkSession, d: str) -> DataFrame:
    terms = keywords.document_frequency(keywords.term_frequency(_documents(s, d)))
    soft = terms.withColumn("reason", artifacts.soft_reason(F.col("term"))).filter("reason is not null")
    listed = _lexicon(s, d).withColumn("listed", F.lit(True))
    return soft.join(listed, "term", "left").select("term", "df", F.coalesce("listed", F.lit(False)).alias("listed"), ((F.col("df") >= artifacts.REAL_FROM) | F.coalesce("listed", F.lit(False))).alias("saved"))


def _completeness(s: SparkSession, d: str) -> DataFrame:
    """Files that conversations wrote against the digests and the documents: by path, name, source and content."""
    written = table(s, d, "file_ops").filter("file_path is not null").groupBy(F.col("file_path").alias("path")).agg(F.max(F.octet_length("text")).cast("long").alias("size"), F.max(F.sha2("text", 256)).alias("sha256"))
    raw = written.unionByName(_files(s, d).select("path", "size", "sha256"))
    kept = _digests(s, d).select(F.concat("source_path", F.lit(".md")).alias("path"), text.base_name(F.col("source_path")).alias("source_file"), "source_path", "source_bytes", F.when(F.col("source") != "pdf", F.col("source_sha256")).alias("source_sha256"))
    return audit.unaccounted(raw, kept).select("path")


def _missing(s: SparkSession, d: str) -> DataFrame:
    fields = {"title": F.col("title"), "keywords": F.array_join("keywords", ","), "date": F.col("doc_date"), "source": F.col("source")}
    return audit.missing_tally(_digests(s, d).withColumn("missing", audit.missing_fields(fields)), "provenance_structure")


#: Where the files of the path query stand: the star is the file's own path.
PLACES = ["*", "_Tools/*", "a/__pycache__/b/*", ".git/*", "*/.hidden/x", "*/~$lock.docx", "*/x.PYC", "*/Thumbs.db", "_tools/*", "*/notes._audit", "*/.env"]


def _stale(s: SparkSession, d: str) -> DataFrame:
    """Digests, calls and messages as records of every kind: of a file, of a conversation, of objects that are neither, and of nothing."""
    none = F.lit(None).cast("string")
    digested = _digests(s, d).select(F.col("title").isNotNull().alias("fields"), F.when(F.col("keywords_weighted"), "no").otherwise("on").alias("retired"), F.when(F.col("source").contains("export"), F.lit("Claude export (memory)")).otherwise(F.col("source")).alias("source"), F.when(~F.col("source").contains("export"), text.base_name(F.col("source_path"))).alias("file_name"), none.alias("conv"))
    called = table(s, d, "file_ops").select(F.lit(True).alias("fields"), F.when(F.col("failed"), "TRUE ").otherwise("").alias("retired"), F.col("op").alias("source"), none.alias("file_name"), F.col("conv_uuid").alias("conv"))
    files = _documents(s, d).select(text.base_name(F.col("source")).alias("file_name")).distinct().withColumn("in_files", F.lit(True))
    chats = _messages(s, d).filter("conv_uuid is not null and project_uuid is not null").select(F.col("conv_uuid").alias("conv")).distinct().withColumn("in_chats", F.lit(True))
    stems = digested.withColumn("file_name", F.regexp_replace("file_name", r"-\d+$", ""))
    met = stems.unionByName(called).join(files, "file_name", "left").join(chats, "conv", "left")
    state = audit.stale_state(F.col("fields"), F.col("retired"), audit.skipped_source(F.col("source")), F.coalesce("in_files", F.lit(False)), F.col("file_name"), F.coalesce("in_chats", F.lit(False)), F.col("conv"))
    return met.groupBy(state.alias("state")).agg(F.count("*").alias("records"))


def _renames(s: SparkSession, d: str) -> DataFrame:
    files = _files(s, d).select("path", "size", "sha256")
    moved = files.select(F.concat(F.lit("moved/"), "path").alias("path"), "size", "sha256")
    return audit.renames(moved, files)


def _projects_as_names(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "projects").select("project_uuid", text.safe_name(F.col("project_name"), text.short_uuid(F.col("project_uuid"))).alias("folder"), text.short_uuid(F.col("project_uuid")).alias("short"))


def _found_manifests(s: SparkSession, d: str) -> DataFrame:
    return exports.manifests(table(s, d, "manifest_files"))


def _messages(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "chat_messages")


def _ledger(s: SparkSession, d: str) -> DataFrame:
    """Exports of the last 60 days against a ledger of what was delivered before."""
    messages = _messages(s, d)
    last = messages.agg(F.max("exported_at") - F.expr("interval 60 days")).first()[0]
    now, known = exports.fingerprints(messages), exports.fingerprints(messages.filter(F.col("exported_at") < F.lit(last)))
    return exports.ledger_new(now, known).select("export_key")


def _reasoning(s: SparkSession, d: str) -> DataFrame:
    blocks = _messages(s, d).filter("content is not null").select("row_id", F.posexplode("content").alias("place", "b"))
    return trees.collapsed_runs(blocks.select("row_id", "place", (F.col("b.block_type") == "thinking").alias("step")), ["row_id"], "place", "step").select("row_id", "run_no", "flagged", "n")


def _counters(s: SparkSession, d: str) -> DataFrame:
    """Counters of each conversation: messages, thinking blocks, tool calls."""
    held = _messages(s, d).filter("conv_uuid is not null").dropDuplicates(["conv_uuid", "msg_uuid"])
    count = lambda kind: F.sum(F.size(F.filter(F.coalesce("content", F.array()), lambda b: b["block_type"] == kind)))
    return held.groupBy("conv_uuid").agg(F.count("*").alias("messages"), count("thinking").alias("thinking_blocks"), count("tool_use").alias("tool_uses"), F.max("created_at").alias("last_message"))


def _selection(s: SparkSession, d: str) -> DataFrame:
    projects = table(s, d, "projects").select(F.col("project_uuid").alias("folder"))
    chats = _messages(s, d).select(F.lit("chats").alias("list_name"), F.col("project_uuid").alias("folder"))
    convs = table(s, d, "export_conversations").select(F.lit("exports").alias("list_name"), F.col("project_uuid").alias("folder"))
    found = inventory.coverage(projects, chats.unionByName(convs).filter("folder is not null").distinct())
    return found.select("folder", F.array_join("selected_by", ",").alias("selected_by"), "state")


def _mirror(s: SparkSession, d: str) -> DataFrame:
    """The conversations of the later batches against those of the earlier ones, as files."""
    rows = table(s, d, "export_conversations").filter("conv_uuid is not null")
    side = lambda late: exports.newest(rows.filter((F.col("batch_no") > 12) == late).select(F.col("conv_uuid").alias("path"), F.length("transcript").cast("long").alias("size"), F.md5("transcript").alias("digest"), "batch_no", "conv_row_id"), ["path"], [F.col("batch_no"), F.col("conv_row_id")])
    return inventory.mirror(side(True), side(False)).groupBy("action").agg(F.count("*").alias("files"))


def _collisions(s: SparkSession, d: str) -> DataFrame:
    docs = _digests(s, d).select("digest_id", "source", "title", "source_path", "indexed_at")
    side = lambda kind, tail: docs.filter(F.col("source") == kind).select(F.concat(text.parent(F.col("source_path")), F.lit("/"), F.substring_index("title", " ", 1), F.lit(tail)).alias("path"), F.col("indexed_at").alias("modified"))
    files = side("xlsx", ".xlsx").groupBy("path").agg(F.max("modified").alias("modified"))
    sheets = side("docx", "").groupBy("path").agg(F.max("modified").alias("modified"))
    return inventory.collisions(files, sheets)


def _allocated(s: SparkSession, d: str) -> DataFrame:
    docs = _digests(s, d).select("digest_id", F.concat(text.parent(F.col("source_path")), F.lit("/"), text.slug(F.substring_index("title", " ", 2)), F.lit(".md")).alias("wanted"))
    return inventory.allocated(docs, "wanted", ["digest_id"]).select("digest_id", "allocated")


def _resolved(s: SparkSession, d: str) -> DataFrame:
    at, source = values.resolved_date([("date", F.col("doc_date"))], text.base_name(F.col("source_path")), F.col("indexed_at"))
    return _digests(s, d).select("digest_id", values.iso_minutes(at).alias("date"), source.alias("date_source"))


def _as_json(s: SparkSession, d: str) -> DataFrame:
    found = _digests(s, d).select("digest_id", F.to_json(F.struct("digest_id", "title", "source_bytes")).alias("entry"))
    return found


def _spread_numbers(s: SparkSession, d: str) -> DataFrame:
    docs = _documents(s, d).select("doc_id", "n_chars")
    serial = F.col("n_chars").cast("double") + F.col("doc_id") % 2 / 2.0
    letters = values.column_letters(F.col("n_chars") + 1)
    return docs.select("doc_id", values.sheet_serial(serial).alias("serial_date"), letters.alias("letters"), values.column_number(letters).cast("long").alias("number"), values.heading_level(F.col("n_chars") % 60).alias("level"))


#: Beginnings of files, each of which some documents get in front: every form that is told apart, and some that are none.
HEADS = [
    "89504e470d0a1a0a", "ffd8ffe0", "474946383761", "474946383961", "255044462d312e37", "49443303", "4f676753", "524946460000000057454250", "524946460000000057415645", "524946460000000041564920", "52494646000000004e4f4e45", "000000186674797069736f6d", "89504e47", "00",
]


def _bytes(s: SparkSession, d: str) -> DataFrame:
    head = F.element_at(F.array(*map(F.lit, HEADS)), (F.pmod(F.col("n_chars"), F.lit(len(HEADS))) + 1).cast("int"))
    content = F.to_binary(F.concat(head, F.lower(F.hex(F.encode(F.coalesce("text", F.lit("")), "utf-8")))), F.lit("hex"))
    url = F.concat(F.lit("data:image/png;base64,"), F.base64(F.encode(F.coalesce("text", F.lit("")), "utf-8")))
    return _documents(s, d).select("doc_id", values.sniffed_extension(content).alias("extension"), F.sha2(F.encode(F.coalesce("text", F.lit("")), "utf-8"), 256).alias("sha256"), F.length(values.data_url_bytes(url)).cast("long").alias("payload"))


def _pointer_ids(s: SparkSession, d: str) -> DataFrame:
    made = F.to_json(F.struct(F.concat(F.lit("sediment://file_"), F.col("row_id").cast("string")).alias("a"), F.array(F.concat(F.lit("file-service://file-"), F.substring("msg_uuid", 1, 8)), F.concat(F.lit("sediment://file_"), F.col("row_id").cast("string"))).alias("b")))
    return _messages(s, d).select("row_id", F.array_join(values.pointers(made), ",").alias("ids"))


def _nodes(s: SparkSession, d: str) -> DataFrame:
    return nodes.from_messages(_messages(s, d))


def _asset_files(s: SparkSession, d: str) -> DataFrame:
    """A file for each message of a project, its id in the name."""
    name = F.concat(F.lit("assets/"), F.lower(F.trim(F.coalesce("sender", F.lit("none")))), F.lit("/file-"), F.substring(F.replace("msg_uuid", F.lit("-")), 1, 12), F.lit("-"), F.col("row_id").cast("string"), F.when(F.col("text").isNull(), ".json").otherwise(".dat"))
    return _messages(s, d).filter("project_uuid is not null").select(F.col("project_uuid").alias("root"), name.alias("path"))


def _block_parts(s: SparkSession, d: str) -> DataFrame:
    """The blocks of all messages as object parts."""
    blocks = _messages(s, d).select("conv_uuid", "msg_uuid", F.explode("content").alias("b"))
    part = F.to_json(F.struct(F.col("b.block_type").alias("content_type"), F.col("b.text").alias("text"), F.col("b.tool_name").alias("tool_name")))
    return blocks.select(F.col("conv_uuid").alias("conv_id"), F.col("msg_uuid").alias("node_id"), F.lit("part").alias("source"), part.alias("part"))


def _asset_references(s: SparkSession, d: str) -> DataFrame:
    """Each message refers to its parent's file."""
    pointer = F.to_json(F.struct(F.concat(F.lit("file-service://file-"), F.substring(F.replace("parent_uuid", F.lit("-")), 1, 12)).alias("asset_pointer")))
    parts = _messages(s, d).filter("parent_uuid is not null and conv_uuid is not null").select(F.col("conv_uuid").alias("conv_id"), F.lit("part").alias("source"), pointer.alias("part"))
    return assets.referenced(parts)


def _split_assets(s: SparkSession, d: str) -> DataFrame:
    buckets = _messages(s, d).filter("conv_uuid is not null").groupBy(F.col("conv_uuid").alias("conv_id")).agg(F.coalesce(F.min("project_uuid"), F.lit("_ungrouped")).alias("bucket"))
    return assets.split_assets(_asset_references(s, d), assets.asset_index(_asset_files(s, d)), buckets)


def _document_files(s: SparkSession, d: str) -> DataFrame:
    docs = _documents(s, d).dropDuplicates(["doc_id"])
    return docs.select(F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.when(F.col("source").startswith("pdf"), ".pdf").otherwise(".md")).alias("path"), F.col("n_chars").cast("long").alias("size"), F.col("indexed_at").alias("modified"), F.when(~F.col("source").startswith("pdf"), F.col("text")).alias("content"), F.array(F.col("lang")).alias("keywords"))


def _stamped(s: SparkSession, d: str) -> DataFrame:
    docs = _document_files(s, d).filter("content is not null")
    made = catalogue.stamped(docs, {"title": text.yaml_quote(text.base_name(F.col("path"))), "date": text.yaml_quote(F.lit("2026-01-01")), "keywords": F.lit("[]")})
    return made.select("path", F.array_join("missing", ",").alias("missing"), "changed", catalogue.described(F.col("content")).alias("complete"))


def _filed(s: SparkSession, d: str) -> DataFrame:
    found = _found_manifests(s, d)
    files = table(s, d, "manifest_files").join(found.filter("valid").select("file_id", F.col("file_project").alias("project")), "file_id")
    stems = table(s, d, "projects").select(F.lower("project_uuid").alias("project"), F.concat(F.lit("projects/"), text.short_uuid(F.col("project_uuid"))).alias("stem"))
    return catalogue.filed_manifests(files, exports.manifest_problems(found), found.filter("valid").select(F.col("file_project").alias("project")), stems).select("path", F.md5("text").alias("digest"))


def _kept_documents(s: SparkSession, d: str) -> DataFrame:
    written = table(s, d, "file_ops").filter("op = 'create' and conv_uuid is not null").select(F.col("conv_uuid").alias("project"), F.lit(None).cast("string").alias("doc_uuid"), F.col("file_path").alias("name"), F.struct("seq", "op_id").alias("seen_at"), F.md5("text").alias("digest"))
    return catalogue.kept_documents(written).select("project", "name", "digest")


def _recovered(s: SparkSession, d: str) -> DataFrame:
    ops = table(s, d, "file_ops")
    rebuilt = materialize(replay.rebuilt_files(ops), "rebuilt")
    return replay.recovered_folders(rebuilt, replay.unrecoverable(ops, rebuilt)).select("path", F.md5("text").alias("digest"))


def _common_folders(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "file_ops").filter("file_path is not null").groupBy(text.extension(text.base_name(F.col("file_path"))).alias("extension")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "extension").limit(15)


def _run_totals(s: SparkSession, d: str) -> DataFrame:
    return _files(s, d).groupBy(inventory.kind(F.col("path")).alias("kind")).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


def _windowed_events(s: SparkSession, d: str) -> DataFrame:
    from folioscope.streaming.activity import windowed

    return windowed(table(s, d, "events"))


def queries() -> dict[str, Query]:
    return {
        "p5_found": lambda s, d: schema_drift.found(table(s, d, "manifest_files")),
        "p5_changes": lambda s, d: schema_drift.schema_changes(table(s, d, "manifest_files")),
        "p5_retyped": lambda s, d: schema_drift.found(table(s, d, "manifest_files")).filter("change_kind = 'retyped'").select("file_id", "field_name"),
        "p5_manifests": lambda s, d: schema_drift.united(table(s, d, "manifest_files")),
        "word_count_documents": _per_document(lambda t: dict(words=text.word_count(t))),
        "keyword_count_scale": _per_document(lambda t: dict(n=text.keyword_count(text.word_count(t)))),
        "token_stats": lambda s, d: _documents(s, d).select("lang", F.explode(text.tokens(text.strip_code(F.col("text")))).alias("t")).groupBy("lang").agg(F.count("*").alias("tokens"), F.countDistinct("t").alias("terms")),
        "strip_code_documents": _per_document(lambda t: dict(digest=F.md5(text.strip_code(t)))),
        "classifiable_text_documents": _per_document(lambda t: dict(digest=F.md5(text.classifiable_text(t)))),
        "slug_documents": _per_document(lambda t: dict(slug=text.slug(F.col("title")), slug_clean=text.slug_clean_end(F.col("title")))),
        "heading_outline": _per_document(lambda t: dict(outline=_joined(text.outline(t)))),
        "title_documents": _per_document(lambda t: dict(title=text.title(text.body(t), text.base_name(F.col("source"))))),
        "frontmatter_fields": _per_document(lambda t: dict(title=text.field(text.frontmatter(t), "title"), source=text.field(text.frontmatter(t), "source"), keywords=_joined(text.list_items(text.field(text.frontmatter(t), "keywords"))), body=F.md5(text.body(t)))),
        "frontmatter_emit": _emitted,
        "frontmatter_emit_all": lambda s, d: _digests(s, d).select("digest_id", text.emit_frontmatter([("title", text.yaml_quote(F.col("title"))), ("keywords", text.bracketed(F.filter("keywords", lambda k: k.isNotNull()))), ("word_count", F.col("word_count").cast("string"))], empty=True).alias("block")),
        "frontmatter_roundtrip": _round_trip,
        "record_dates": lambda s, d: _documents(s, d).select("doc_id", values.record_date(F.concat(F.when(F.length("title") > 12, F.concat(F.date_format("indexed_at", "yyyy-MM-dd"), F.lit("-"))).otherwise(""), text.base_name(F.col("source"))), F.col("text")).alias("day")),
        "index_block_documents": _indexed,
        "capitalised_terms": _per_document(lambda t: dict(terms=_joined(F.array_sort(text.capitalised_terms(t))))),
        "fenced_documents": _per_document(lambda t: dict(digest=F.md5(text.fenced(t)))),
        "clean_pages": lambda s, d: table(s, d, "pdf_pages").select("page_id", F.md5(text.clean_page(F.col("text"))).alias("digest")),
        "escaped_cells": _per_document(lambda t: dict(digest=F.md5(text.escape_cell(t)))),
        "truncated_documents": _per_document(lambda t: dict(head=text.truncated(t))),
        "safe_names": _projects_as_names,
        "path_keywords": lambda s, d: _digests(s, d).select("digest_id", F.array_join(text.path_keywords(F.col("title"), F.col("source_path")), ",").alias("keywords")),
        "term_frequency": lambda s, d: keywords.term_frequency(_documents(s, d)),
        "doc_frequency": lambda s, d: keywords.document_frequency(keywords.term_frequency(_documents(s, d))),
        "keywords_tfidf_documents": lambda s, d: keywords.keywords_tfidf(_documents(s, d)),
        "keywords_raw_documents": lambda s, d: keywords.keywords_raw(_documents(s, d)),
        "keywords_by_lang": lambda s, d: keywords.keywords_by_group(_documents(s, d), "lang"),
        "keywords_filtered": lambda s, d: keywords.keywords_filtered(_documents(s, d), _lexicon(s, d)).select("doc_id", _joined(F.col("keywords")).alias("keywords")),
        "rejected_report": lambda s, d: keywords.rejected_report(_documents(s, d)),
        "lexicon_veto": _vetoed,
        "artifact_hard": _artifacts(artifacts.hard_reason),
        "artifact_soft": _artifacts(artifacts.soft_reason),
        "provenance_structure": _per_document(lambda t: dict(structure=provenance.structure(t, F.col("source")), roles=_joined(F.array_sort(F.array_distinct(provenance.roles(t)))))),
        "structure_tally": lambda s, d: provenance.structure_tally(_documents(s, d)),
        "weighting": lambda s, d: provenance.weighting(_documents(s, d)),
        "turn_spans": lambda s, d: provenance.turns(_documents(s, d)).select("doc_id", "turn_no", "role", "kind", F.md5("segment").alias("digest")),
        "weighted_terms": lambda s, d: provenance.weighted_terms(_documents(s, d)),
        "keywords_weighted": lambda s, d: provenance.keywords_weighted(_documents(s, d)),
        "fingerprint_windows": lambda s, d: duplicates.windows(_documents(s, d)),
        "duplicate_classes": lambda s, d: duplicates.duplicate_classes(_documents(s, d)),
        "duplicate_conversations": lambda s, d: duplicates.duplicate_classes(table(s, d, "export_conversations").filter(~F.coalesce("earlier_version", F.lit(False))).select(F.col("conv_row_id").alias("doc_id"), F.col("transcript").alias("text"))),
        "duplicate_passages": lambda s, d: duplicates.differing_passages(_documents(s, d)),
        "shared_windows": lambda s, d: duplicates.shared_windows(_documents(s, d), table(s, d, "eval_items").select(F.col("item_id").alias("doc_id"), F.col("passage").alias("text"))),
        "completeness_antijoin": _completeness,
        "index_differences": lambda s, d: audit.index_differences(_digests(s, d).select(F.col("digest_id").alias("id")), _documents(s, d).select(F.col("doc_id").alias("id")), "id"),
        "frontmatter_missing": _missing,
        "filename_conformance": lambda s, d: table(s, d, "manifest_files").select("file_id", audit.name_conforms(F.col("file_name")).alias("conforms")),
        "utility_paths": lambda s, d: _files(s, d).select("digest_id", audit.utility_path(F.replace(F.element_at(F.array(*map(F.lit, PLACES)), (F.col("digest_id") % len(PLACES) + 1).cast("int")), F.lit("*"), F.col("path"))).alias("utility")),
        "stale_classification": _stale,
        "rename_detection": _renames,
        "export_times": lambda s, d: exports.export_times(_messages(s, d)),
        "newest_versions": lambda s, d: exports.newest_versions(_messages(s, d)),
        "earlier_versions_kept": lambda s, d: exports.earlier_kept(_messages(s, d)),
        "merge_report": lambda s, d: exports.merge_report(_messages(s, d)),
        "as_of_labels": lambda s, d: exports.as_of_labels(_messages(s, d)),
        "manifest_problems": lambda s, d: exports.manifest_problems(_found_manifests(s, d)),
        "manifest_revisions": lambda s, d: exports.revision_check(_found_manifests(s, d)),
        "manifest_resolution": lambda s, d: exports.resolution(_found_manifests(s, d), exports.manifest_problems(_found_manifests(s, d))),
        "manifest_placement": lambda s, d: exports.placement(_found_manifests(s, d)),
        "manifest_gate": lambda s, d: exports.gate_problems(_found_manifests(s, d), _messages(s, d), table(s, d, "projects")),
        "ledger_new": _ledger,
        "split_buckets": lambda s, d: exports.split_counts(_messages(s, d)),
        "conversation_branches": lambda s, d: trees.branch_table(_messages(s, d)),
        "collapse_reasoning": _reasoning,
        "conversation_counters": _counters,
        "replayed_files": lambda s, d: replay.rebuilt_files(table(s, d, "file_ops")),
        "node_blocks": lambda s, d: nodes.rendered_nodes(_nodes(s, d)).select("conv_id", "node_id", F.md5("block").alias("digest")),
        "node_conversations": lambda s, d: nodes.rendered_conversations(_nodes(s, d)).select("conv_id", "active_message_count", "total_node_count", "reasoning_step_count", "is_voice", "last_message_time"),
        "node_bodies": lambda s, d: nodes.rendered_conversations(_nodes(s, d)).select("conv_id", F.md5("body").alias("digest")),
        "asset_index": lambda s, d: assets.asset_index(_asset_files(s, d)),
        "asset_counts": lambda s, d: assets.index_counts(_asset_files(s, d)),
        "asset_resolution": lambda s, d: assets.resolved(_asset_references(s, d), assets.asset_index(_asset_files(s, d))),
        "asset_profile": lambda s, d: assets.profile(_block_parts(s, d)),
        "split_assets": _split_assets,
        "catalogue_states": lambda s, d: catalogue.catalogued(_document_files(s, d)).select("path", "record_path", "status"),
        "stamped_documents": _stamped,
        "manifest_shapes": lambda s, d: table(s, d, "manifest_files").select("file_id", catalogue.manifest_shaped(F.col("raw_json")).alias("manifest"), catalogue.project_shaped(F.col("raw_json")).alias("project")),
        "filed_manifests": _filed,
        "kept_documents": _kept_documents,
        "unrecoverable_outputs": lambda s, d: replay.unrecoverable(table(s, d, "file_ops"), replay.rebuilt_files(table(s, d, "file_ops"))),
        "recovered_folders": _recovered,
        "rendered_messages": lambda s, d: render.rendered_messages(_messages(s, d)).select("row_id", F.md5("markdown").alias("digest")),
        "rendered_conversations": lambda s, d: render.rendered_conversations(_messages(s, d)).select("conv_uuid", "part_no", "messages", "branches", F.md5("markdown").alias("digest")),
        "embedded_manifests": lambda s, d: render.embedded_manifests(table(s, d, "file_ops")),
        "scanned_files": lambda s, d: render.scanned(table(s, d, "pdf_pages")),
        "plain_documents": lambda s, d: render.plain_reader(_documents(s, d)).select("doc_id", F.md5("plain").alias("digest")),
        "file_kinds": _run_totals,
        "folder_summary": lambda s, d: inventory.folder_summary(_digests(s, d).select(F.concat(text.parent(F.col("source_path")), F.lit("/"), F.coalesce(F.date_format("indexed_at", "yyyy-MM-dd"), F.lit("9999-99-99")), F.lit("-"), F.col("digest_id").cast("string"), F.when(F.col("source") == "md", ".md").otherwise(".txt")).alias("path"), F.col("source_bytes").alias("size"))),
        "selection_coverage": _selection,
        "mirror_actions": _mirror,
        "collision_verdicts": _collisions,
        "allocated_names": _allocated,
        "sidecars": lambda s, d: _files(s, d).select("digest_id", F.md5(inventory.sidecar(F.col("path"), F.col("size"), F.col("sha256"))).alias("digest")),
        "first_claims": lambda s, d: inventory.first_claims(table(s, d, "export_conversations").select("conv_uuid", "conv_row_id", "batch_no", "project_uuid"), "conv_uuid", ["batch_no", "conv_row_id"]),
        "date_resolution": _resolved,
        "index_entries": _as_json,
        "sheet_values": _spread_numbers,
        "byte_functions": _bytes,
        "pointer_ids": _pointer_ids,
        "common_extensions": _common_folders,
        "event_windows": _windowed_events,
    }


def oracle_sql() -> dict[str, str]:
    from folioscope.plans.sql import SQL

    return SQL
