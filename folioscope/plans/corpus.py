"""Whole runs over a folder: digest it, describe the digests, check them, and all of that in order.

Each step reads files and writes files; between the steps stand tables. A step that fails stops a run, a report never does.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import text, values
from folioscope.operators import audit, catalogue, duplicates, inventory, keywords, nodes, provenance
from folioscope.runtime import materialize
from folioscope.sources import convert, objects, sinks


def raw_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, size, modified, content) without tooling, clutter and recovered outputs."""
    return catalogue.outside_recovered(convert.content_files(convert.files(spark, root)), convert.marked_folders(spark, root, catalogue.RECOVERED))


def chat_rows(raw: DataFrame) -> DataFrame:
    """(wanted, source_path, meta, body) of all conversations and projects of the exports among the files."""
    roots = convert.export_roots(raw)
    held = audit.inside(raw.withColumn("path", F.col("path")), roots)
    node_rows = convert.node_conversations(held)
    bodies = nodes.rendered_conversations(node_rows, node_rows.groupBy("conv_id").agg(F.first("title").alias("title")))
    titles = node_rows.groupBy("conv_id").agg(F.first("title").alias("title"), F.first("source_path").alias("source_path"))
    chats = bodies.join(titles, "conv_id").select(
        F.concat(F.lit("conversations/"), text.slug(F.coalesce("title", F.lit(""))), F.lit("--"), text.short_uuid(F.col("conv_id")), F.lit(".md")).alias("wanted"), "source_path",
        F.map_from_arrays(F.array(*map(F.lit, ["title", "source", "conversation_id", "last_message_time"])), F.array(F.coalesce("title", F.lit("Untitled conversation")), F.lit("ChatGPT export"), "conv_id", "last_message_time")).alias("meta"), "body",
    )
    messages = objects.export_messages(held)
    said = objects.message_bodies(messages).withColumnRenamed("body", "said")
    full = messages.join(said, ["export_key", "conv_uuid", "msg_uuid"])
    stamp = F.coalesce(F.concat(F.lit("_"), F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC_\n\n")), F.lit(""))
    block = F.concat(F.lit("## "), F.when(F.col("sender") == "human", "Human").when(F.col("sender") == "assistant", "Assistant").otherwise(F.initcap(F.coalesce("sender", F.lit("unknown")))), F.lit("\n"), stamp, F.coalesce("said", F.lit("")))
    grouped = full.groupBy("export_key", "conv_uuid", "conv_name").agg(F.array_sort(F.collect_list(F.struct("created_at", "msg_uuid", block.alias("b")))).alias("ms"))
    name = F.coalesce(F.nullif("conv_name", F.lit("")), F.lit("Untitled conversation"))
    talks = grouped.select(
        F.concat(F.lit("conversations/"), text.slug(name), F.lit("--"), text.short_uuid(F.col("conv_uuid")), F.lit(".md")).alias("wanted"), F.concat("export_key", F.lit("/conversations.json")).alias("source_path"),
        F.map_from_arrays(F.array(*map(F.lit, ["title", "source", "conversation_id"])), F.array(name, F.lit("Claude export"), "conv_uuid")).alias("meta"), F.concat(F.lit("# "), name, F.lit("\n\n"), F.array_join(F.transform("ms", lambda m: m["b"]), "\n\n"), F.lit("\n")).alias("body"),
    )
    shown = objects.rendered_projects(objects.projects(held))
    knowledge = shown.select(
        F.concat(F.lit("projects/"), text.short_uuid(F.col("project")), F.when(F.col("kind") == "document", F.concat(F.lit("_docs/"), text.slug(F.coalesce("name", F.lit(""))))).otherwise(""), F.lit(".md")).alias("wanted"), F.concat(F.lit("projects/"), "project", F.lit(".json")).alias("source_path"),
        F.map_from_arrays(F.array(*map(F.lit, ["title", "source", "project_id"])), F.array(F.coalesce("name", F.lit("Untitled project")), F.concat(F.lit("Claude export ("), F.when(F.col("kind") == "document", "project knowledge").otherwise("project metadata"), F.lit(")")), "project")).alias("meta"), "body",
    )
    return reduce(DataFrame.unionByName, [chats, talks, knowledge])


def digest(spark: SparkSession, root: str, out: str) -> DataFrame:
    """Convert every file below root into Markdown below out. (path, source_path, error) of what was written, or could not be."""
    raw = raw_files(spark, root)
    roots = convert.export_roots(raw)
    loose = raw.join(audit.inside(raw.select("path"), roots), "path", "left_anti")
    converted = materialize(convert.converted(loose), "converted")
    kind = F.when(F.col("kind").isin("media", "sidecar", "account") | F.col("error").isNotNull(), F.concat("path", F.lit(".md"))).otherwise(inventory.output_name(F.col("path")))
    identity = loose.select(F.col("path").alias("source_path"), F.col("size").cast("string").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.date_format("modified", "yyyy-MM-dd").alias("day"))
    files = converted.select(kind.alias("wanted"), F.col("path").alias("source_path"), F.coalesce("meta", F.map_from_arrays(F.array(F.lit("source")), F.array(F.lit("unconvertible")))).alias("meta"), F.coalesce("body", F.concat(F.lit("# "), text.base_name(F.col("path")), F.lit("\n"))).alias("body"), "error")
    extra = F.map_from_arrays(F.array(*map(F.lit, ["source_file", "source_path", "source_bytes", "source_sha256", "date"])), F.array(text.base_name(F.col("source_path")), "source_path", "bytes", "sha256", "day"))
    title = F.map_from_arrays(F.array(F.lit("title")), F.array(text.title(F.col("body"), text.base_name(F.col("source_path")))))
    full = files.join(identity, "source_path").withColumn("meta", F.map_concat(F.map_filter(title, lambda k, v: ~F.map_contains_key("meta", k)), "meta", F.map_filter(extra, lambda k, v: ~F.map_contains_key("meta", k) & v.isNotNull()))).select("wanted", "source_path", "meta", "body", "error")
    both = full.unionByName(chat_rows(raw).withColumn("error", F.lit(None).cast("string")))
    placed = materialize(inventory.allocated(both, "wanted", ["source_path"]).withColumn("text", sinks.digest_text(F.col("meta"), F.col("body"))), "digested")
    sinks.write_text_files(placed.select(F.col("allocated").alias("path"), "text"), out)
    # media go along as they are, pictures inside documents beside their digests
    media = loose.withColumn("kind", inventory.kind(F.col("path"))).filter("kind = 'media'")
    sinks.copy_files(media, out)
    sinks.copy_files(convert.embedded_media(loose).select(F.col("target").alias("path"), "content"), out)
    return placed.select(F.col("allocated").alias("path"), "source_path", "error")


def digests(spark: SparkSession, out: str) -> DataFrame:
    """(path, size, modified, text) of the Markdown below a folder, readers' copies left out."""
    found = convert.files(spark, out, "*.md").filter(~F.col("path").endswith(catalogue.PLAIN_SUFFIX))
    return found.select("path", "size", "modified", F.decode("content", "utf-8").alias("text"))


def describe(spark: SparkSession, out: str, lexicon: DataFrame | None = None, named: list[str] | None = None) -> DataFrame:
    """Give every digest its keywords, word count, structure and index block, in place. (path, keywords, structure, weighted, skipped)."""
    docs = materialize(digests(spark, out).withColumn("doc_id", F.xxhash64("path")).withColumn("body", text.body(F.col("text"))).withColumn("front", text.frontmatter(F.col("text"))), "digests")
    # the generated block says nothing of its own
    bare = F.regexp_replace("body", text.INDEX_BLOCK, "")
    typed = docs.select("doc_id", "path", "front", "body", bare.alias("text"), text.field(F.col("front"), "source").alias("source"))
    plain = keywords.keywords_filtered(typed, lexicon)
    spoken = provenance.keywords_weighted(typed, 40, named).groupBy("doc_id").agg(F.array_sort(F.collect_list("term")).alias("spoken"))
    state = provenance.weighting(typed, named)
    wanted = text.keyword_count(text.word_count(F.col("text")))
    full = typed.join(plain, "doc_id", "left").join(spoken, "doc_id", "left").join(state, "doc_id").withColumn("keywords", F.coalesce(F.when(F.col("weighted"), F.slice("spoken", F.lit(1), wanted)), "keywords", F.array().cast("array<string>")))
    # what the digest holds already stays, computed fields are set anew
    computed = ["keywords", "word_count", "provenance_structure", "keywords_weighted", "weighting_skipped"]
    kept = F.filter(F.split("front", "\n"), lambda line: (line != "") & ~F.exists(F.array(*[F.lit(c + ":") for c in computed]), lambda c: line.startswith(c)))
    fresh = F.array_compact(F.array(
        F.concat(F.lit("keywords: ["), F.array_join(F.transform("keywords", text.yaml_quote), ", "), F.lit("]")), F.concat(F.lit("word_count: "), text.word_count(F.col("text")).cast("string")), F.concat(F.lit("provenance_structure: "), text.yaml_quote(F.col("structure"))),
        F.concat(F.lit("keywords_weighted: "), F.col("weighted").cast("string")), F.concat(F.lit("weighting_skipped: "), text.yaml_quote(F.col("skipped"))),
    ))
    block = text.index_block(F.col("keywords"), text.outline(F.col("text")))
    made = materialize(full.withColumn("made", F.concat(F.lit("---\n"), F.array_join(F.concat(kept, fresh), "\n"), F.lit("\n---\n\n"), text.with_index(F.regexp_replace("body", r"^\n+", ""), block))), "described")
    sinks.write_text_files(made.select("path", F.col("made").alias("text")), out)
    return made.select("path", "keywords", "structure", "weighted", "skipped")


def index(spark: SparkSession, out: str, target: str) -> DataFrame:
    """Write the index of a digested folder: path, size and fields of each digest. (path, size_bytes, meta)."""
    found = digests(spark, out)
    meta = F.map_from_entries(F.transform(F.filter(F.split(text.frontmatter("text"), "\n"), lambda x: F.instr(x, ":") > 1), lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)), F.regexp_replace(F.trim(F.substring(x, F.instr(x, ":") + 1, F.length(x))), r'^"(.*)"$', "$1"))))
    entries = materialize(found.select("path", F.col("size").alias("size_bytes"), meta.alias("meta")), "index")
    sinks.write_index(entries, target)
    return entries


def self_check(spark: SparkSession, root: str, out: str, indexed: DataFrame) -> dict[str, DataFrame]:
    """The sections of a report, each a table: files without digest, index against disk, missing fields, names, duplicates."""
    docs = digests(spark, out)
    front = text.frontmatter(F.col("text"))
    fields = docs.select("path", *[text.field(front, f).alias(f) for f in ("source_file", "source_path", "source_sha256", "provenance_structure", *audit.REQUIRED)], text.field(front, "source_bytes").try_cast("long").alias("source_bytes"), "text")
    raw = raw_files(spark, root)
    content = raw.select("path", "size", F.sha2("content", 256).alias("sha256")).join(audit.inside(raw.select("path"), convert.export_roots(raw)), "path", "left_anti")
    return {
        "without digest": audit.unaccounted(content, fields), "index differences": audit.index_differences(indexed.select("path"), docs.select("path"), "path"),
        "missing fields": audit.missing_tally(fields.withColumn("missing", audit.missing_fields({f: F.col(f) for f in audit.REQUIRED})), "provenance_structure"),
        "names": docs.select("path", audit.name_conforms(text.base_name(F.col("path"))).alias("conforms")).filter("not conforms"),
        "duplicates": duplicates.duplicate_classes(docs.select(F.xxhash64("path").alias("doc_id"), "text")),
    }


def run(spark: SparkSession, root: str, out: str, target: str, lexicon: DataFrame | None = None, named: list[str] | None = None) -> DataFrame:
    """All steps in order: digest, describe, index, check. (finding, n) of the check's sections."""
    digest(spark, root, out)
    describe(spark, out, lexicon, named)
    return audit.tally(self_check(spark, root, out, index(spark, out, target)))


def modified_text(at: str = "modified"):
    """When a file was changed, as digests carry it."""
    return values.iso_minutes(F.col(at))
