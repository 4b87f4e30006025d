"""A catalogue of released and authored files: companion records, missing fields filled in, filed manifests, and what moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import text
from folioscope.operators.audit import REQUIRED, ancestors
from folioscope.operators.exports import newest

# Names, sources and marks of the catalogue's own files.
RECORD_SOURCE, AUTHORED = "artifact sidecar", "authored"
OWN_NAMES = ["_index.json", "_recovered-outputs.json", "desktop.ini", "Thumbs.db", ".DS_Store"]
RUN_LOG = r"^_pipeline_\d{8}_\d{6}\.log$"
PLAIN_SUFFIX, RECOVERED = ".nlm.md", "_recovered-outputs.json"
UNRESOLVED_FOLDER = r"(?i)^(project_g-p-|gpt_g-)"
SHEET = "application/vnd.google-apps.spreadsheet"


def skippable(path: Column) -> Column:
    """Whether a file of the tier is no artifact: the catalogue's own output, a lock, a log, or inside a hidden folder."""
    name = text.base_name(path)
    hidden = F.exists(F.slice(F.split(path, "/"), F.lit(1), F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0))), lambda f: f.startswith("."))
    return name.isin(OWN_NAMES) | name.startswith("~$") | name.startswith(".") | name.endswith(PLAIN_SUFFIX) | name.rlike(RUN_LOG) | hidden


def described(content: Column) -> Column:
    """Whether a Markdown text has all fields that search needs."""
    block = text.frontmatter(content)
    return (block != "") & F.forall(F.array(*[text.field(block, f) for f in REQUIRED]), lambda v: F.coalesce(F.trim(v), F.lit("")) != "")


def record(path: Column, size: Column, modified: Column, content: Column, keywords: Column) -> Column:
    """The companion record of an artifact. content is null where the file is no text."""
    name = text.base_name(path)
    heading = F.nullif(F.trim(F.regexp_extract(content, r"(?m)^#[ \t]+([^\n]+)$", 1)), F.lit(""))
    title, kind = F.coalesce(heading, name), F.coalesce(F.nullif(text.extension(name), F.lit("")), F.lit("(none)"))
    quoted = lambda c: text.yaml_quote(c)
    words = F.concat(F.lit("["), F.array_join(F.transform(keywords, text.yaml_quote), ", "), F.lit("]"))
    block = text.emit_frontmatter([("title", quoted(title)), ("date", quoted(F.date_format(modified, "yyyy-MM-dd'T'HH:mm"))), ("source", quoted(F.lit(RECORD_SOURCE))), ("source_file", quoted(name)), ("source_path", quoted(path)), ("file_type", quoted(kind)), ("size_bytes", size.cast("string")), ("keywords", words)])
    body = F.concat(F.lit("\n# "), title, F.lit("\n\nCatalog record for a released artifact. The artifact itself is unmodified; this file exists so it can be found.\n\n- **File:** "), name, F.lit("\n- **Type:** "), kind, F.lit("\n- **Size:** "), F.format_number(size, 0), F.lit(" bytes\n- **Path from corpus root:** `"), path, F.lit("`\n"))
    return F.concat(block, body)


def catalogued(files: DataFrame) -> DataFrame:
    """(path, record_path, record, status) of files (path, size, modified, content, keywords).

    status: ``skipped``; ``record`` for the catalogue's own; ``self_describing`` for Markdown with all fields; else ``conflict`` where the
    record's place is taken by a file that is none, ``unchanged``, ``updated`` or ``written``.
    """
    own = text.field(text.frontmatter("content"), "source") == RECORD_SOURCE
    typed = files.withColumn("is_md", F.lower("path").endswith(".md")).withColumn("own", F.coalesce(F.col("is_md") & own, F.lit(False)))
    made = typed.withColumn("record_path", F.concat("path", F.lit(".md"))).withColumn("record", record(F.col("path"), F.col("size"), F.col("modified"), F.col("content"), F.col("keywords")))
    there = typed.select(F.col("path").alias("record_path"), F.col("content").alias("old"), F.col("own").alias("old_own"))
    state = (
        F.when(skippable(F.col("path")), "skipped").when(F.col("own"), "record").when(F.col("is_md") & described(F.col("content")), "self_describing")
        .when(F.col("old_own").isNull(), "written").when(~F.col("old_own"), "conflict").when(F.col("old") == F.col("record"), "unchanged").otherwise("updated")
    )
    return made.join(there, "record_path", "left").select("path", "record_path", "record", state.alias("status"))


def stamped(docs: DataFrame, computed: dict[str, Column], default_source: str = AUTHORED) -> DataFrame:
    """(path, content, missing, changed): texts with their missing fields filled in. computed: field -> shown value.

    A text that has all fields stays as it is, byte for byte; fields that are there are never changed.
    """
    block, rest = text.frontmatter("content"), F.regexp_replace(text.body(F.col("content")), r"^\n+", "")
    values = {**computed, "source": F.coalesce(computed.get("source", F.lit(None).cast("string")), text.yaml_quote(F.lit(default_source)))}
    lacks = {f: F.coalesce(F.trim(text.field(block, f)), F.lit("")) == "" for f in REQUIRED}
    missing = F.array_compact(F.array(*[F.when(lack, f) for f, lack in lacks.items()]))
    # blank fields of the old block give way to the new ones
    kept = F.filter(F.split(block, "\n"), lambda line: (F.trim(line) != "") & ~F.exists(F.array(*[F.when(lack, f) for f, lack in lacks.items()]), lambda f: F.coalesce(line.startswith(F.concat(f, F.lit(":"))), F.lit(False))))
    added = F.array_compact(F.array(*[F.when(lacks[f], F.concat(F.lit(f"{f}: "), v)) for f, v in values.items() if f in lacks]))
    full = F.concat(F.lit("---\n"), F.array_join(F.concat(kept, added), "\n"), F.lit("\n---\n\n"), rest)
    changed = F.size(added) > 0
    return docs.select("path", F.when(changed, full).otherwise(F.col("content")).alias("content"), missing.alias("missing"), changed.alias("changed"))


def outside_recovered(files: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """Files below no folder that holds recovered outputs, by their ancestors, an equality each. roots: (root), else those whose mark is among the files."""
    found = files.filter(text.base_name(F.col("path")) == RECOVERED).select(text.parent(F.col("path")).alias("root")) if roots is None else roots.select("root")
    inside = files.select("path", F.explode(ancestors(F.col("path"))).alias("root")).join(found.distinct(), "root").select("path").distinct()
    return files.join(inside, "path", "left_anti")


def manifest_shaped(raw: Column) -> Column:
    """Whether a JSON text is a manifest: a project's uuid as a string, and a list of entries, the first of which has a uuid."""
    data = F.try_parse_json(raw)
    uuid, entries = F.schema_of_variant(F.try_variant_get(data, "$.project_uuid", "variant")), F.schema_of_variant(F.try_variant_get(data, "$.conversations", "variant"))
    first = F.try_variant_get(data, "$.conversations[0]", "variant")
    return F.coalesce((uuid == "STRING") & entries.startswith("ARRAY") & (first.isNull() | F.try_variant_get(data, "$.conversations[0].uuid", "variant").isNotNull()), F.lit(False))


def project_shaped(raw: Column) -> Column:
    """Whether a JSON text describes a project: its uuid as a string, and a name."""
    data = F.try_parse_json(raw)
    return F.coalesce((F.schema_of_variant(F.try_variant_get(data, "$.uuid", "variant")) == "STRING") & F.try_variant_get(data, "$.name", "variant").isNotNull(), F.lit(False))


def chat_shaped(path: Column, content: Column) -> Column:
    """Whether a JSON file is a chat export, by its name or what its beginning holds."""
    head = F.substring(content, 1, 4096)
    return (F.lower(text.base_name(path)) == "conversations.json") | (F.lower(path).endswith(".json") & head.contains('"mapping"') & head.contains('"current_node"'))


def sheet(mime: Column, size: Column) -> Column:
    """Whether an entry of a listing is a sheet that has no bytes of its own."""
    return (mime == SHEET) | ((size == -1) & F.lower(F.coalesce(mime, F.lit(""))).contains("spreadsheet"))


def unresolved_folders(folders: DataFrame) -> DataFrame:
    """Folders (folder) that still go by a raw id."""
    return folders.filter(text.base_name(F.col("folder")).rlike(UNRESOLVED_FOLDER))


def filed_manifests(manifests: DataFrame, problems: DataFrame, chosen: DataFrame, stems: DataFrame) -> DataFrame:
    """(path, text): each manifest without problems that a conversation wrote, beside its project, word for word.

    manifests: (file_id, project, file_name, raw_json); chosen: (project) that have a valid newest manifest; stems: (project, stem).
    """
    good = manifests.join(problems.select("file_id").distinct(), "file_id", "left_anti").join(chosen.select("project").distinct(), "project", "left_semi").join(stems, "project")
    return good.dropDuplicates(["project", "file_name", "raw_json"]).select(F.concat("stem", F.lit("_manifests/"), "file_name").alias("path"), F.col("raw_json").alias("text"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """Every document that a project ever had, the newest copy of each. docs: (project, doc_uuid, name, seen_at, ...); keyed by uuid, else name."""
    keyed = docs.withColumn("doc_key", F.coalesce(F.nullif("doc_uuid", F.lit("")), "name", F.lit("untitled")))
    return newest(keyed, ["project", "doc_key"], [F.col("seen_at")])


def moved_files(there: DataFrame, written: DataFrame) -> DataFrame:
    """(path): files of a conversation and label that this run wrote elsewhere. Both: (path, conversation, label); others stay."""
    label = F.coalesce("label", F.lit(""))
    keys = written.select("conversation", label.alias("l")).distinct()
    return there.withColumn("l", label).join(keys, ["conversation", "l"], "left_semi").join(written.select("path").distinct(), "path", "left_anti").select("path")


def sticky_folders(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, folder): the folder whose first record by path carries the id, the first such folder, else the default.

    files: (path, id) of records; wanted: (id, default).
    """
    first = files.filter(~F.col("path").endswith(PLAIN_SUFFIX)).groupBy(text.parent(F.col("path")).alias("folder")).agg(F.min_by("id", "path").alias("id"))
    held = first.filter("id is not null and id <> ''").groupBy("id").agg(F.min("folder").alias("folder"))
    return wanted.join(held, "id", "left").select("id", F.coalesce("folder", "default").alias("folder"))


class NotOneProject(ValueError):
    """A name that fits no project, or several."""


def only_project(projects: DataFrame, only: str) -> str:
    """The project that a uuid or a name, case not regarded, means. projects: (project, name)."""
    known = projects.filter(F.col("project") == only).limit(1).count()
    if known:
        return only
    hits = [r["project"] for r in projects.filter(F.lower(F.trim("name")) == only.strip().lower()).select("project").distinct().orderBy("project").limit(20).collect()]  # as many as a message shows
    if len(hits) != 1:
        raise NotOneProject(f"{only!r} fits {'no project' if not hits else ', '.join(hits)}")
    return hits[0]


def by_path(files: DataFrame) -> DataFrame:
    """files in the order of their paths' parts, so that a folder's files stand together before folders whose names go on."""
    return files.orderBy(F.split("path", "/"))


def recognition_counts(files: DataFrame, cache: DataFrame) -> DataFrame:
    """One row: considered, scanned, cached, no_text, waiting. files: (path, sha256, scanned); cache: (sha256, text)."""
    held = cache.groupBy("sha256").agg(F.max(F.length(F.trim("text"))).alias("chars"))
    met = files.join(held, "sha256", "left")
    return met.agg(
        F.count("*").alias("considered"), F.count_if("scanned").alias("scanned"), F.count_if(F.col("scanned") & (F.col("chars") > 0)).alias("cached"),
        F.count_if(F.col("scanned") & (F.col("chars") == 0)).alias("no_text"), F.count_if(F.col("scanned") & F.col("chars").isNull()).alias("waiting"),
    )
