"""Audits of a digested corpus: completeness, index, fields, names, stale records and renames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import text

# What is no content, and names of the reporting tier.
TOOL_FOLDERS = ["_audit", "_Tools", "_ocr-cache", "__pycache__", "node_modules"]
TOOL_FILES = ["DIRTREE.txt", "FILETREE.txt", "tree.txt", ".DS_Store", "Thumbs.db", "desktop.ini"]
REQUIRED = ["title", "keywords", "date", "source"]
RETIRED = ["true", "yes", "1", "on"]
SKIPPED_SOURCES = [
    "Claude export (project metadata)", "Claude export (project knowledge)", "Claude export (memory)", "Claude export (project memory)", "Claude export (account)", "ChatGPT export auxiliary file",
]
VERSIONED = r"(?i)^.+-(?:v\d+(?:\.\d+)*|draft\d*)\.[A-Za-z0-9]+$"
TIMESTAMPED = r"^\d{4}-\d{2}-\d{2}-\d{4}__[a-z0-9]+(?:-[a-z0-9]+)*\.[A-Za-z0-9]+$"


def utility_path(path: Column) -> Column:
    """Tooling or clutter: by the file's own name, or a folder above it that is hidden or listed."""
    name = text.base_name(path)
    folders = F.slice(F.split(path, "/"), F.lit(1), F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0)))
    listed = F.array(*map(F.lit, TOOL_FOLDERS))
    by_name = name.isin(TOOL_FILES) | name.startswith("~$") | name.startswith(".") | F.lower(name).rlike(r"\.(pyc|pyo)$")
    return by_name | F.exists(folders, lambda f: f.startswith(".") | F.array_contains(listed, f))


def ancestors(path: Column) -> Column:
    """All folders above a path, so that being inside one becomes an equality."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))


def inside(files: DataFrame, roots: DataFrame) -> DataFrame:
    """files (path, ...) under any of roots (root)."""
    keyed = files.select("path", F.explode(ancestors(F.col("path"))).alias("root"))
    return files.join(keyed.join(roots.select("root").distinct(), "root").select("path").distinct(), "path", "left_semi")


def unaccounted(raw: DataFrame, digested: DataFrame) -> DataFrame:
    """Raw files (path, size, sha256) that no digested record (path, source_file, source_path, source_bytes, source_sha256) accounts for.

    Seven ways to be accounted for, each an equality of its own; a file is left if none holds.
    """
    name = text.base_name(F.col("path"))
    keys = [
        ("path", F.col("path")), ("path", F.concat(F.regexp_replace("path", r"\.[^./]*$", ""), F.lit(".md"))), ("path", F.concat(F.col("path"), F.lit(".md"))),
        ("source_file", name), ("source_path", F.col("path")), ("name", name), ("content", F.concat_ws(":", F.col("size").cast("string"), "sha256")),
    ]
    asked = raw.select("path", F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), key.alias("key")) for kind, key in keys])).alias("k")).select("path", "k.*")
    have = [
        ("path", F.col("path")), ("source_file", F.col("source_file")), ("source_path", F.col("source_path")), ("name", text.base_name(F.col("path"))),
        ("content", F.when(F.col("source_sha256").isNotNull(), F.concat_ws(":", F.col("source_bytes").cast("string"), "source_sha256"))),
    ]
    known = digested.select(F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), key.alias("key")) for kind, key in have])).alias("k")).select("k.*").filter(F.col("key").isNotNull()).distinct()
    return raw.join(asked.join(known, ["kind", "key"]).select("path").distinct(), "path", "left_anti")


def index_differences(index: DataFrame, disk: DataFrame, key: str) -> DataFrame:
    """(key, side): ``dangling`` where only the index has it, ``unindexed`` where only the disk has."""
    a, b = index.select(key).distinct(), disk.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("dangling")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("unindexed")))


def missing_fields(values: dict[str, Column]) -> Column:
    """Names of required fields that are null or blank."""
    return F.array_compact(F.array(*[F.when(F.coalesce(F.trim(v.cast("string")), F.lit("")) == "", name) for name, v in values.items()]))


def missing_tally(missing: DataFrame, group: str) -> DataFrame:
    """(group, field, records)."""
    return missing.select(group, F.explode("missing").alias("field")).groupBy(group, "field").agg(F.count("*").alias("records"))


def name_conforms(name: Column) -> Column:
    return name.rlike(VERSIONED) | name.rlike(TIMESTAMPED)


def stale_state(has_fields: Column, retired: Column, skipped: Column, in_files: Column, file_name: Column, in_conversations: Column, conversation: Column) -> Column:
    """The first of: no-frontmatter, retired, skipped, ok, absent-file, absent-conversation, orphan."""
    return (
        F.when(~has_fields, "no-frontmatter").when(F.lower(F.trim(retired)).isin(RETIRED), "retired").when(skipped, "skipped")
        .when(file_name.isNotNull(), F.when(in_files, "ok").otherwise("absent-file")).when(conversation.isNotNull(), F.when(in_conversations, "ok").otherwise("absent-conversation")).otherwise("orphan")
    )


def skipped_source(source: Column) -> Column:
    """Whether a record stands for an object of an export that is no conversation, so that its source cannot be missed."""
    return F.coalesce(source.isin(SKIPPED_SOURCES), F.lit(False))


def renames(absent: DataFrame, raw: DataFrame) -> DataFrame:
    """(path, new_path): absent records (path, size, sha256) whose content stands elsewhere in raw (path, size, sha256).

    Sizes meet first: they are known without reading content. Of several places the first by path counts.
    """
    sizes = absent.select("size").distinct()
    wanted = raw.join(sizes, "size", "left_semi").groupBy("size", "sha256").agg(F.min("path").alias("new_path"))
    return absent.join(wanted, ["size", "sha256"]).filter(F.col("path") != F.col("new_path")).select("path", "new_path")


def delete_guard(found: DataFrame, total: int, fraction: float = 0.1) -> tuple[int, bool]:
    """(rows to delete, whether that is more than the fraction allows)."""
    n = found.count()
    return n, n > fraction * max(1, total)


def tally(tables: dict[str, DataFrame]) -> DataFrame:
    """(finding, n) of a report's sections."""
    return reduce(DataFrame.unionByName, [t.agg(F.count("*").alias("n")).select(F.lit(k).alias("finding"), "n") for k, t in tables.items()])
