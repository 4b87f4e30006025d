"""Sinks: Markdown files, the index of a corpus, and exports split by project."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import text


def digest_text(meta: Column, body: Column) -> Column:
    """A frontmatter block of the metadata's fields in order of name, a blank line, and the body."""
    lines = F.transform(F.array_sort(F.map_keys(meta)), lambda k: F.concat(k, F.lit(": "), text.yaml_quote(F.element_at(meta, k))))
    return F.concat(F.lit("---\n"), F.array_join(lines, "\n"), F.lit("\n---\n\n"), body)


def _put(root: str):
    """Write rows (path, bytes) below a folder that every executor shares; what is alike is left untouched, and a repeated task ends in the same files."""

    def put(rows: Iterator) -> None:
        for row in rows:
            target = os.path.normpath(os.path.join(root, row["path"]))
            if not target.startswith(os.path.normpath(root) + os.sep):
                raise ValueError(f"outside of the target: {row['path']}")
            os.makedirs(os.path.dirname(target), exist_ok=True)
            data = bytes(row["data"])
            try:
                with open(target, "rb") as old:
                    if old.read() == data:
                        continue
            except FileNotFoundError:
                pass
            with open(f"{target}.part", "wb") as new:
                new.write(data)
            os.replace(f"{target}.part", target)

    return put


def write_text_files(files: DataFrame, root: str) -> None:
    """One file for each row (path, text)."""
    files.select("path", F.encode("text", "utf-8").alias("data")).foreachPartition(_put(root))


def copy_files(files: DataFrame, root: str) -> None:
    """Files (path, content) byte for byte: media and whatever is not converted."""
    files.select("path", F.col("content").alias("data")).foreachPartition(_put(root))


def write_report(sections: dict[str, DataFrame], path: str, shown: int = 40) -> str:
    """A report of named tables as Markdown: how many rows each has, and the first ``shown`` of them. The text is returned as well."""
    parts = []
    for name, found in sections.items():
        n = found.count()
        rows = [", ".join(str(v) for v in row) for row in found.orderBy(*found.columns[:1]).limit(shown).collect()]
        more = [f"- ... and {n - shown} more"] if n > shown else []
        parts.append("\n".join([f"## {name} ({n})", "", *(f"- {r}" for r in rows), *more]))
    text_of = "\n\n".join(parts) + "\n"
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text_of)
    return text_of


def write_index(files: DataFrame, path: str) -> None:
    """(path, size_bytes, meta) as JSON lines."""
    files.select("path", "size_bytes", "meta").write.mode("overwrite").json(path)


def write_by_project(messages: DataFrame, path: str) -> None:
    """Each project's messages in a folder of its own; another run replaces them."""
    messages.withColumn("bucket", F.coalesce("project_uuid", F.lit("_ungrouped"))).write.mode("overwrite").partitionBy("bucket").parquet(path)


def without_index(body: Column) -> Column:
    """The body for readers that take plain text: no frontmatter, no generated block."""
    return F.regexp_replace(F.regexp_replace(text.body(body), text.INDEX_BLOCK, ""), r"^\s+", "")
