"""Files that conversations refer to: which are there, what refers to them, where they go, and a profile of what an export holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import text, values

# Fixed value: an asset's id within a file's name.
NAME_ID = r"(file_[0-9a-f]{8,}|file-[A-Za-z0-9]{10,})"


def asset_index(files: DataFrame) -> DataFrame:
    """(root, asset_id, path): the first file by path of each id that a name holds. files: (root, path); JSON files are the export itself."""
    named = files.filter(~F.lower("path").endswith(".json")).select("root", "path", F.explode(F.regexp_extract_all(text.base_name(F.col("path")), F.lit(NAME_ID), F.lit(1))).alias("asset_id"))
    return named.groupBy("root", "asset_id").agg(F.min("path").alias("path"))


def index_counts(files: DataFrame) -> DataFrame:
    """(root, files_scanned, files_without_id)."""
    kept = files.filter(~F.lower("path").endswith(".json"))
    return kept.groupBy("root").agg(F.count("*").alias("files_scanned"), F.count_if(~text.base_name(F.col("path")).rlike(NAME_ID)).alias("files_without_id"))


def content_parts(nodes: DataFrame) -> DataFrame:
    """(conv_id, node_id, source, part): every object part, and every upload, of all nodes, one row each."""
    parts = nodes.select("conv_id", "node_id", F.lit("part").alias("source"), F.explode("parts").alias("part")).filter(F.col("part").startswith("{"))
    uploads = nodes.select("conv_id", "node_id", F.lit("attachment").alias("source"), F.explode("attachments").alias("a")).select("conv_id", "node_id", "source", F.to_json("a").alias("part"))
    return parts.unionByName(uploads)


def referenced(parts: DataFrame) -> DataFrame:
    """(conv_id, asset_id) of pointers and uploads, each once."""
    ids = F.when(F.col("source") == "attachment", F.array_compact(F.array(F.get_json_object("part", "$.id")))).otherwise(values.pointers(F.col("part")))
    return parts.select("conv_id", F.explode(ids).alias("asset_id")).filter("asset_id <> ''").distinct()


def resolved(references: DataFrame, index: DataFrame) -> DataFrame:
    """(conv_id, asset_id, path): what is referred to with its file, null where the export has none. An asset that very many refer to is met in parts."""
    salts = 8
    asked = references.withColumn("_salt", F.pmod(F.xxhash64("conv_id"), F.lit(salts)).cast("int"))
    held = index.groupBy("asset_id").agg(F.min("path").alias("path")).withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return asked.join(held, ["asset_id", "_salt"], "left").select("conv_id", "asset_id", "path")


def profile(parts: DataFrame) -> DataFrame:
    """(kind, key, n): parts by type, and the keys that parts of each type have; key is null in the row of the type itself."""
    data = F.try_parse_json("part")
    kind = F.when(F.col("source") == "attachment", F.lit("attachment")).otherwise(F.coalesce(F.try_variant_get(data, "$.content_type", "string"), F.lit("(none)")))
    typed = parts.select(kind.alias("kind"), F.map_keys(F.from_json("part", "map<string,string>")).alias("keys"))
    keys = typed.select("kind", F.explode("keys").alias("key")).groupBy("kind", "key").agg(F.count("*").alias("n"))
    return typed.groupBy("kind").agg(F.count("*").alias("n")).select("kind", F.lit(None).cast("string").alias("key"), "n").unionByName(keys)


def media_name(asset_id: Column, path: Column, mime: Column, content: Column) -> Column:
    """The name of a copied asset: its id, and the extension of its file, its media type or its first bytes."""
    return F.concat(asset_id, values.asset_extension(text.base_name(path), mime, content))


def placements(found: DataFrame, outputs: DataFrame, there: DataFrame) -> DataFrame:
    """(conv_id, asset_id, path, target, action): where each resolved asset goes, beside its conversation's file.

    found: (conv_id, asset_id, path, size, name); outputs: (conv_id, output) after names were allocated; there: (path, size) of what was
    copied before. A file of the same size is not copied again.
    """
    folder = F.concat(text.stem(F.col("output")), F.lit("_media/"))
    wanted = found.filter("path is not null").join(outputs, "conv_id").select("conv_id", "asset_id", "path", "size", F.concat(folder, "name").alias("target"))
    held = there.select(F.col("path").alias("target"), F.col("size").alias("held"))
    action = F.when(F.col("held") == F.col("size"), "keep").otherwise("copy")
    return wanted.join(held, "target", "left").select("conv_id", "asset_id", "path", "target", action.alias("action"))


def split_assets(references: DataFrame, index: DataFrame, buckets: DataFrame) -> DataFrame:
    """(bucket, assets, missing): what each project's own export takes along. buckets: (conv_id, bucket)."""
    found = resolved(references, index).join(buckets, "conv_id").select("bucket", "asset_id", "path").distinct()
    return found.groupBy("bucket").agg(F.count_if(F.col("path").isNotNull()).alias("assets"), F.count_if(F.col("path").isNull()).alias("missing"))
