"""Catalogue work on folders and files: kinds, names, summaries, coverage, mirrors and collisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import text
from folioscope.functions.values import human_size, name_date

# Extensions of media and of account files.
MEDIA = "png jpg jpeg gif webp svg bmp tiff tif wav mp3 m4a ogg flac aac opus mp4 mov webm avi mkv m4v xcf psd ai sketch afdesign afphoto".split()
ACCOUNT_FILES = "user.json user_settings.json export_manifest.json shared_conversations.json message_feedback.json model_comparisons.json chat.html".split()
SHEET = "application/vnd.google-apps.spreadsheet"


def kind(path: Column) -> Column:
    """What is done with a file, by the first test that holds."""
    name, ext = F.lower(text.base_name(path)), text.extension(text.base_name(path))
    return (
        F.when(name.startswith("~$") | name.startswith("."), "skipped").when(ext == ".docx", "docx").when(ext.isin(".xlsx", ".xlsm"), "xlsx").when(ext == ".pdf", "pdf").when(name.isin(ACCOUNT_FILES), "account").when(ext.isin(".html", ".htm"), "html")
        .when(ext == ".rtf", "rtf").when(name.rlike(r"^conversations(-\d+)?\.json$"), "conversations").when(ext == ".md", "md").when(ext == ".txt", "txt")
        .when(ext.isin([f".{m}" for m in MEDIA]), "media").otherwise("sidecar")
    )


def output_name(path: Column) -> Column:
    """Where a converted file goes: the same place with .md."""
    return F.concat(F.regexp_replace(path, r"\.[^./]*$", ""), F.lit(".md"))


def allocated(files: DataFrame, wanted: str, order: list[str]) -> DataFrame:
    """files with ``allocated``: the wanted path, or with -2, -3 where an earlier file has it.

    A suffixed name that another file wants for itself moves on past all such names, so no two files share one.
    """
    w = Window.partitionBy(wanted).orderBy(*order)
    numbered = files.withColumn("_n", F.row_number().over(w))
    stemmed = F.regexp_replace(F.col(wanted), r"\.[^./]*$", "")
    base, number = F.regexp_extract(stemmed, r"^(.*?)(?:-(\d+))?$", 1), F.regexp_extract(stemmed, r"-(\d{1,9})$", 1)
    ext = F.regexp_extract(F.col(wanted), r"(\.[^./]*)$", 1)
    taken = files.select(base.alias("_base"), ext.alias("_ext"), F.nullif(number, F.lit("")).cast("int").alias("_taken")).filter("_taken is not null").groupBy("_base", "_ext").agg(F.max("_taken").alias("_most"))
    joined = numbered.withColumn("_base", stemmed).withColumn("_ext", ext).join(taken, ["_base", "_ext"], "left")
    suffix = F.greatest(F.coalesce("_most", F.lit(1)), F.lit(1)) + F.col("_n") - 1
    made = F.when(F.col("_n") == 1, F.col(wanted)).otherwise(F.concat("_base", F.lit("-"), suffix.cast("string"), "_ext"))
    return joined.withColumn("allocated", made).drop("_base", "_ext", "_most", "_n")


def folder_summary(files: DataFrame) -> DataFrame:
    """(folder, files, md_files, bytes, size, first_day, last_day) of files (path, size)."""
    day = name_date(text.base_name(F.col("path")))
    found = files.groupBy(text.parent(F.col("path")).alias("folder")).agg(
        F.count("*").alias("files"), F.count_if(text.extension(text.base_name(F.col("path"))) == ".md").alias("md_files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.min(day).alias("first_day"), F.max(day).alias("last_day"),
    )
    return found.withColumn("size", human_size(F.col("bytes")))


def coverage(folders: DataFrame, lists: DataFrame) -> DataFrame:
    """(folder, selected_by, state): folders (folder) against selection lists (list_name, folder)."""
    named = lists.groupBy("folder").agg(F.array_sort(F.collect_set("list_name")).alias("selected_by"))
    both = folders.select("folder", F.lit(True).alias("there")).distinct().join(named, "folder", "full_outer")
    state = F.when(F.col("there").isNull(), "unmatched").when(F.col("selected_by").isNull(), "unselected").otherwise("selected")
    return both.select("folder", "selected_by", state.alias("state"))


def mirror(source: DataFrame, target: DataFrame) -> DataFrame:
    """(path, action): + new, ~ changed, - only in the target, = alike; source and target: (path, size, digest)."""
    a = source.select("path", F.struct("size", "digest").alias("a"))
    b = target.select("path", F.struct("size", "digest").alias("b"))
    action = F.when(F.col("b").isNull(), "+").when(F.col("a").isNull(), "-").when(F.col("a") == F.col("b"), "=").otherwise("~")
    return a.join(b, "path", "full_outer").select("path", action.alias("action"))


def collisions(files: DataFrame, sheets: DataFrame) -> DataFrame:
    """(path, sheet_path, verdict): spreadsheet files against sheets of the same folder and stem, else of the same full name."""
    a = files.select("path", F.col("modified").alias("at"), text.parent(F.col("path")).alias("folder"), text.base_name(F.col("path")).alias("name"))
    b = sheets.select(F.col("path").alias("sheet_path"), F.col("modified").alias("sheet_at"), text.parent(F.col("path")).alias("folder"), text.base_name(F.col("path")).alias("name"))
    keyed = a.withColumn("keys", F.array(F.struct(F.lit(0).alias("rank"), text.stem(F.col("name")).alias("key")), F.struct(F.lit(1).alias("rank"), F.col("name").alias("key"))))
    met = keyed.select("path", "at", "folder", F.explode("keys").alias("k")).join(b.withColumnRenamed("name", "key_name"), (F.col("k.key") == F.col("key_name")) & (keyed["folder"] == b["folder"]))
    best = met.groupBy("path", "at").agg(F.min(F.struct("k.rank", "sheet_path", "sheet_at")).alias("s"))
    verdict = F.when(F.col("at").isNull() | F.col("s.sheet_at").isNull(), "unknown").when(F.col("at") >= F.col("s.sheet_at"), "SAFE").otherwise("KEEP")
    return best.select("path", F.col("s.sheet_path").alias("sheet_path"), verdict.alias("verdict"))


def sidecar(path: Column, size: Column, sha: Column) -> Column:
    """The record that stands for a file which cannot be converted."""
    name = text.base_name(path)
    head = text.emit_frontmatter([("title", text.yaml_quote(name)), ("source", text.yaml_quote(F.lit("unconvertible"))), ("file_type", text.yaml_quote(text.extension(name))), ("source_path", text.yaml_quote(path)), ("size_bytes", size.cast("string")), ("source_sha256", text.yaml_quote(sha))])
    return F.concat(head, F.lit("\n# "), name, F.lit("\n"))


def first_claims(claims: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key; later claims are ignored."""
    rest = [c for c in claims.columns if c != key]
    return claims.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("row")).select(key, "row.*")


def renamed_folders(folders: DataFrame, names: DataFrame) -> DataFrame:
    """(folder, target, state): raw ids against a table of names (id, name), the last of which counts."""
    last = names.groupBy("id").agg(F.max_by("name", "line").alias("name"))
    kept = folders.join(last, folders["folder"] == last["id"], "left")
    state = F.when(F.col("name").isNull(), "unnamed").when(F.col("name") == F.col("folder"), "already").otherwise("renamed")
    return kept.select("folder", F.coalesce("name", "folder").alias("target"), state.alias("state"))
