"""Files rebuilt from the operations that wrote and changed them, in order."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.runtime import slices

OUTPUTS = "/mnt/user-data/outputs/"
REBUILT = "conv_uuid string, file_path string, text string, written_as string, presented boolean, edits_applied int, edits_failed int, inactive boolean, compliant boolean"


def replayed(operations: list[dict]) -> list[dict]:
    """The files of one conversation. An edit applies only if its old text stands exactly once; failed calls do nothing;
    operations of an inactive branch add files but change none."""
    files: dict[str, dict] = {}
    seen = set()
    for op in operations:
        mark = (op["seq"], op["branch"], op["op"], op["file_path"], op["old_str"], op["new_str"], op["text"])
        if op["failed"] or mark in seen or not op["file_path"]:
            continue
        seen.add(mark)
        path, off = op["file_path"], op["branch"] not in (None, "active")
        held = files.get(path)
        if op["op"] == "create":
            if not off or held is None:
                files[path] = dict(file_path=path, text=op["text"] or "", written_as=path, presented=False, edits_applied=0, edits_failed=0, inactive=off)
        elif held is None or off and not held["inactive"]:
            continue
        elif op["op"] in ("edit", "str_replace"):
            if op["old_str"] and held["text"].count(op["old_str"]) == 1:
                held["text"] = held["text"].replace(op["old_str"], op["new_str"] or "")
                held["edits_applied"] += 1
            else:
                held["edits_failed"] += 1
        elif op["op"] in ("present", "present_files"):
            held["presented"] = True
        elif op["op"] in ("cp", "mv") and (op["new_str"] or op["text"]):
            target = op["new_str"] or op["text"]
            files[target] = {**held, "file_path": target, "presented": False}
            if op["op"] == "mv":
                del files[path]
        elif op["op"] in ("rm", "delete"):
            del files[path]
    for f in files.values():
        f["compliant"] = f["presented"] and f["written_as"] == f["file_path"] and f["file_path"].startswith(OUTPUTS)
    return list(files.values())


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, held = None, []

    def close() -> list[dict]:
        return [{"conv_uuid": now, **f} for f in replayed(held)] if held else []

    names = [c.split()[0] for c in REBUILT.split(", ")]
    kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_())

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names)

    for batch in batches:
        out: list[dict] = []
        for row in batch.to_pylist():
            if row["conv_uuid"] != now:
                out += close()
                now, held = row["conv_uuid"], []
            held.append(row)
        yield batch_of(out)
    yield batch_of(close())


def rebuilt_files(operations: DataFrame) -> DataFrame:
    """One row for each file that is left at the end of its conversation; repeated records of a call count once."""
    columns = ["conv_uuid", "seq", "op_id", "branch", "op", "file_path", "text", "old_str", "new_str", "failed"]
    kept = operations.filter(F.col("conv_uuid").isNotNull()).select(columns)
    return kept.repartition(slices(operations.sparkSession), "conv_uuid").sortWithinPartitions("conv_uuid", "seq", "op_id").mapInArrow(_stream, REBUILT)


def unrecoverable(operations: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """(conv_uuid, file_path, reason): files that a conversation presented though no text of theirs is left.

    An archive is told as such; its members stand among the rebuilt files under their own paths.
    """
    held = operations.filter("conv_uuid is not null and file_path is not null and coalesce(failed, false) = false")
    shown = held.filter((F.col("op").isin("present", "present_files")) & F.coalesce(F.col("branch").isin("active"), F.lit(True))).select("conv_uuid", "file_path").distinct()
    packed = held.filter("op = 'zip'").select("conv_uuid", "file_path").distinct().withColumn("packed", F.lit(True))
    lost = shown.join(rebuilt.select("conv_uuid", "file_path"), ["conv_uuid", "file_path"], "left_anti").join(packed, ["conv_uuid", "file_path"], "left")
    zipped = F.coalesce("packed", F.lit(False)) | F.lower("file_path").endswith(".zip")
    return lost.select("conv_uuid", "file_path", F.when(zipped, "a zip archive").otherwise("no text in the export; likely binary").alias("reason"))


def recovered_folders(rebuilt: DataFrame, lost: DataFrame) -> DataFrame:
    """(path, text) of recovered outputs: each file word for word in its conversation's folder, and a manifest of what is there and what is lost."""
    folder = F.concat(F.substring(F.replace("conv_uuid", F.lit("-"), F.lit("")), 1, 8), F.lit("_outputs/"))
    inner = F.regexp_replace(F.regexp_replace("file_path", f"^{OUTPUTS}", ""), "^/+", "")
    files = rebuilt.select(F.concat(folder, inner).alias("path"), "text")
    entry = F.struct(inner.alias("name"), F.col("file_path").alias("path"), "written_as", "presented", "edits_applied", F.when(F.col("edits_failed") > 0, F.col("edits_failed")).alias("edits_not_applied"), F.when(F.col("inactive"), True).alias("inactive_branch"), F.when(F.col("presented"), F.col("compliant")).alias("compliant"))
    kept = rebuilt.groupBy("conv_uuid").agg(F.array_sort(F.collect_list(entry)).alias("files"))
    gone = lost.groupBy("conv_uuid").agg(F.array_sort(F.collect_list(F.struct(F.col("file_path").alias("path"), "reason"))).alias("unrecoverable"))
    both = kept.join(gone, "conv_uuid", "full_outer")
    body = F.to_json(F.struct(F.col("conv_uuid").alias("conversation_id"), F.coalesce("files", F.array()).alias("files"), F.coalesce("unrecoverable", F.array()).alias("unrecoverable")))
    return files.unionByName(both.select(F.concat(folder, F.lit("_recovered-outputs.json")).alias("path"), body.alias("text")))
