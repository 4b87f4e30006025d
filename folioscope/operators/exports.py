"""Incremental exports: newest versions, what older ones still hold, placement, the manifest gate and the ledger."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UUID = r"(?i)([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})"


def export_times(messages: DataFrame) -> DataFrame:
    """(export_key, export_time, conversations, messages): an export is as late as its latest message."""
    return messages.groupBy("export_key").agg(F.coalesce(F.max("created_at"), F.max("exported_at")).alias("export_time"), F.countDistinct("conv_uuid").alias("conversations"), F.countDistinct("msg_uuid").alias("messages"))


def versions(messages: DataFrame) -> DataFrame:
    """(conv_uuid, export_key, exported_at, messages, last_activity): a conversation as each export delivers it."""
    held = messages.filter(F.col("conv_uuid").isNotNull())
    return held.groupBy("conv_uuid", "export_key").agg(F.max("exported_at").alias("exported_at"), F.countDistinct("msg_uuid").alias("messages"), F.max("created_at").alias("last_activity"))


def newest(table: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key. Aggregates before it shuffles, so a key may hold any share of the rows."""
    rest = [c for c in table.columns if c not in keys]
    picked = table.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias("row"))
    return picked.select(*keys, "row.*")


def newest_versions(messages: DataFrame) -> DataFrame:
    return newest(versions(messages), ["conv_uuid"], [F.col("exported_at"), F.col("export_key")])


def earlier_kept(messages: DataFrame) -> DataFrame:
    """(conv_uuid, export_key, lost_messages): older versions that hold a message which the newest lacks."""
    held = messages.filter(F.col("conv_uuid").isNotNull()).select("conv_uuid", "export_key", "msg_uuid").distinct()
    last = newest_versions(messages).select("conv_uuid", F.col("export_key").alias("newest_key"))
    tagged = held.join(last, "conv_uuid")
    now = tagged.filter(F.col("export_key") == F.col("newest_key")).select("conv_uuid", "msg_uuid")
    older = tagged.filter(F.col("export_key") != F.col("newest_key")).join(now, ["conv_uuid", "msg_uuid"], "left_anti")
    return older.groupBy("conv_uuid", "export_key").agg(F.count("*").alias("lost_messages"))


def merge_report(messages: DataFrame) -> DataFrame:
    """One row: exports, conversations, in_several_exports, messages, earlier_versions_kept."""
    per = versions(messages).groupBy("conv_uuid").agg(F.count("*").alias("n"))
    counts = per.agg(F.count("*").alias("conversations"), F.count_if(F.col("n") > 1).alias("in_several_exports"))
    rows = messages.agg(F.countDistinct("export_key").alias("exports"), F.countDistinct("msg_uuid").alias("messages"))
    kept = earlier_kept(messages).agg(F.count("*").alias("earlier_versions_kept"))
    one = F.lit(1).alias("one")
    return rows.select("*", one).join(counts.select("*", one), "one").join(kept.select("*", one), "one").drop("one")


def as_of_labels(messages: DataFrame) -> DataFrame:
    """(export_key, label): the day of an export; with its time where an earlier one has the day."""
    times = export_times(messages)
    day = F.date_format("export_time", "yyyy-MM-dd")
    w = Window.partitionBy(day).orderBy("export_time", "export_key")
    return times.withColumn("rn", F.row_number().over(w)).select("export_key", F.when(F.col("rn") == 1, day).otherwise(F.date_format("export_time", "yyyy-MM-dd-HHmm")).alias("label"))


def manifests(files: DataFrame) -> DataFrame:
    """(file_id, file_project, written_at, valid, version, project, revision, declared, listed, distinct_listed, entries) by shape, whatever a field is called.

    A value is looked for under each of the names that the formats use.
    """
    data = F.try_parse_json("raw_json")

    def first(kind: str, *names: str) -> Column:
        return F.coalesce(*[F.try_variant_get("v", f"$.{n}", kind) for n in names])

    parsed = files.withColumn("v", data)
    uuid = lambda c: F.lower(F.regexp_replace(F.regexp_replace(c, r"^urn:uuid:|[{}]", ""), "-", ""))
    entry_ids = F.from_json(F.to_json(F.try_variant_get("v", "$.conversations", "variant")), "array<struct<uuid:string,conversation_uuid:string,id:string>>")
    return parsed.select(
        "file_id", "file_name", F.lower(F.regexp_extract("file_name", _UUID, 1)).alias("file_project"), "written_at", F.col("v").isNotNull().alias("valid"),
        first("string", "manifest_format_version", "formatVersion", "format_version").alias("version"),
        uuid(first("string", "project_uuid", "project_id", "projectUuid")).alias("project"),
        F.regexp_extract(first("string", "revision", "revision_no", "rev"), r"(\d+)", 1).try_cast("int").alias("revision"),
        first("string", "conversation_count", "n_conversations", "conversationCount").try_cast("int").alias("declared"),
        F.transform(entry_ids, lambda e: F.coalesce(e["uuid"], e["conversation_uuid"], e["id"])).alias("entries"),
    )


def manifest_problems(found: DataFrame) -> DataFrame:
    """(file_id, problem): what a manifest contradicts itself in."""
    tests = [
        ("unreadable", ~F.col("valid")),
        ("count differs", F.col("declared") != F.size("entries")),
        ("entry listed twice", F.size("entries") != F.size(F.array_distinct("entries"))),
        ("named for another project", F.col("project") != F.replace(F.col("file_project"), F.lit("-"), F.lit(""))),
        ("no project", F.col("valid") & F.col("project").isNull()),
    ]
    codes = F.array_compact(F.array(*[F.when(test, name) for name, test in tests]))
    return found.select("file_id", F.explode(codes).alias("problem"))


def revision_check(found: DataFrame) -> DataFrame:
    """(file_id, file_project, revision, before, rises): a revision against the latest one before it."""
    w = Window.partitionBy("file_project").orderBy(F.col("written_at").asc_nulls_first(), "file_id")
    before = F.last("revision", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    kept = found.filter("valid").withColumn("before", before)
    return kept.select("file_id", "file_project", "revision", "before", F.coalesce(F.col("revision") > F.col("before"), F.lit(True)).alias("rises"))


def resolution(found: DataFrame, problems: DataFrame) -> DataFrame:
    """(file_project, file_id, state, prior, climbs): the newest readable manifest of each project, ``chosen`` or ``rejected`` by its own problems.

    One without a time is older than any other. Older ones with problems are passed over. A numbered newest one must be higher than the
    latest numbered one before it that has no problems. Aggregates before it shuffles, so a project may have any share of the files.
    """
    bad = problems.select("file_id").distinct().withColumn("bad", F.lit(True))
    kept = found.filter("valid").join(bad, "file_id", "left").select("file_project", "file_id", "written_at", "revision", F.coalesce("bad", F.lit(False)).alias("bad"))
    order = F.struct(F.coalesce(F.unix_micros("written_at"), F.lit(-(1 << 62))).alias("at"), F.col("file_id").alias("i"))
    placed = kept.withColumn("o", order)
    last = placed.groupBy("file_project").agg(F.max_by(F.struct("file_id", "revision", "bad"), "o").alias("m"), F.max("o").alias("last"))
    numbered = placed.filter("not bad and revision is not null").join(last.select("file_project", "last"), "file_project").filter(F.col("o") < F.col("last"))
    before = numbered.groupBy("file_project").agg(F.max_by("revision", "o").alias("prior"))
    climbs = F.coalesce(F.col("m.revision") > F.col("prior"), F.lit(True))
    return last.join(before, "file_project", "left").select("file_project", "m.file_id", F.when(F.col("m.bad"), "rejected").otherwise("chosen").alias("state"), "prior", climbs.alias("climbs"))


def placement(found: DataFrame) -> DataFrame:
    """(conv_uuid, project, projects): the project of the first manifest that claims a conversation, and how many do."""
    newest_file = newest(found.filter("valid").select("file_project", "file_id", "written_at", "entries"), ["file_project"], [F.col("written_at"), F.col("file_id")])
    claims = newest_file.select("file_project", "written_at", F.explode("entries").alias("conv_uuid")).filter(F.col("conv_uuid").isNotNull())
    return claims.groupBy("conv_uuid").agg(F.min_by("file_project", F.struct("written_at", "file_project")).alias("project"), F.countDistinct("file_project").alias("projects"))


def gate_problems(found: DataFrame, messages: DataFrame, projects: DataFrame) -> DataFrame:
    """(problem, subjects): every test of the gate with the number it stops at."""
    placed = placement(found)
    held = messages.filter(F.col("conv_uuid").isNotNull()).groupBy("conv_uuid").agg(F.max("created_at").alias("last_activity"))
    listed = found.filter("valid").select("file_project").distinct()
    activity = newest(found.filter("valid").select("file_project", "file_id", "written_at", "entries"), ["file_project"], [F.col("written_at"), F.col("file_id")])
    stale = activity.select("file_project", "written_at", F.explode("entries").alias("conv_uuid")).join(held, "conv_uuid").filter(F.col("last_activity") > F.col("written_at")).select("file_project").distinct()
    tests = {
        "project without manifest": projects.select(F.lower("project_uuid").alias("file_project")).distinct().join(listed, "file_project", "left_anti"),
        "conversation in no project": held.join(placed, "conv_uuid", "left_anti"),
        "listed conversation is absent": placed.join(held, "conv_uuid", "left_anti"),
        "manifest of unknown project": listed.join(projects.select(F.lower("project_uuid").alias("file_project")), "file_project", "left_anti"),
        "claimed by two projects": placed.filter("projects > 1"),
        "manifest older than its conversations": stale,
    }
    return reduce(DataFrame.unionByName, [t.agg(F.count("*").alias("subjects")).select(F.lit(name).alias("problem"), "subjects") for name, t in tests.items()])


class GateError(ValueError):
    """The gate found problems."""


def gate(problems: DataFrame, lenient: bool = False) -> DataFrame:
    """Stops on any problem unless lenient."""
    bad = [r["problem"] for r in problems.filter("subjects > 0").collect()]  # one row for each test
    if bad and not lenient:
        raise GateError("; ".join(bad))
    return problems


def self_placed(placed: DataFrame, wrote: DataFrame) -> DataFrame:
    """(conv_uuid, project, conflict): conversations that wrote a manifest belong to its project; wrote: (conv_uuid, project)."""
    both = wrote.select("conv_uuid", F.col("project").alias("own")).join(placed.select("conv_uuid", "project"), "conv_uuid", "left")
    return both.select("conv_uuid", F.coalesce("project", "own").alias("project"), F.coalesce(F.col("project") != F.col("own"), F.lit(False)).alias("conflict"))


def ledger_new(exports: DataFrame, ledger: DataFrame) -> DataFrame:
    """Exports that are not recorded under the same fingerprint."""
    return exports.join(ledger.select("export_key", "fingerprint"), ["export_key", "fingerprint"], "left_anti")


def ledger_record(ledger: DataFrame, taken: DataFrame) -> DataFrame:
    """The ledger after exports were taken in: the later row of a key counts."""
    return newest(ledger.unionByName(taken, allowMissingColumns=True), ["export_key"], [F.col("recorded_at"), F.col("fingerprint")])


def fingerprints(messages: DataFrame) -> DataFrame:
    """(export_key, fingerprint): one digest of an export's messages, by sums that any order of rows gives."""
    row = F.xxhash64("conv_uuid", "msg_uuid", "text")
    return messages.groupBy("export_key").agg(F.concat_ws("-", F.count("*").cast("string"), F.sum(F.pmod(row, F.lit(1 << 40))).cast("string")).alias("fingerprint"))


def split_counts(messages: DataFrame) -> DataFrame:
    """(bucket, conversations, messages): what each project's own export would hold."""
    bucket = F.coalesce("project_uuid", F.lit("_ungrouped")).alias("bucket")
    return messages.filter(F.col("conv_uuid").isNotNull()).groupBy(bucket).agg(F.countDistinct("conv_uuid").alias("conversations"), F.countDistinct("msg_uuid").alias("messages"))


def changed_memories(texts: DataFrame) -> DataFrame:
    """(scope, text, at): the newest text of each scope, and older ones that differ from it. texts: (scope, text, at)."""
    last = newest(texts, ["scope"], [F.col("at")]).select("scope", F.col("text").alias("newest"))
    return texts.join(last, "scope").filter((F.col("text") != F.col("newest"))).select("scope", "text", "at").unionByName(newest(texts, ["scope"], [F.col("at")]).select("scope", "text", "at"))
