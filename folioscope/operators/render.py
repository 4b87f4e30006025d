"""Rows to Markdown: blocks, messages, whole conversations; and the paths through conversations stored as nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import text
from folioscope.operators import trees


def block(b: Column) -> Column:
    """One block of a message: text as it is, thinking folded away, tool calls by name."""
    kind = b["block_type"]
    thinking = F.concat(F.lit("<details><summary>Thinking</summary>\n\n"), F.coalesce(b["thinking"], F.lit("")), F.lit("\n\n</details>"))
    tool = F.concat(F.lit("**Tool:** `"), F.coalesce(b["tool_name"], F.lit("unknown")), F.lit("`"))
    return F.when(kind == "text", b["text"]).when(kind == "thinking", thinking).when(kind == "tool_use", tool).otherwise(F.concat(F.lit("**"), F.coalesce(kind, F.lit("block")), F.lit("**")))


def role(sender: Column) -> Column:
    return F.when(F.lower(F.trim(sender)).isin("human", "user"), "Human").when(F.trim(sender) == "", "Unknown").when(sender.isNull(), "Unknown").otherwise("Assistant")


def message(sender: Column, at: Column, plain: Column, blocks: Column) -> Column:
    """A role heading, the time, and the blocks; rows without blocks show their text."""
    shown = F.filter(F.transform(F.coalesce(blocks, F.array()), block), lambda x: x.isNotNull() & (F.trim(x) != ""))
    body = F.when(F.size(shown) > 0, F.array_join(shown, "\n\n")).otherwise(F.coalesce(plain, F.lit("")))
    stamp = F.coalesce(F.concat(F.lit("*"), F.date_format(at, "yyyy-MM-dd HH:mm"), F.lit(" UTC*\n\n")), F.lit(""))
    return F.concat(F.lit("## "), role(sender), F.lit("\n\n"), stamp, body)


def rendered_messages(messages: DataFrame) -> DataFrame:
    """(row_id, markdown)."""
    return messages.select("row_id", message(F.col("sender"), F.col("created_at"), F.col("text"), F.col("content")).alias("markdown"))


def rendered_conversations(messages: DataFrame, most: int = 100_000) -> DataFrame:
    """(conv_uuid, part_no, messages, branches, markdown): the branch that counts, then the others under a heading of their own.

    A conversation of more than ``most`` messages comes in parts of that many, so that no row is unbounded.
    """
    placed = trees.branch_table(messages)
    rendered = messages.filter("conv_uuid is not null and msg_uuid is not null").dropDuplicates(["conv_uuid", "msg_uuid"]).select("conv_uuid", "msg_uuid", message(F.col("sender"), F.col("created_at"), F.col("text"), F.col("content")).alias("markdown"))
    # one running place over all branches, so that parts hold as many messages whatever branches a conversation has
    sizes = placed.groupBy("conv_uuid", "branch_no").agg(F.count("*").alias("n"))
    above = Window.partitionBy("conv_uuid").orderBy("branch_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("conv_uuid", "branch_no", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("start"))
    full = placed.join(rendered, ["conv_uuid", "msg_uuid"]).join(starts, ["conv_uuid", "branch_no"])
    head = F.when((F.col("branch_no") > 0) & (F.col("place") == 0), F.concat(F.lit("# Inactive branch "), F.col("branch_no").cast("string"), F.lit("\n\n"))).otherwise("")
    parts = full.select("conv_uuid", F.floor((F.col("start") + F.col("place")) / most).cast("int").alias("part_no"), F.struct("branch_no", "place", F.concat(head, "markdown").alias("shown")).alias("m"))
    grouped = parts.groupBy("conv_uuid", "part_no").agg(F.array_sort(F.collect_list("m")).alias("ms"))
    return grouped.select("conv_uuid", "part_no", F.size("ms").alias("messages"), F.size(F.array_distinct(F.transform("ms", lambda m: m["branch_no"]))).alias("branches"), F.array_join(F.transform("ms", lambda m: m["shown"]), "\n\n").alias("markdown"))


def embedded_manifests(operations: DataFrame) -> DataFrame:
    """(conv_uuid, file_path, op_id, project, presented, edited_after): manifests that conversations wrote as output files.

    The last version that parses counts; later edits and being presented are told by the order of calls.
    """
    kept = operations.filter("conv_uuid is not null and coalesce(failed, false) = false")
    data = F.try_parse_json("text")
    project = F.coalesce(*[F.try_variant_get(data, f"$.{n}", "string") for n in ("project_uuid", "project_id", "projectUuid")])
    written = kept.filter((F.col("op") == "create") & F.col("file_path").rlike(r"^/mnt/user-data/outputs/.*\.json$")).withColumn("project", project).filter("project is not null")
    last = written.groupBy("conv_uuid", "file_path").agg(F.max(F.struct("seq", "op_id", "project")).alias("w"))
    after = kept.filter(F.col("op").isin("edit", "present")).select("conv_uuid", "file_path", "op", F.col("seq").alias("later"))
    met = last.join(after, ["conv_uuid", "file_path"], "left")
    flags = met.groupBy("conv_uuid", "file_path", "w").agg(F.coalesce(F.bool_or((F.col("op") == "present") & (F.col("later") > F.col("w.seq"))), F.lit(False)).alias("presented"), F.coalesce(F.bool_or((F.col("op") == "edit") & (F.col("later") > F.col("w.seq"))), F.lit(False)).alias("edited_after"))
    return flags.select("conv_uuid", "file_path", F.col("w.op_id").alias("op_id"), F.col("w.project").alias("project"), "presented", "edited_after")


def json_bullets(value: object, depth: int = 0) -> list[str]:
    """A JSON value as nested bullets."""
    pad = "  " * depth
    if isinstance(value, dict):
        out = []
        for key, inner in value.items():
            out += [f"{pad}- **{key}:** {_scalar(inner)}"] if not isinstance(inner, (dict, list)) or not inner else [f"{pad}- **{key}:**", *json_bullets(inner, depth + 1)]
        return out
    if isinstance(value, list):
        return [line for inner in value for line in (json_bullets(inner, depth + 1) if isinstance(inner, (dict, list)) else [f"{pad}- {_scalar(inner)}"])]
    return [f"{pad}- {_scalar(value)}"]


def _scalar(value: object) -> str:
    return "" if value is None or value == {} or value == [] else str(value).lower() if isinstance(value, bool) else str(value)


def scanned(pages: DataFrame) -> DataFrame:
    """(pdf_id, chars, pages, scanned): files whose first ten pages hold fewer than 20 characters each."""
    first = pages.filter("page_no <= 10").groupBy("pdf_id").agg(F.coalesce(F.sum(F.length(F.trim("text"))), F.lit(0)).alias("chars"), F.countDistinct("page_no").alias("pages"))
    return first.withColumn("scanned", F.col("chars") < 20 * F.col("pages"))


def plain_reader(docs: DataFrame) -> DataFrame:
    """(doc_id, plain): documents for readers that take text alone, without frontmatter and generated blocks."""
    return docs.select("doc_id", F.regexp_replace(F.regexp_replace(text.body(F.col("text")), text.INDEX_BLOCK, ""), r"^\s+", "").alias("plain"))
