"""Conversations stored as maps of nodes: parts, blocks, the path that counts, and what hangs beside it, as Markdown.

A node is a row (conv_id, node_id, parent, place, role, tool_name, at, parts, attachments, is_current): parts are JSON values as
text, strings as they are; attachments are (id, name, mime); place is the node's position in the export.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import values
from folioscope.operators.trees import active_paths

# Headings, markers and notes of the rendered format.
HEADINGS = {"user": "## User", "assistant": "## Assistant", "system": "## System", "tool": "## Tool"}
STEP = "\x01"
BESIDE = "_The messages below are alternate branches preserved from the export (typically regenerations). They are not part of the active conversation._"
VOICE = ["[real_time_user_audio_video_asset_pointer content omitted]", "[audio_asset_pointer content omitted]", "[audio_transcription content omitted]"]
ABSENT = " — not included in the export"


def _object(part: Column) -> Column:
    """A part as a JSON object; null where it is plain text."""
    return F.when(part.startswith("{"), F.try_parse_json(part))


def part_text(part: Column, links: Column | None = None) -> Column:
    """One part: its text, or a line for each asset it names. links: map of asset id -> link of those that are there."""
    data = _object(part)
    kind = F.coalesce(F.try_variant_get(data, "$.content_type", "string"), F.lit("non-text"))
    spoken = F.nullif(F.try_variant_get(data, "$.text", "string"), F.lit(""))
    link = (lambda i: F.element_at(links, i)) if links is not None else (lambda i: F.lit(None).cast("string"))
    shown = lambda i: F.when(link(i).isNull(), F.concat(F.lit("["), kind, F.lit(" `"), i, F.lit(f"`{ABSENT}]"))).when(kind.startswith("image"), F.concat(F.lit("![image]("), link(i), F.lit(")"))).otherwise(F.concat(F.lit("["), F.replace(kind, F.lit("_"), F.lit(" ")), F.lit("]("), link(i), F.lit(")")))
    ids = values.pointers(part)
    named = F.when(F.size(ids) > 0, F.array_join(F.transform(ids, shown), "\n")).otherwise(F.concat(F.lit("["), kind, F.lit(": no asset reference in the export]")))
    return F.when(data.isNull(), part).otherwise(F.coalesce(spoken, named))


def attachment_list(attachments: Column, links: Column | None = None) -> Column:
    """Uploads as bullets, null where there are none."""
    link = (lambda a: F.element_at(links, a["id"])) if links is not None else (lambda a: F.lit(None).cast("string"))
    name = lambda a: F.coalesce(F.nullif(a["name"], F.lit("")), F.nullif(a["id"], F.lit("")), F.lit("unnamed attachment"))
    line = lambda a: F.when(link(a).isNotNull(), F.concat(F.lit("- ["), name(a), F.lit("]("), link(a), F.lit(")"))).otherwise(F.concat(F.lit("- "), name(a), F.coalesce(F.concat(F.lit(" ("), F.nullif(a["mime"], F.lit("")), F.lit(")")), F.lit("")), F.lit(ABSENT)))
    return F.when(F.size(attachments) > 0, F.concat(F.lit("**Attachments:**\n"), F.array_join(F.transform(attachments, line), "\n")))


def node_text(parts: Column, attachments: Column, links: Column | None = None) -> Column:
    """All parts and uploads of a message, one below the other."""
    shown = F.concat(F.transform(F.coalesce(parts, F.array().cast("array<string>")), lambda p: part_text(p, links)), F.array_compact(F.array(attachment_list(attachments, links))))
    return F.trim(F.regexp_replace(F.array_join(shown, "\n"), r"^\s+|\s+$", ""))


def node_block(role: Column, tool_name: Column, at: Column, shown: Column) -> Column:
    """A message as a block; null where it says nothing, ``STEP`` for a step of reasoning whose text the export leaves out."""
    heading = F.element_at(F.create_map(*[F.lit(x) for pair in HEADINGS.items() for x in pair]), role)
    heading = F.coalesce(heading, F.concat(F.lit("## "), F.upper(F.substring(role, 1, 1)), F.lower(F.substring(role, 2, 1 << 20))))
    tool = F.when((role == "tool") & (F.coalesce(tool_name, F.lit("")) != ""), F.concat(F.lit(" ("), tool_name, F.lit(")"))).otherwise("")
    stamp = F.coalesce(F.concat(F.lit("\n*"), F.nullif(values.epoch_text(at), F.lit("")), F.lit("*")), F.lit(""))
    full = F.concat(heading, tool, stamp, F.when(shown != "", F.concat(F.lit("\n\n"), shown)).otherwise(""))
    return F.when((shown == "") & (role == "system"), None).when((shown == "") & (role == "assistant"), STEP).otherwise(full)


def _steps(n: Column) -> Column:
    return F.when(n == 0, F.array().cast("array<string>")).when(n == 1, F.array(F.lit("*[1 reasoning step]*"))).otherwise(F.array(F.concat(F.lit("*["), n.cast("string"), F.lit(" reasoning steps]*"))))


def collapsed(blocks: Column) -> Column:
    """Blocks with each run of steps as one marked line."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("run"))
    step = lambda acc, b: F.when(b == STEP, F.struct(acc["out"].alias("out"), (acc["run"] + 1).alias("run"))).otherwise(F.struct(F.concat(acc["out"], _steps(acc["run"]), F.array(b)).alias("out"), F.lit(0).alias("run")))
    return F.aggregate(blocks, start, step, lambda acc: F.concat(acc["out"], _steps(acc["run"])))


def rendered_nodes(nodes: DataFrame, links: Column | None = None) -> DataFrame:
    """(conv_id, node_id, place, role, at, block) of the nodes that say something."""
    shown = nodes.filter(F.col("role").isNotNull()).withColumn("shown", node_text(F.col("parts"), F.col("attachments"), links))
    return shown.select("conv_id", "node_id", "place", "role", "at", "shown", node_block(F.col("role"), F.col("tool_name"), F.col("at"), F.col("shown")).alias("block")).filter("block is not null")


def rendered_conversations(nodes: DataFrame, titles: DataFrame | None = None, links: Column | None = None) -> DataFrame:
    """(conv_id, body, active_message_count, total_node_count, reasoning_step_count, is_voice, last_message_time).

    The path to the current node in order, then all other messages under a heading of their own, in the order of the export. titles:
    (conv_id, title). Without a current node all messages hang beside. A conversation is one row, as large as what it holds.
    """
    blocks = rendered_nodes(nodes, links)
    path = active_paths(nodes.select("conv_id", "node_id", "parent", "is_current"))
    placed = blocks.join(path, ["conv_id", "node_id"], "left")
    entry = lambda order: F.struct(order.alias("o"), "node_id", "block")
    grouped = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("depth").isNotNull(), entry(F.col("depth").cast("long"))))).alias("active"), F.array_sort(F.collect_list(F.when(F.col("depth").isNull(), entry(F.col("place").cast("long"))))).alias("beside"),
        F.count_if(F.col("block") == STEP).alias("reasoning_step_count"), F.bool_or(F.exists(F.array(*map(F.lit, VOICE)), lambda v: F.contains(F.col("shown"), v))).alias("is_voice"),
    )
    counts = nodes.groupBy("conv_id").agg(F.count("*").alias("total_node_count"), values.epoch_text(F.max(F.when(F.col("role").isNotNull(), F.col("at")))).alias("last_message_time"))
    active = nodes.filter(F.col("role").isNotNull()).join(path, ["conv_id", "node_id"]).groupBy("conv_id").agg(F.count("*").alias("active_message_count"))
    full = counts.join(grouped, "conv_id", "left").join(active, "conv_id", "left")
    full = full.join(titles, "conv_id", "left") if titles is not None else full.withColumn("title", F.lit(None).cast("string"))
    texts = lambda c: collapsed(F.transform(F.coalesce(c, F.array().cast("array<struct<o:bigint,node_id:string,block:string>>")), lambda x: x["block"]))
    head = F.array(F.concat(F.lit("# "), F.coalesce(F.nullif(F.col("title"), F.lit("")), F.lit("Untitled conversation"))), F.lit(""))
    rest = F.when(F.size("beside") > 0, F.concat(F.array(*[F.lit(x) for x in ("", "---", "", "## Inactive branches", "", BESIDE, "")]), texts(F.col("beside")))).otherwise(F.array().cast("array<string>"))
    return full.select(
        "conv_id", F.array_join(F.concat(head, texts(F.col("active")), rest), "\n\n").alias("body"), F.coalesce("active_message_count", F.lit(0)).alias("active_message_count"), "total_node_count",
        F.coalesce("reasoning_step_count", F.lit(0)).alias("reasoning_step_count"), F.coalesce("is_voice", F.lit(False)).alias("is_voice"), "last_message_time",
    )


def from_messages(messages: DataFrame) -> DataFrame:
    """Message rows as nodes: the latest message of a conversation is its current node."""
    kept = messages.filter("conv_uuid is not null and msg_uuid is not null").dropDuplicates(["conv_uuid", "msg_uuid"])
    sender = F.lower(F.trim(F.coalesce("sender", F.lit(""))))
    role = F.when(sender.isin("human", "user"), "user").when(sender.isin("system", "tool"), sender).otherwise("assistant")
    said = F.filter(F.transform(F.coalesce("content", F.array()), lambda b: b["text"]), lambda x: x.isNotNull())
    parts = F.when(F.size(said) > 0, said).when(F.col("text").isNotNull(), F.array("text")).otherwise(F.array().cast("array<string>"))
    last = kept.groupBy("conv_uuid").agg(F.max(F.struct(F.coalesce("created_at", F.lit("1900-01-01").cast("timestamp")), "msg_uuid")).alias("l")).select("conv_uuid", F.col("l.msg_uuid").alias("now"))
    start = F.lit("00000000-0000-4000-8000-000000000000")
    return kept.join(last, "conv_uuid").select(
        F.col("conv_uuid").alias("conv_id"), F.col("msg_uuid").alias("node_id"), F.nullif("parent_uuid", start).alias("parent"), F.col("row_id").alias("place"), role.alias("role"), F.lit(None).cast("string").alias("tool_name"),
        (F.unix_micros("created_at") / 1_000_000).alias("at"), parts.alias("parts"), F.array().cast("array<struct<id:string,name:string,mime:string>>").alias("attachments"), (F.col("msg_uuid") == F.col("now")).alias("is_current"),
    )
