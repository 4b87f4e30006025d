"""Objects of message exports besides the messages: tool calls and results, uploads, projects and their documents, memories and
accounts, as rows and as Markdown. Python renders what is free-form JSON, inside Arrow batches; the rest are column expressions."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import text

# Languages of fences by a file's extension.
FENCES = {
    "md": "markdown", "py": "python", "json": "json", "js": "javascript", "ts": "typescript", "html": "html", "css": "css", "sh": "bash", "yaml": "yaml", "yml": "yaml", "csv": "csv", "sql": "sql",
    "bat": "bat", "ps1": "powershell", "xml": "xml", "toml": "toml",
}


def _fence(body: str, language: str = "") -> str:
    """A fence longer than any run of backticks inside."""
    longest = max(map(len, re.findall("`+", body)), default=0)
    mark = "`" * max(3, longest + 1)
    return f"{mark}{language}\n{body.rstrip()}\n{mark}"


def _pretty(value: object) -> str:
    return json.dumps(value, indent=2, ensure_ascii=False, default=str)


def _said(block: dict) -> str:
    return (block.get("text") or "").rstrip()


def _thought(block: dict) -> str:
    notes = [f"- *{s['summary'].strip()}*" for s in block.get("summaries") or () if isinstance(s, dict) and s.get("summary")]
    said = (block.get("thinking") or "").strip()
    inside = "\n\n".join(p for p in ("\n".join(notes), said) if p)
    return f"<details>\n<summary>Thinking</summary>\n\n{inside}\n\n</details>"


def _called(block: dict) -> str:
    """A tool call: its input as JSON, but texts of several lines in fences of their own."""
    given = block.get("input") or {}
    via = f" _(via {block['integration_name']})_" if block.get("integration_name") else ""
    fields = given if isinstance(given, dict) else {}
    long = [k for k, v in fields.items() if isinstance(v, str) and "\n" in v]
    short = {k: v for k, v in fields.items() if k not in long} if isinstance(given, dict) else given
    path = fields.get("path")
    language = FENCES.get(path.rsplit(".", 1)[-1].lower(), "") if isinstance(path, str) and "." in path else ""
    shown = [f"**Tool use: `{block.get('name') or 'tool'}`**{via}"]
    if short or not long:
        shown.append(f"```json\n{_pretty(short)}\n```")
    shown += [f"`{k}`:\n\n{_fence(fields[k], 'bash' if k == 'command' else language)}" for k in long]
    return "\n\n".join(shown)


def _returned(block: dict) -> str:
    texts = [t for c in block.get("content") or () if isinstance(c, dict) and c.get("type") == "text" and (t := (c.get("text") or "").strip())]
    said = "\n\n".join(texts) or str(block.get("message") or "_(no text content)_")
    return f"**Tool result: `{block.get('name') or 'tool'}`{' (error)' if block.get('is_error') else ''}**\n\n{said}"


HANDLERS: dict[str, Callable[[dict], str]] = {"text": _said, "thinking": _thought, "tool_use": _called, "tool_result": _returned}


def render_block(block: object) -> str:
    """One content block of a message. What has no handler is shown as the JSON it is, so nothing is lost."""
    if not isinstance(block, dict):
        return str(block)
    kind = block.get("type")
    handler = HANDLERS.get(kind)
    return handler(block) if handler else f"**Unknown content block (`{kind}`)**\n\n```json\n{_pretty(block)}\n```"


def _uploads(entries: object) -> str:
    out = []
    for i, a in enumerate(entries if isinstance(entries, list) else (), 1):
        if isinstance(a, dict):
            size = f", {a['file_size']} bytes" if isinstance(a.get("file_size"), int) else ""
            out.append(f"_Attachment {i}: `{a.get('file_name') or f'attachment {i}'}` ({a.get('file_type') or 'unknown'}{size})_")
            if a.get("extracted_content"):
                out.append(f"\n```\n{a['extracted_content'].rstrip()}\n```")
            out.append("")
    return "\n".join(["**Attachments**", "", *out]).rstrip() if out else ""


def _named_files(entries: object) -> str:
    lines = [f"- `{f.get('file_name') or f'file {i}'}` ({f.get('file_uuid') or 'no-uuid'})" for i, f in enumerate(entries if isinstance(entries, list) else (), 1) if isinstance(f, dict)]
    return "\n".join(["**Files** _(file bytes not included in Claude export)_", "", *lines]) if lines else ""


def message_body(message: dict) -> str:
    """What stands under a message's heading: blocks, else its text, then uploads and files."""
    blocks = [b for x in message.get("content") or () if (b := render_block(x).rstrip())]
    said = "\n\n".join(blocks) if message.get("content") else (message.get("text") or "").strip()
    return "\n\n".join(p for p in (said, _uploads(message.get("attachments")), _named_files(message.get("files"))) if p)


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for raw in batch.column("raw").to_pylist():
            try:
                out.append(message_body(json.loads(raw)))
            except (TypeError, ValueError, AttributeError):
                out.append(None)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("export_key", "conv_uuid", "msg_uuid")), pa.array(out, pa.string())], names=["export_key", "conv_uuid", "msg_uuid", "body"])


def export_messages(table: DataFrame) -> DataFrame:
    """(export_key, conv_uuid, conv_name, summary, msg_uuid, parent_uuid, sender, created_at, raw) of exports; files (path, content).

    raw is the whole message as JSON. A file that is no JSON gives no rows.
    """
    found = table.filter(F.lower(text.base_name(F.col("path"))) == "conversations.json").select(text.parent(F.col("path")).alias("export_key"), F.from_json(F.decode("content", "utf-8"), "array<struct<uuid:string,name:string,summary:string,chat_messages:array<string>>>").alias("cs"))
    rows = found.select("export_key", F.explode("cs").alias("c")).select("export_key", "c.uuid", "c.name", "c.summary", F.explode("c.chat_messages").alias("raw"))
    head = F.from_json("raw", "struct<uuid:string,parent_message_uuid:string,sender:string,created_at:string>")
    return rows.withColumn("h", head).select("export_key", F.col("uuid").alias("conv_uuid"), F.col("name").alias("conv_name"), "summary", F.col("h.uuid").alias("msg_uuid"), F.col("h.parent_message_uuid").alias("parent_uuid"), F.col("h.sender").alias("sender"), F.try_to_timestamp("h.created_at").alias("created_at"), "raw")


def message_bodies(messages: DataFrame) -> DataFrame:
    """(export_key, conv_uuid, msg_uuid, body); body is null where the message is no JSON object."""
    return messages.select("export_key", "conv_uuid", "msg_uuid", "raw").mapInArrow(_bodies, "export_key string, conv_uuid string, msg_uuid string, body string")


def projects(table: DataFrame) -> DataFrame:
    """(export_key, project, name, description, prompt, created_at, updated_at, is_private, is_starter, creator, docs) of projects/*.json."""
    shape = "struct<uuid:string,name:string,description:string,prompt_template:string,created_at:string,updated_at:string,is_private:boolean,is_starter_project:boolean,creator:struct<full_name:string>,docs:array<struct<uuid:string,filename:string,file_name:string,name:string,created_at:string,content:string>>>"
    found = table.filter(F.lower("path").rlike(r"(^|/)projects/[^/]+\.json$")).select(F.regexp_replace("path", r"/?projects/[^/]+$", "").alias("export_key"), F.from_json(F.decode("content", "utf-8"), shape).alias("p")).filter("p.uuid is not null")
    return found.select(
        "export_key", F.col("p.uuid").alias("project"), F.col("p.name").alias("name"), F.col("p.description").alias("description"), F.col("p.prompt_template").alias("prompt"), F.try_to_timestamp("p.created_at").alias("created_at"), F.try_to_timestamp("p.updated_at").alias("updated_at"),
        F.coalesce("p.is_private", F.lit(False)).alias("is_private"), F.coalesce("p.is_starter_project", F.lit(False)).alias("is_starter"), F.coalesce("p.creator.full_name", F.lit("")).alias("creator"), F.col("p.docs").alias("docs"),
    )


def document_name(doc: Column) -> Column:
    return F.coalesce(*[F.nullif(doc[n], F.lit("")) for n in ("filename", "file_name", "name")], F.lit("untitled"))


def project_body(name: Column, description: Column, prompt: Column, docs: Column) -> Column:
    """A project as Markdown: description, prompt, and the names of its documents."""
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    parts = F.array_compact(F.array(
        F.concat(F.lit("# "), F.coalesce(F.nullif(name, F.lit("")), F.lit("Untitled project"))), F.when(filled(description), F.concat(F.lit("## Description\n\n"), description)), F.when(filled(prompt), F.concat(F.lit("## Prompt template\n\n```\n"), prompt, F.lit("\n```"))),
        F.when(F.size(docs) > 0, F.concat(F.lit("## Project documents\n\n"), F.array_join(F.transform(docs, lambda d: F.concat(F.lit("- "), document_name(d))), "\n"))).otherwise("_(no project documents in this export)_"),
    ))
    return F.concat(F.array_join(parts, "\n\n"), F.lit("\n"))


def rendered_projects(found: DataFrame) -> DataFrame:
    """(project, kind, name, body): each project, and each of its documents word for word."""
    own = found.select("project", F.lit("project").alias("kind"), "name", project_body(F.col("name"), F.col("description"), F.col("prompt"), F.coalesce("docs", F.array())).alias("body"))
    docs = found.select("project", F.explode("docs").alias("d"))
    said = F.when(F.trim(F.coalesce("d.content", F.lit(""))) != "", F.concat(F.regexp_replace("d.content", r"\s+$", ""), F.lit("\n"))).otherwise("_(the export carries no text for this document)_\n")
    return own.unionByName(docs.select("project", F.lit("document").alias("kind"), document_name(F.col("d")).alias("name"), said.alias("body")))


def memories(table: DataFrame) -> DataFrame:
    """(scope, text) of memories.json: the empty scope is that of all conversations, others are projects."""
    raw = F.decode("content", "utf-8")
    shape = "struct<conversations_memory:string,project_memories:map<string,string>>"
    found = table.filter(F.lower(text.base_name(F.col("path"))) == "memories.json").select(F.explode(F.when(F.trim(raw).startswith("["), F.from_json(raw, f"array<{shape}>")).otherwise(F.array(F.from_json(raw, shape)))).alias("m"))
    general = found.select(F.lit("").alias("scope"), F.col("m.conversations_memory").alias("text"))
    return general.unionByName(found.select(F.explode("m.project_memories").alias("scope", "text"))).filter("text is not null and trim(text) <> ''")


def memory_body(scope: Column, said: Column, name: Column) -> Column:
    title = F.when(scope == "", "Cross-conversation memory").otherwise(F.concat(F.lit("Project memory: "), F.coalesce(F.nullif(name, F.lit("")), scope)))
    return F.concat(F.lit("# "), title, F.lit("\n\n"), F.regexp_replace(said, r"\s+$", ""), F.lit("\n"))


def users(table: DataFrame) -> DataFrame:
    """(uuid, full_name, email_address, verified_phone_number) of users.json."""
    shape = "array<struct<uuid:string,full_name:string,email_address:string,verified_phone_number:string>>"
    return table.filter(F.lower(text.base_name(F.col("path"))) == "users.json").select(F.inline(F.from_json(F.decode("content", "utf-8"), shape)))
