"""Readers: a tree of files as one table, each file converted by its kind, bad ones kept with their error."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import text
from folioscope.operators import audit, inventory
from folioscope.sources import markup, office

CONVERTED = "path string, kind string, meta map<string,string>, body string, error string"


def files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, size, modified, content) of every file below a root, path relative to it. Content is read only where it is selected."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    found = (reader.option("pathGlobFilter", glob) if glob else reader).load(root)
    bare = root.rstrip("/").removeprefix("file://")
    relative = F.regexp_replace("path", rf"^(?:[a-z0-9]+:/*)?\Q{bare}\E/", "") if "://" not in bare else F.substring("path", len(bare) + 2, 1 << 20)
    return found.select(F.regexp_replace(relative, r"^file:/+", "/").alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), "content")


def marked_folders(spark: SparkSession, root: str, marker: str) -> DataFrame:
    """(root): folders below a root that hold a file of a name which the file reader passes over, as it does with names that begin with an underscore.

    The tree is listed through its file system, as the reader itself lists it.
    """
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(root)
    system = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = system.makeQualified(top).toUri().getPath().rstrip("/") + "/"
    listed, found = system.listFiles(top, True), []
    while listed.hasNext():
        path = listed.next().getPath()
        if path.getName() == marker:
            found.append((path.getParent().toUri().getPath().removeprefix(base),))
    return spark.createDataFrame(found, "root string")


def content_files(table: DataFrame) -> DataFrame:
    """Without tooling and clutter."""
    return table.filter(~audit.utility_path(F.col("path")))


def _plain(data: bytes) -> str:
    return data.decode("utf-8", "replace")


def convert(kind: str, path: str, data: bytes) -> tuple[dict[str, str], str]:
    """(metadata, body) of one file. Kinds that are not converted stand for themselves in a stub."""
    name = path.rsplit("/", 1)[-1]
    if kind == "html":
        meta, body = markup.html_to_markdown(_plain(data))
        return {"source": "html", **meta}, body
    if kind == "rtf":
        meta, body = markup.rtf_to_markdown(data)
        return {"source": "rtf", **{k: str(v) for k, v in meta.items()}}, body
    if kind == "docx":
        return office.docx_to_markdown(data)
    if kind == "xlsx":
        return office.xlsx_to_markdown(data)
    if kind == "pdf":
        return pdf_to_markdown(data)
    if kind == "md":
        return {}, _plain(data)
    if kind == "txt":
        return {"source": "txt"}, f"# {name.rsplit('.', 1)[0]}\n\n{_plain(data)}"
    return {"source": "unconvertible", "file_type": "." + name.rsplit(".", 1)[-1].lower() if "." in name else ""}, f"# {name}\n"


def pdf_to_markdown(data: bytes) -> tuple[dict[str, str], str]:
    """Text by page where pypdf is installed, else an error that marks the file as skipped."""
    import io

    try:
        import pypdf
    except ImportError as e:
        raise ValueError("skipped: pypdf is not installed") from e
    reader = pypdf.PdfReader(io.BytesIO(data))
    pages = [(p.extract_text() or "").strip() for p in reader.pages]
    meta = {"source": "pdf", "page_count": str(len(pages)), "likely_scanned": str(sum(map(len, pages)) < 20 * len(pages)).lower()}
    return meta, "\n\n".join(f"## Page {i}\n\n{t}" for i, t in enumerate(pages, 1)) + "\n"


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for path, kind, data in zip(*(batch.column(c).to_pylist() for c in ("path", "kind", "content"))):
            try:
                meta, body = convert(kind, path, data or b"")
                rows.append((path, kind, sorted(meta.items()), body, None))
            except Exception as e:  # one bad file is a row with its error, never a failed job
                rows.append((path, kind, None, None, f"{type(e).__name__}: {e}"))
        columns = list(zip(*rows)) or [()] * 5
        kinds = (pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "kind", "meta", "body", "error"])


def converted(table: DataFrame) -> DataFrame:
    """(path, kind, meta, body, error) of files (path, content)."""
    typed = table.withColumn("kind", inventory.kind(F.col("path"))).filter("kind <> 'skipped'")
    return typed.select("path", "kind", "content").mapInArrow(_convert, CONVERTED)


def export_roots(table: DataFrame) -> DataFrame:
    """(root, format): folders that hold a chat export, by the files in them."""
    named = table.select(text.parent(F.col("path")).alias("root"), F.lower(text.base_name(F.col("path"))).alias("name"))
    below = named.filter(F.col("root").rlike(r"(^|/)projects$")).select(F.regexp_replace("root", r"/?projects$", "").alias("root")).distinct().withColumn("projects", F.lit(True))
    found = named.groupBy("root").agg(F.bool_or(F.col("name") == "user.json").alias("user"), F.bool_or(F.col("name") == "users.json").alias("users"), F.bool_or(F.col("name").rlike(r"^conversations(-\d+)?\.json$")).alias("conversations"))
    kind = F.when(F.col("conversations") & F.col("users") & F.coalesce("projects", F.lit(False)), "messages").when(F.col("conversations") & F.col("user"), "nodes")
    return found.join(below, "root", "left").select("root", kind.alias("format")).filter("format is not null")


def term_list(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(term) of word lists: the first column of each line, in lower case; # begins a comment."""
    lines = spark.read.text(paths).select(F.trim("value").alias("v")).filter((F.col("v") != "") & ~F.col("v").startswith("#"))
    return lines.select(F.lower(F.trim(F.split("v", "\t")[0])).alias("term")).filter("term <> ''").distinct()


def name_table(spark: SparkSession, path: str) -> DataFrame:
    """(id, name, line) of a table of two columns; lines without a tab are left out."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("line", "v"))
    parts = F.split("v", "\t")
    return lines.filter(~F.col("v").startswith("#") & (F.size(parts) > 1)).select(F.trim(parts[0]).alias("id"), F.trim(parts[1]).alias("name"), "line")


def node_conversations(table: DataFrame) -> DataFrame:
    """Nodes of exports that store a conversation as a map of nodes, as ``operators.nodes`` reads them, with title and source_path; (path, content).

    A file holds a list of conversations, an object with such a list, or a single conversation.
    """
    upload = "struct<id:string,name:string,mime_type:string,mimeType:string>"
    message = f"struct<author:struct<role:string,name:string>,create_time:double,content:struct<parts:array<string>>,metadata:struct<attachments:array<{upload}>>>"
    shape = f"struct<conversation_id:string,id:string,title:string,current_node:string,mapping:map<string,struct<parent:string,message:{message}>>>"
    raw = F.decode("content", "utf-8")
    listed = F.coalesce(F.from_json(raw, f"array<{shape}>"), F.array())
    wrapped, single = F.from_json(raw, f"struct<conversations:array<{shape}>>")["conversations"], F.from_json(raw, shape)
    one = F.when(single["mapping"].isNotNull(), F.array(single))
    found = table.filter(F.lower(text.base_name(F.col("path"))).rlike(r"^conversations(-\d+)?\.json$")).select("path", F.explode(F.when(F.trim(raw).startswith("["), listed).otherwise(F.coalesce(wrapped, one))).alias("c"))
    nodes = found.select(F.col("path").alias("source_path"), F.coalesce("c.conversation_id", "c.id").alias("conv_id"), F.col("c.title").alias("title"), F.col("c.current_node").alias("now"), F.posexplode("c.mapping").alias("place", "node_id", "n"))
    uploads = F.transform(F.coalesce("n.message.metadata.attachments", F.array()), lambda a: F.struct(a["id"].alias("id"), a["name"].alias("name"), F.coalesce(a["mime_type"], a["mimeType"]).alias("mime")))
    return nodes.select(
        "conv_id", "node_id", F.col("n.parent").alias("parent"), "place", F.when(F.col("n.message").isNotNull(), F.coalesce("n.message.author.role", F.lit("unknown"))).alias("role"), F.col("n.message.author.name").alias("tool_name"), F.col("n.message.create_time").alias("at"),
        F.col("n.message.content.parts").alias("parts"), uploads.alias("attachments"), (F.col("node_id") == F.col("now")).alias("is_current"), "title", "source_path",
    )


def message_conversations(table: DataFrame) -> DataFrame:
    """Exports that store a conversation as a list of messages, in the columns of ``chat_messages``; (path, content)."""
    block = "struct<type:string,text:string,thinking:string,name:string>"
    shape = f"array<struct<uuid:string,name:string,chat_messages:array<struct<uuid:string,parent_message_uuid:string,sender:string,created_at:string,text:string,content:array<{block}>>>>>"
    found = table.filter(F.lower(text.base_name(F.col("path"))) == "conversations.json").select(text.parent(F.col("path")).alias("export_key"), F.explode(F.from_json(F.decode("content", "utf-8"), shape)).alias("c"))
    rows = found.select("export_key", F.col("c.uuid").alias("conv_uuid"), F.col("c.name").alias("conv_name"), F.explode("c.chat_messages").alias("m"))
    blocks = F.transform("m.content", lambda b: F.struct(b["type"].alias("block_type"), b["text"].alias("text"), b["thinking"].alias("thinking"), b["name"].alias("tool_name")))
    return rows.select("export_key", "conv_uuid", "conv_name", F.col("m.uuid").alias("msg_uuid"), F.col("m.parent_message_uuid").alias("parent_uuid"), F.col("m.sender").alias("sender"), F.try_to_timestamp("m.created_at").alias("created_at"), F.col("m.text").alias("text"), blocks.alias("content"))


def cached_pages(pages_by_digest: DataFrame, files_with_digest: DataFrame) -> DataFrame:
    """(path, page_no, text): recognised text by content, pages parted by form feeds, blank ones left out."""
    joined = files_with_digest.select("path", "sha256").join(pages_by_digest, "sha256")
    return joined.select("path", F.posexplode(F.split("text", "\f")).alias("p", "text")).filter(F.trim("text") != "").select("path", (F.col("p") + 1).alias("page_no"), "text")


def selection_list(spark: SparkSession, path: str, once: bool = True) -> DataFrame:
    """(name, line) of a list with one name a line; # begins a comment. once: of a name that comes again the first line counts."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("line", "v"))
    named = lines.select(F.trim("v").alias("name"), "line").filter((F.col("name") != "") & ~F.col("name").startswith("#"))
    return named.groupBy("name").agg(F.min("line").alias("line")) if once else named


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, folder, name, size, mime, modified, is_sheet) of the files in a saved listing of a remote drive, a JSON array."""
    from folioscope.operators.catalogue import sheet

    raw = spark.read.schema("Path string, IsDir boolean, Size long, ModTime string, MimeType string, ID string").option("multiLine", True).json(path)
    place = F.replace("Path", F.lit("\\"), F.lit("/"))
    kept = raw.filter(~F.coalesce("IsDir", F.lit(False)) & F.col("Path").isNotNull()).withColumn("place", place)
    return kept.select(F.col("place").alias("path"), text.parent(F.col("place")).alias("folder"), text.base_name(F.col("place")).alias("name"), F.col("Size").alias("size"), F.col("MimeType").alias("mime"), F.try_to_timestamp("ModTime").alias("modified"), F.coalesce(sheet(F.col("MimeType"), F.col("Size")), F.lit(False)).alias("is_sheet"))


def _media(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import base64
    import io
    import re
    import zipfile

    data_url = re.compile(rb"data:([a-z]+/[a-z0-9.+-]+);base64,([A-Za-z0-9+/=\s]+)", re.I)
    for batch in batches:
        rows = []
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
            if path.lower().endswith(".docx"):
                try:
                    with zipfile.ZipFile(io.BytesIO(content or b"")) as archive:
                        rows += [(path, name.rsplit("/", 1)[-1], None, archive.read(name)) for name in sorted(archive.namelist()) if name.startswith("word/media/") and not name.endswith("/")]
                except (zipfile.BadZipFile, KeyError):
                    continue  # the converter reports the file
            else:
                for i, m in enumerate(data_url.finditer(content or b""), 1):
                    try:
                        rows.append((path, f"image-{i}", m.group(1).decode(), base64.b64decode(m.group(2), validate=False)))
                    except ValueError:
                        continue
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.string(), pa.binary()))], names=["path", "name", "mime", "content"])


def embedded_media(table: DataFrame) -> DataFrame:
    """(path, name, target, content) of the pictures inside Word and HTML files: target is where they go, beside the digest."""
    from folioscope.functions.values import asset_extension

    found = table.filter(F.lower("path").rlike(r"\.(docx|html?)$")).select("path", "content").mapInArrow(_media, "path string, name string, mime string, content binary")
    stem = F.regexp_replace("name", r"\.[A-Za-z0-9]+$", "")
    folder = F.concat(F.regexp_replace("path", r"\.[^./]*$", ""), F.lit("_media/"))
    return found.select("path", "name", F.concat(folder, stem, asset_extension(F.col("name"), F.col("mime"), F.col("content"))).alias("target"), "content")
