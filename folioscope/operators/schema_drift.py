"""Schemas that drift between files: read them into one table, and report every change.

Method: similarity flooding. Two successive files of a group are two schema graphs: fields are tied to their level, to the
kind of their values, to the parts of their names and to the values they hold, and levels to the fields that nest them. Pairs
of nodes that are reached by ties of the same label are neighbours in a graph of pairs, over which match scores spread until they
settle. The best consistent pairs among fields that went and fields that came are renames, if they settle near
enough to what fields that stayed reach with themselves. Over all files the renames give each field one name, under which its values are
cast and united.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.runtime import materialize, slices

UUID = re.compile(r"(?:urn:uuid:)?\{?([0-9a-f]{8})-?([0-9a-f]{4})-?([0-9a-f]{4})-?([0-9a-f]{4})-?([0-9a-f]{12})\}?", re.I)
_UUID_IN_NAME = r"(?i)([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})"
_TIME = re.compile(r"\d{4}-\d\d-\d\d(?:[T ]\d\d:\d\d(?::\d\d(?:\.\d+)?)?(?:Z|[+-]\d\d:?\d\d)?)?$")
_NUMBER = re.compile(r"[+-]?\d+(?:\.\d+)?$")
_LETTERED = re.compile(r"(?i)[rv]\.?\d+(?:\.\d+)?$")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

#: The level below the top whose entries' keys are fields as well.
ENTRIES = "conversations"
#: Seconds since 1970 that count as a time.
TIMES = (10**9, 4 * 10**9)
#: Flooding: when it has settled, rounds at most, and the least score of a rename as a share of what fields reach with themselves.
SETTLED, ROUNDS, LEAST = 1e-3, 50, 0.24
#: What it tells that two fields are of one kind: schemas hold few fields of some kinds, many of others.
TELLING = {"uuid": 1.0, "time": 1.0}
#: Renames of this share of all count for the names of the united table, 1 / RENAME_SHARE at most.
RENAME_SHARE = 1e-4

CHANGES = "file_id long, before_id long, field_name string, old_name string, change_kind string"


def json_type(value: object) -> str | None:
    """JSON's name of a value's type; null has none."""
    for kind, name in ((bool, "boolean"), ((int, float), "number"), (str, "string"), (dict, "object"), (list, "array")):
        if isinstance(value, kind):
            return name
    return None


def reading(value: object) -> tuple[str, str]:
    """What a value stands for whatever its notation: (kind, canonical value)."""
    if isinstance(value, bool) or value is None:
        return ("boolean" if value is not None else "null"), str(value)
    if isinstance(value, (dict, list)):
        return json_type(value), json.dumps(value, sort_keys=True)
    text = str(value).strip()
    if m := UUID.fullmatch(text):
        return "uuid", "".join(m.groups()).lower()
    if _TIME.match(text):
        try:
            at = datetime.fromisoformat(text.replace("Z", "+00:00"))
            return "time", str(int((at if at.tzinfo else at.replace(tzinfo=timezone.utc)).timestamp()))
        except ValueError:
            pass
    if _NUMBER.match(text):
        number = float(text)
        seconds = number / 1000 if number >= TIMES[0] * 1000 else number
        return ("time", str(int(seconds))) if TIMES[0] <= seconds < TIMES[1] else ("number", f"{number:g}")
    if _LETTERED.match(text):
        return "number", text[1:].lstrip(".")
    return "text", text.casefold()


def outline(raw: str | None) -> dict[str, list] | None:
    """Field -> [JSON types, kind, hashes of all its values] of a file, or None where it is no valid JSON object."""
    try:
        data = json.loads(raw)
    except (TypeError, ValueError, RecursionError):
        return None
    if not isinstance(data, dict):
        return None
    seen: dict[str, list[object]] = {k: [v] for k, v in data.items()}
    entries = data.get(ENTRIES)
    for entry in entries if isinstance(entries, list) else ():
        for key, value in entry.items() if isinstance(entry, dict) else ():
            seen.setdefault(f"{ENTRIES}.{key}", []).append(value)
    found = {}
    for field, values in seen.items():
        types = sorted({t for v in values if (t := json_type(v))})
        read = [reading(v) for v in values if v is not None] or [("null", "")]
        kinds = [k for k, _ in read]
        held = sorted({zlib.crc32(f"{k}:{v}".encode()) for k, v in read}) if kinds[0] not in ("object", "array") or field != ENTRIES else []
        found[field] = [types, max(set(kinds), key=lambda k: (kinds.count(k), k)), held]
    return found


def _level(field: str) -> tuple[str, str]:
    head, dot, tail = field.partition(".")
    return (head, tail) if dot and head == ENTRIES else ("", field)


def _parts(name: str) -> set[str]:
    found = {p.lower() for p in _PART.findall(name)} - {"at", "on", "no", "n"}
    return {p.rstrip("s") if len(p) > 3 else p for p in found}


def _share(a: set, b: set) -> float:
    return len(a & b) / min(len(a), len(b)) if a and b else 0.0


def _likeness(a: str, b: str) -> float:
    """Of two names: shared parts, a part that begins another counting nearly as much."""
    x, y = _parts(_level(a)[1]), _parts(_level(b)[1])
    begun = any(p != q and (p.startswith(q) or q.startswith(p)) and min(len(p), len(q)) >= 2 for p in x for q in y)
    return max(_share(x, y), 0.9 * begun)


def _pair_graph(old: dict[str, list], new: dict[str, list]) -> tuple[dict[tuple, float], dict[tuple, list[tuple[tuple, str]]]]:
    """(first scores, ties with their labels) of the pairs of nodes of two schema graphs that ties of one label lead to."""
    first: dict[tuple, float] = {}
    ties: dict[tuple, list[tuple[tuple, str]]] = defaultdict(list)

    def tie(field: tuple, other: tuple, label: str, score: float) -> None:
        first[other] = score
        ties[field].append((other, label))
        ties[other].append((field, label))

    for a, (_, kind_a, values_a) in old.items():
        for b, (_, kind_b, values_b) in new.items():
            (level_a, name_a), (level_b, name_b) = _level(a), _level(b)
            if level_a != level_b or kind_a != kind_b and "null" not in (kind_a, kind_b):
                continue
            pair = ("field", a, b)
            first[pair] = _likeness(a, b)
            tie(pair, ("level", level_a, level_b), "in", 1.0)
            if kind_a == kind_b:
                tie(pair, ("kind", level_a, kind_a), "kind", TELLING.get(kind_a, 0.1))
            for p in _parts(name_a):
                for q in _parts(name_b):
                    if p == q or min(len(p), len(q)) >= 2 and (p.startswith(q) or q.startswith(p)):
                        tie(pair, ("part", p, q), "part", 1.0 if p == q else 0.9)
            shared = _share(set(values_a), set(values_b))
            if shared:
                tie(pair, ("values", a, b), "values", shared * (0.3 if kind_a == "number" else 1.0))  # small numbers agree by chance
    nested, inner = ("field", ENTRIES, ENTRIES), ("level", ENTRIES, ENTRIES)
    if nested in first and inner in first:
        tie(nested, inner, "nests", first[inner])
    return first, ties


def flood(old: dict[str, list], new: dict[str, list]) -> dict[tuple[str, str], float]:
    """Settled match scores of field pairs of one level and kind, as shares of what fields that stayed reach with themselves.

    Each round a pair of nodes keeps its first score and its own, and takes from each neighbour a share of the neighbour's, which that
    divides among its ties of one label.
    """
    first, ties = _pair_graph(old, new)
    if not first:
        return {}
    share = {node: {label: 1.0 / n for label, n in Counter(label for _, label in own).items()} for node, own in ties.items()}
    score = dict(first)
    for _ in range(ROUNDS):
        held = {node: first[node] + score[node] for node in first}
        after = dict(held)
        for node, own in ties.items():
            for other, label in own:
                after[other] += held[node] * share[node][label]
        most = max(after.values())
        after = {node: x / most for node, x in after.items()}
        moved = max(abs(after[node] - score[node]) for node in first)
        score = after
        if moved < SETTLED:
            break
    fields = {node[1:]: x for node, x in score.items() if node[0] == "field"}
    stayed = [x for (a, b), x in fields.items() if a == b]
    scale = sum(stayed) / len(stayed) if stayed else max(fields.values(), default=1.0)
    return {pair: x / scale for pair, x in fields.items()}


def changes(old: dict[str, list], new: dict[str, list]) -> list[tuple[str, str | None, str]]:
    """(field, old name, kind of change) from one file to the next."""
    out: list[tuple[str, str | None, str]] = []
    gone, come = [f for f in old if f not in new], [f for f in new if f not in old]
    # entries that a file has none of tell nothing about their fields
    for side, other in ((gone, new), (come, old)):
        if not any(_level(f)[0] == ENTRIES for f in other) and ENTRIES in other:
            side[:] = [f for f in side if _level(f)[0] != ENTRIES]
    if gone and come:
        scores = flood(old, new)
        for (a, b), score in sorted(scores.items(), key=lambda x: (-x[1], x[0])):
            if a in gone and b in come and score >= LEAST:
                gone.remove(a)
                come.remove(b)
                out.append((b, a, "renamed"))
    out += [(f, None, "removed") for f in gone] + [(f, None, "added") for f in come]
    out += [(f, None, "retyped") for f in new if f in old and old[f][0] and new[f][0] and old[f][0] != new[f][0]]
    return out


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [outline(x) for x in batch.column("raw_json").to_pylist()]
        kept = pa.array([i for i, x in enumerate(found) if x is not None], pa.int64())
        texts = pa.array([json.dumps(x) for x in found if x is not None], pa.string())
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(kept) for c in ("grp", "at", "file_id")), texts], names=["grp", "at", "file_id", "outline"])


def _successive(last: dict[int, tuple[str, int, str]]):
    """Compare each file with the one before it. last: what stands before each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple[str, int, str] | None = None
        started = False
        for batch in batches:
            out: list[tuple] = []
            for part, group, file_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "grp", "file_id", "outline"))):
                if not started:
                    before, started = last.get(part), True
                if before is not None and before[0] == group and before[2] != text:
                    out += [(file_id, before[1], f, o, k) for f, o, k in changes(json.loads(before[2]), json.loads(text))]
                before = group, file_id, text
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()))], names=["file_id", "before_id", "field_name", "old_name", "change_kind"])

    return run


def schema_changes(files: DataFrame) -> DataFrame:
    """(file_id, before_id, field_name, old_name, change_kind) of each change.

    Files are grouped by the uuid in file_name and ordered by written_at (null first), then file_id. Files that
    are no valid JSON object, or whose name holds no uuid, are left out; a file that has no entries says nothing
    on the fields of entries. A null value has no type. No files give no rows.

    Files are spread by ranges of (group, time), so that a group may hold any share of them; each range is told
    the last file of the one before.
    """
    group = F.lower(F.regexp_extract("file_name", _UUID_IN_NAME, 1)).alias("grp")
    named = files.select(group, F.coalesce(F.unix_micros("written_at"), F.lit(-(2**62))).alias("at"), F.col("file_id").cast("long").alias("file_id"), "raw_json").filter((F.col("grp") != "") & F.col("file_id").isNotNull())
    spark = files.sparkSession
    # a row repeated as a whole comes once
    outlined = named.mapInArrow(_outlines, "grp string, at long, file_id long, outline string").dropDuplicates(["grp", "at", "file_id"])
    keys = ["grp", "at", "file_id"]
    ranges = outlined.repartitionByRange(slices(spark), *keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())
    ranges = materialize(ranges, "outlines")
    ends = ranges.groupBy("part").agg(F.max(F.struct(*keys, "outline")).alias("e")).orderBy("part").collect()  # one row per partition
    last = {b["part"]: (a["e"]["grp"], a["e"]["file_id"], a["e"]["outline"]) for a, b in zip(ends, ends[1:])}
    # read in one piece for each range, in its order
    again = ranges.repartitionByRange(slices(spark), "part").sortWithinPartitions("part", *keys)
    return again.mapInArrow(_by_part(last), CHANGES)


def _by_part(last: dict[int, tuple[str, int, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _successive(last)(batches)

    return run


def found(files: DataFrame) -> DataFrame:
    return schema_changes(files).select("file_id", "field_name", "change_kind").distinct()


#: The consistent table: column, type, and the field whose names and successors it unites.
TABLE = {
    "format_version": ("string", "manifest_format_version"), "project_uuid": ("string", "project_uuid"), "project_name": ("string", "project_name"),
    "generated_at": ("timestamp", "generated_at"), "revision": ("long", "revision"), "conversation_count": ("long", "conversation_count"),
    "entry_uuid": ("string", f"{ENTRIES}.uuid"), "entry_title": ("string", f"{ENTRIES}.title"), "entry_updated_at": ("timestamp", f"{ENTRIES}.updated_at"),
}


def correspondences(found_changes: DataFrame) -> dict[str, str]:
    """Each name of a field -> the one it goes by. Renames are counted over all files; names that follow each
    other belong together, by the most frequent rename first and only within a level, so that no chain of
    rare mistakes joins two fields of ``TABLE``. Renames below ``RENAME_SHARE`` of all name no column, which bounds what the driver holds."""
    renamed = found_changes.filter(F.col("change_kind") == "renamed")
    renames = materialize(renamed.groupBy("old_name", "field_name").count(), "renames")
    total = renames.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    renames = renames.filter(F.col("count") >= RENAME_SHARE * total)
    known = {source: source for _, source in TABLE.values()}
    group = dict(known)
    for r in sorted(renames.collect(), key=lambda r: (-r["count"], r["old_name"], r["field_name"])):
        a, b = r["old_name"], r["field_name"]
        root_a, root_b = group.get(a), group.get(b)
        if root_a and root_b:
            if root_a != root_b and not (root_a in known and root_b in known):
                keep, drop = (root_a, root_b) if root_a in known or root_b not in known else (root_b, root_a)
                group = {k: keep if v == drop else v for k, v in group.items()}
        else:
            group[a] = group[b] = root_a or root_b or a
    return group


def _cast(kind: str, value: object) -> object:
    if value is None:
        return None
    read, canonical = reading(value)
    if kind == "timestamp":
        return int(canonical) * 1_000_000 if read == "time" else None
    if kind == "long":
        return int(float(canonical)) if read == "number" else None
    if read == "uuid":
        return f"{canonical[:8]}-{canonical[8:12]}-{canonical[12:16]}-{canonical[16:20]}-{canonical[20:]}"
    return value if isinstance(value, str) else json.dumps(value)


def _unite(group: dict[str, str]):
    columns = {source: (name, kind) for name, (kind, source) in TABLE.items()}
    arrow = {"string": pa.string(), "long": pa.int64(), "timestamp": pa.timestamp("us", "UTC")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[dict] = []
            for file_id, raw in zip(batch.column("file_id").to_pylist(), batch.column("raw_json").to_pylist()):
                try:
                    data = json.loads(raw)
                except (TypeError, ValueError, RecursionError):
                    continue
                if not isinstance(data, dict):
                    continue
                head: dict = {"file_id": file_id}
                extra = {}
                for key, value in data.items():
                    name = columns.get(group.get(key, key))
                    if name:
                        head[name[0]] = _cast(name[1], value)
                    elif key != ENTRIES:
                        extra[group.get(key, key)] = value if isinstance(value, str) else json.dumps(value)
                entries = data.get(ENTRIES)
                for entry in [e for e in entries if isinstance(e, dict)] if isinstance(entries, list) and entries else [{}]:
                    row, more = dict(head), dict(extra)
                    for key, value in entry.items():
                        full = f"{ENTRIES}.{key}"
                        name = columns.get(group.get(full, full))
                        if name:
                            row[name[0]] = _cast(name[1], value)
                        else:
                            more[group.get(full, full)] = value if isinstance(value, str) else json.dumps(value)
                    row["extra"] = sorted(more.items())
                    rows.append(row)
            arrays = [pa.array([r.get("file_id") for r in rows], pa.int64())]
            arrays += [pa.array([r.get(n) for r in rows], arrow[kind]) for n, (kind, _) in TABLE.items()]
            arrays.append(pa.array([r["extra"] for r in rows], pa.map_(pa.string(), pa.string())))
            yield pa.RecordBatch.from_arrays(arrays, names=["file_id", *TABLE, "extra"])

    return run


def united(files: DataFrame) -> DataFrame:
    """One row for each file and entry, under one name and type for each field; fields beyond ``TABLE`` are in ``extra``.

    A value that does not fit its column's type is null there. Files without entries give one row.
    """
    group = correspondences(schema_changes(files))
    schema = T.StructType([T.StructField("file_id", T.LongType())])
    for name, (kind, _) in TABLE.items():
        schema = schema.add(name, kind)
    return files.select("file_id", "raw_json").mapInArrow(_unite(group), schema.add("extra", T.MapType(T.StringType(), T.StringType())))
