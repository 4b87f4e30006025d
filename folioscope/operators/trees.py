"""Conversations as trees of parent pointers: the branch that counts, what hangs beside it, and runs of steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.runtime import slices

START = "00000000-0000-4000-8000-000000000000"
BRANCHES = "conv_uuid string, branch_no int, place int, msg_uuid string"


def branches(rows: list[tuple[str, str | None, int | None]]) -> list[tuple[int, int, str]]:
    """(branch, place, message) of (message, parent, time). Branch 0 leads to the latest message; the others follow in
    the order in which they leave it. Without parents, or where nearly every message is a root, the order is that of time."""
    by_id = {}
    for key, parent, at in rows:
        by_id.setdefault(key, (None if parent in (None, START) else parent, at if at is not None else -(2**62)))
    roots = [k for k, (parent, _) in by_id.items() if parent is None or parent not in by_id]
    when = {k: (at, k) for k, (_, at) in by_id.items()}
    if len(by_id) > 1 and len(roots) >= max(2, len(by_id) - 1):
        return [(0, i, k) for i, k in enumerate(sorted(by_id, key=when.__getitem__))]
    children: dict[str, list[str]] = {}
    for key, (parent, _) in by_id.items():
        if parent is not None and parent in by_id:
            children.setdefault(parent, []).append(key)
    walked, seen = list(roots), set(roots)
    for key in walked:
        for child in children.get(key, ()):
            if child not in seen:
                seen.add(child)
                walked.append(child)
    rest = sorted((k for k in by_id if k not in seen), key=when.__getitem__)  # members of a circle hang beside
    best = dict(when)
    for key in reversed(walked):
        for child in children.get(key, ()):
            best[key] = max(best[key], best[child])
    out, number = [], 0
    waiting = [max(roots, key=best.__getitem__)] if roots else []
    later = sorted((r for r in roots if r not in waiting), key=when.__getitem__, reverse=True)
    while waiting or later:
        key = waiting.pop(0) if waiting else later.pop()
        place, beside = 0, []
        while key is not None:
            out.append((number, place, key))
            below = sorted(children.get(key, ()), key=best.__getitem__)
            beside += below[:-1]
            key, place = (below[-1] if below else None), place + 1
        waiting += beside
        number += 1
    return out + [(number, i, k) for i, k in enumerate(rest)]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, held, out = None, [], []

    def close() -> None:
        if held:
            out.extend((now, *b) for b in branches(held))

    for batch in batches:
        for conv, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_uuid", "msg_uuid", "parent_uuid", "at"))):
            if conv != now:
                close()
                now, held = conv, []
            held.append(tuple(row))
        if len(out) > 10_000:
            yield _batch(out)
            out.clear()
    close()
    yield _batch(out)


def _batch(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int32(), pa.int32(), pa.string()))], names=["conv_uuid", "branch_no", "place", "msg_uuid"])


def branch_table(messages: DataFrame) -> DataFrame:
    """(conv_uuid, branch_no, place, msg_uuid) of each message once; rows without conversation or message id are left out."""
    rows = messages.filter(F.col("conv_uuid").isNotNull() & F.col("msg_uuid").isNotNull()).select("conv_uuid", "msg_uuid", "parent_uuid", F.unix_micros("created_at").alias("at"))
    return rows.repartition(slices(messages.sparkSession), "conv_uuid").sortWithinPartitions("conv_uuid", "msg_uuid").mapInArrow(_stream, BRANCHES)


def way_up(parents: dict[str, str | None], at: str | None) -> list[str]:
    """The nodes from a root down to one, in order. A parent that is not there ends the way, as does one that closes a circle."""
    way: dict[str, None] = {}
    while at is not None and at in parents and at not in way:
        way[at] = None
        at = parents[at]
    return list(way)[::-1]


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, parents, current, out = None, {}, None, []

    def close() -> None:
        out.extend((now, key, depth) for depth, key in enumerate(way_up(parents, current), 1))

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 3
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int32()))], names=["conv_id", "node_id", "depth"])

    for batch in batches:
        for conv, key, parent, chosen in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "node_id", "parent", "is_current"))):
            if conv != now:
                close()
                now, parents, current = conv, {}, None
            parents[key] = parent
            current = key if chosen else current
        if len(out) > 10_000:
            yield flush()
    close()
    yield flush()


def active_paths(nodes: DataFrame) -> DataFrame:
    """(conv_id, node_id, depth): from the root, at depth 1, down to the current node. nodes: (conv_id, node_id, parent, is_current).

    One conversation's ids are held by one task, read off a sorted stream.
    """
    columns = ["conv_id", "node_id", "parent", F.coalesce("is_current", F.lit(False)).alias("is_current")]
    kept = nodes.filter("conv_id is not null and node_id is not null").select(*columns)
    return kept.repartition(slices(nodes.sparkSession), "conv_id").sortWithinPartitions("conv_id", "node_id").mapInArrow(_ways, "conv_id string, node_id string, depth int")


def collapsed_runs(steps: DataFrame, keys: list[str], order: str, flag: str) -> DataFrame:
    """(keys, run_no, flagged, first, n): neighbouring rows of equal flag as one, in order."""
    w = Window.partitionBy(*keys).orderBy(order)
    changed = F.coalesce((F.col(flag) != F.lag(flag).over(w)).cast("int"), F.lit(1))
    marked = steps.withColumn("_changed", changed).withColumn("run_no", F.sum("_changed").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "run_no").agg(F.first(flag).alias("flagged"), F.min(order).alias("first"), F.count("*").alias("n"))
