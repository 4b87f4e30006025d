"""Problem 8: documents in containers of a fixed number of tokens.

Method: lexical retrieval packing. Items are spread over shards, each with a BM25 inverted index. The longest unused
item of a shard opens a container; the index returns its unused neighbours, which fill the container
best match first as long as they fit, and the room left goes to the longest item that still fits. What
containers of all shards leave unfilled is packed again, many shards together.

Only a text longer than a container is split, into full containers and a rest.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator
from functools import lru_cache, reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.runtime import materialize, slices

CAPACITY = 2048
#: Folder with vocabularies of public tokenizers, and the one that counts.
TOKENIZERS, VOCABULARY = "/opt/tokenizers", "byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's own tokenizer cuts text before merging bytes.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Items of a shard; shards whose leftovers meet; fill from which a container is closed for good.
SHARD_ITEMS, SHARDS_TOGETHER, CLOSED = 2_000, 64, 0.97
#: BM25, and the share of a shard's items from which on a term tells nothing and is not asked for.
K1, B, COMMON = 1.2, 0.75, 0.1

ITEMS = "doc_id long, piece_no int, tokens int, terms binary, counts binary"
PLACED = "container_id long, doc_id long, piece_no int, tokens int"


@lru_cache(maxsize=2)
def tokenizer(folder: str, name: str):
    import tiktoken

    pairs = (line.split() for line in (Path(folder) / name).read_bytes().splitlines() if line)
    ranks = {base64.b64decode(a): int(b) for a, b in pairs}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _pieces(folder: str, name: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(folder, name).encode_ordinary
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                tokens = np.array(encode(text), np.uint32)
                for piece_no, start in enumerate(range(0, max(1, len(tokens)), capacity)):
                    part = tokens[start : start + capacity]
                    terms, counts = np.unique(part, return_counts=True)
                    rows.append((doc_id, piece_no, len(part), terms.astype(np.uint32).tobytes(), counts.astype(np.uint16).tobytes()))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece_no", "tokens", "terms", "counts"])

    return run


class Index:
    """BM25 over the items of one shard."""

    def __init__(self, terms: list[np.ndarray], counts: list[np.ndarray], lengths: np.ndarray) -> None:
        sizes = np.array([len(t) for t in terms])
        flat = np.concatenate(terms) if len(terms) else np.zeros(0, np.uint32)
        owner = np.repeat(np.arange(len(terms)), sizes)
        tf = np.concatenate(counts).astype(np.float32) if len(terms) else np.zeros(0, np.float32)
        order = np.argsort(flat, kind="stable")
        self.vocabulary, first, df = np.unique(flat[order], return_index=True, return_counts=True)
        self.first, self.last = first, first + df
        self.idf = np.log(1 + (len(terms) - df + 0.5) / (df + 0.5)).astype(np.float32)
        norm = K1 * (1 - B + B * lengths / max(1.0, lengths.mean() if len(lengths) else 1.0))
        weight = tf * (K1 + 1) / (tf + norm[owner]).astype(np.float32)
        self.owner, self.weight = owner[order], weight[order]
        self.terms = terms

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused items that share a telling term with the seed, best first."""
        at = np.searchsorted(self.vocabulary, self.terms[seed])
        telling = at[self.last[at] - self.first[at] <= COMMON * len(unused)]
        at = telling if len(telling) else at
        score = np.zeros(len(unused), np.float32)
        for term in at:
            own = slice(self.first[term], self.last[term])
            score[self.owner[own]] += self.idf[term] * self.weight[own]
        score[~unused] = 0
        hits = np.flatnonzero(score > 0)
        return hits[np.argsort(-score[hits], kind="stable")]


def pack(tokens: np.ndarray, index: Index | None, capacity: int) -> list[list[int]]:
    """Containers as lists of item numbers. Without an index items go by length alone."""
    order = np.argsort(tokens, kind="stable")
    by_length = [(int(tokens[i]), int(i)) for i in order if tokens[i] > 0]
    unused = np.zeros(len(tokens), bool)
    unused[order] = tokens[order] > 0
    out: list[list[int]] = []
    while by_length:
        room, seed = by_length.pop()
        own, room = [seed], capacity - room
        unused[seed] = False
        if index is not None and by_length and room >= by_length[0][0]:
            for i in index.neighbours(seed, unused).tolist():
                size = int(tokens[i])
                if size <= room and (room - size == 0 or room - size >= by_length[0][0] or room - size < capacity * (1 - CLOSED)):
                    own.append(i)
                    unused[i] = False
                    by_length.pop(bisect.bisect_left(by_length, (size, i)))
                    room -= size
                    if not by_length or room < by_length[0][0]:
                        break
        while by_length and room >= by_length[0][0]:
            size, i = by_length.pop(bisect.bisect_right(by_length, (room, len(tokens))) - 1)
            own.append(i)
            unused[i] = False
            room -= size
        out.append(own)
    empty = np.flatnonzero(tokens == 0).tolist()
    if empty:
        (out[0] if out else out.append([]) or out[0]).extend(empty)
    return out


def _packed(capacity: int, indexed: bool):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("piece_no", "ascending")])
        tokens = table["tokens"].to_numpy()
        index = None
        if indexed:
            terms = [np.frombuffer(x, np.uint32) for x in table["terms"].to_pylist()]
            counts = [np.frombuffer(x, np.uint16) for x in table["counts"].to_pylist()]
            index = Index(terms, counts, tokens)
        groups = pack(tokens, index, capacity)
        order = pa.array([i for g in groups for i in g], pa.int64())
        shard = table["shard"][0].as_py() if len(table) else 0
        numbers = np.repeat(np.arange(len(groups)), [len(g) for g in groups]) + (shard << 32)
        return pa.table([pa.array(numbers, pa.int64()), *(table[c].take(order) for c in ("doc_id", "piece_no", "tokens"))], names=["container_id", "doc_id", "piece_no", "tokens"])

    return run


def containers(docs: DataFrame, capacity: int = CAPACITY, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(container_id, doc_id, piece_no, tokens): each piece of each document in its container, once.

    piece_no is 0 for whole documents. An empty text has no tokens and goes along in some container of its shard; a
    null one is left out. Repeated doc_ids count once. No texts give no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    items = materialize(texts.mapInArrow(_pieces(folder, vocabulary, capacity), ITEMS).dropDuplicates(["doc_id", "piece_no"]), "items")
    shards = max(1, items.count() // SHARD_ITEMS)
    tasks = slices(docs.sparkSession)
    shard = F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(shards))
    sharded = items.withColumn("shard", shard).repartition(min(shards, 4 * tasks), "shard")
    first = materialize(sharded.groupBy("shard").applyInArrow(_packed(capacity, True), PLACED), "placed")
    full = first.groupBy("container_id").agg((F.sum("tokens") >= CLOSED * capacity).alias("closed"))
    marked = first.join(full, "container_id")
    again = marked.filter(~F.col("closed")).withColumn("shard", F.shiftright("container_id", 32).cast("long"))
    again = again.withColumn("shard", F.floor(F.col("shard") / SHARDS_TOGETHER) + shards).select("shard", "doc_id", "piece_no", "tokens")
    return marked.filter("closed").drop("closed").unionByName(again.groupBy("shard").applyInArrow(_packed(capacity, False), PLACED))


def faults(docs: DataFrame, placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(fault, n): what a packing must not have, each with how often it has it."""
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null and text is not null").select("doc_id").distinct()
    sizes = placed.groupBy("doc_id").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("pieces"), F.countDistinct("piece_no").alias("distinct"), F.count_if(F.col("tokens") == capacity).alias("full"))
    tests = {
        "document that is nowhere": wanted.join(sizes, "doc_id", "left_anti"), "document that is not in the table": sizes.join(wanted, "doc_id", "left_anti"), "piece placed twice": sizes.filter(F.col("pieces") > F.col("distinct")),
        "container above its capacity": placed.groupBy("container_id").agg(F.sum("tokens").alias("t")).filter(F.col("t") > capacity), "document split though it fits": sizes.filter((F.col("pieces") > 1) & (F.col("tokens") <= capacity)),
        "piece cut short": sizes.filter((F.col("pieces") > 1) & (F.col("full") < F.col("pieces") - 1)),
    }
    return reduce(DataFrame.unionByName, [t.agg(F.count("*").alias("n")).select(F.lit(k).alias("fault"), "n") for k, t in tests.items()])


def fill(placed: DataFrame) -> DataFrame:
    """(containers, items, tokens, least_containers, unused_share) of a packing."""
    each = placed.groupBy("container_id").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("items"))
    total = each.agg(F.count("*").alias("containers"), F.coalesce(F.sum("items"), F.lit(0)).alias("items"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
    least = F.ceil(F.col("tokens") / CAPACITY).alias("least_containers")
    return total.select("containers", "items", "tokens", least, F.round(1 - F.col("tokens") / (F.col("containers") * CAPACITY), 6).alias("unused_share"))
