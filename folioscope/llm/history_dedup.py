"""Problem 7: each new batch against everything accepted before.

Method: immutable suffix arrays for each batch. A suffix stands in the array by the hashes of its first 5, 10, 20, 40 and
80 words, so that its neighbours by binary search are the suffixes that share the longest beginning with it.
Matches are counted for each pair of records, and pairs that cover enough are verified word by word. The
arrays of batches are merged logarithmically: a new one absorbs those before it that are not twice its size.

That search finds most duplicates at little cost but guarantees none. The rest is exact: every record meets the accepted
ones through its rarest pairs of adjacent words (``prefixes``), of which two texts with enough common words in order must
share one. This goes on until every accepted record has been met by all, so nothing depends on what the first search missed.

Suffixes are spread over tasks by their first five words (by more of them where those five are hot), so a lookup
meets one shard only. Every word of a short record starts a suffix; of a long one, those whose hash
says so, the same in both texts. Exact copies are found by digest first and never become pairs.

``History`` keeps what was accepted on storage: segments that are never changed once written, one for each intake, merged
logarithmically. A new batch is checked against them without reading the texts of history again: it reads the shards its own
rarest pairs fall into, and the texts of the records it may repeat.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.runtime import materialize, slices

#: A record is a duplicate from this share of the longer text's words on.
SHARE = 0.8
#: Words of the shortest match, and how often it doubles.
LEAST_WORDS, LEVELS = 5, 5
#: Share of a record's suffixes that must match another record before the pair is verified.
COVERAGE = 0.08
#: One in so many words starts a suffix, by the words of the record: (below, one in). What this misses the exact search finds.
SAMPLING = ((32, 1), (256, 4), (1 << 62, 16))
#: Suffixes of one shard, and the neighbours looked at on either side.
SHARD, NEIGHBOURS = 200_000, 2
#: A match of this share of all suffixes is hot; there are at most 1 / HOT of them at a level.
HOT, LEAST_HOT = 0.001, 10_000

WIDTH = 8 + 4 * (LEVELS - 1)
_WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)

TEXTS = "row_id long, batch_no long, n int, digest string, words string"
SUFFIXES = "key binary, row_id long, batch_no long, n int, starts int"
PAIRS = "row_id long, other_id long, starts int, hits long"
#: Buckets of the counts by which pairs of words are rare or usual, bits of a record's signature, and those from so many words on.
BUCKETS, BITS, WIDE_BITS, WIDE_FROM = 1 << 20, 512, 2048, 300
#: Pairs of records compared at once within a shard, and pairs of words of one shard.
AT_ONCE, PREFIX_SHARD = 1_000_000, 2_000_000
#: Shards of a history on storage.
STORED_SHARDS = 64

PREFIXES = "shard int, row_id long, batch_no long, n int, marks binary, wide binary, keys binary, places binary, ranks binary"


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row_id, batch_no, text in zip(*(batch.column(c).to_pylist() for c in ("row_id", "batch_no", "text"))):
            found = words(text)
            if found:
                joined = " ".join(found)
                rows.append((row_id, batch_no, len(found), hashlib.md5(joined.encode()).hexdigest(), joined))
        columns = list(zip(*rows)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["row_id", "batch_no", "n", "digest", "words"])


def _one_in(n: float) -> int:
    return next(rate for below, rate in SAMPLING if n < below)


def suffix_keys(found: list[str], codes: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """The first ``WIDTH`` bytes by which each suffix is sorted, and the hash that decides on sampling."""
    coded = np.fromiter((codes[w] for w in found), np.uint64, len(found))
    count = max(1, len(found) - LEAST_WORDS + 1)
    ahead = LEAST_WORDS << LEVELS
    level = np.concatenate((coded, np.zeros(ahead, np.uint64)))
    with np.errstate(over="ignore"):
        size = 1
        base = _BASE
        first = level.copy()
        for _ in range(LEAST_WORDS - 1):
            first = first[:-1] * _BASE + level[size : size + len(first) - 1]
            base, size = base * _BASE, size + 1
        level, keys = first, []
        for depth in range(LEVELS):
            mixed = (level ^ (level >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            keys.append((mixed ^ (mixed >> np.uint64(32)))[:count])
            level = level[:-size] * base + level[size:] if depth + 1 < LEVELS else level
            base, size = base * base, size * 2
    out = np.empty((count, WIDTH), np.uint8)
    out[:, :8] = keys[0].astype(">u8").view(np.uint8).reshape(count, 8)
    for i, key in enumerate(keys[1:]):
        out[:, 8 + 4 * i : 12 + 4 * i] = (key >> np.uint64(32)).astype(">u4").view(np.uint8).reshape(count, 4)
    return out, keys[0]


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes: dict[str, int] = defaultdict(int)
        parts, ids, numbers, sizes, starts = [], [], [], [], []
        for row_id, batch_no, text in zip(*(batch.column(c).to_pylist() for c in ("row_id", "batch_no", "words"))):
            found = text.split(" ")
            for w in found:
                if w not in codes:
                    codes[w] = xxhash.xxh64_intdigest(w)
            keys, picks = suffix_keys(found, codes)
            # what is looked up is sampled as the shortest text that could match it, so nothing sampled there is missed here
            own = np.flatnonzero(picks % np.uint64(_one_in(SHARE * len(found))) == 0)
            if not len(own):
                own = np.array([int(np.argmin(picks))])
            parts.append(keys[own])
            ids += [row_id] * len(own)
            numbers += [batch_no] * len(own)
            sizes += [len(found)] * len(own)
            starts += [len(own)] * len(own)
        data = np.concatenate(parts).tobytes() if parts else b""
        keys = pa.Array.from_buffers(pa.binary(WIDTH), len(ids), [None, pa.py_buffer(data)]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.int64()), pa.array(numbers, pa.int64()), pa.array(sizes, pa.int32()), pa.array(starts, pa.int32())], names=["key", "row_id", "batch_no", "n", "starts"])


class Segments:
    """Sorted suffixes of the batches so far, in segments of falling size."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, places: np.ndarray) -> None:
        order = np.argsort(keys, kind="stable")
        keys, places = keys[order], places[order]
        while self.parts and len(self.parts[-1][0]) < 2 * len(keys):
            old, at = self.parts.pop()
            keys, places = np.concatenate((old, keys)), np.concatenate((at, places))
            order = np.argsort(keys, kind="stable")
            keys, places = keys[order], places[order]
        self.parts.append((keys, places))

    def near(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(which key, place of a suffix that begins with the same words), neighbours by binary search."""
        for held, places in self.parts:
            at = np.searchsorted(held, keys)
            for step in range(-NEIGHBOURS, NEIGHBOURS):
                index = at + step
                inside = np.flatnonzero((index >= 0) & (index < len(held)))
                same = _first_words(held[index[inside]]) == _first_words(keys[inside])
                yield inside[same], places[index[inside[same]]]


def _first_words(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.uint8).reshape(len(keys), WIDTH)[:, :8].copy().view(np.uint64).ravel()


def _shard(table: pa.Table) -> pa.Table:
    """Pairs of records of one shard whose suffixes are neighbours, batch by batch."""
    raw = np.frombuffer(b"".join(table["key"].to_pylist()), np.uint8)
    keys = raw.reshape(-1, WIDTH).copy().view(f"S{WIDTH}").ravel()
    ids, numbers, sizes, starts = (table[c].to_numpy() for c in ("row_id", "batch_no", "n", "starts"))
    order = np.lexsort((ids, numbers))
    segments, pairs = Segments(), []
    bounds = np.flatnonzero(np.diff(numbers[order])) + 1
    for own in np.split(order, bounds):
        asked = keys[own]
        pairs += [(own[which], place) for which, place in segments.near(asked)]
        alone = Segments()
        alone.add(asked, own)
        pairs += [(own[which], place) for which, place in alone.near(asked)]
        segments.add(asked, own)
    a = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.int64)
    b = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.int64)
    later = (numbers[a] > numbers[b]) | ((numbers[a] == numbers[b]) & (ids[a] > ids[b]))
    alike = np.minimum(sizes[a], sizes[b]) >= SHARE * np.maximum(sizes[a], sizes[b])
    a, b = a[later & alike], b[later & alike]
    # a suffix counts once for a record
    once = np.unique(np.stack((a, ids[b])), axis=1) if len(a) else np.zeros((2, 0), np.int64)
    pair, hits = np.unique(np.stack((ids[once[0]], once[1], starts[once[0]])), axis=1, return_counts=True)
    return pa.table([pa.array(pair[0], pa.int64()), pa.array(pair[1], pa.int64()), pa.array(pair[2].astype(np.int32)), pa.array(hits.astype(np.int64))], names=["row_id", "other_id", "starts", "hits"])


def common_words(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, in one machine operation for each word of b and 64 of a."""
    places: dict[str, int] = defaultdict(int)
    for i, w in enumerate(a):
        places[w] |= 1 << i
    full = (1 << len(a)) - 1
    state = full
    for w in b:
        if w in places:
            hit = state & places[w]
            state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def share_of(a: list[str], b: list[str]) -> float:
    longer = max(len(a), len(b))
    if min(len(a), len(b)) < SHARE * longer or sum((Counter(a) & Counter(b)).values()) < SHARE * longer:
        return 0.0
    return common_words(a, b) / longer


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row_id, other_id, a, b in zip(*(batch.column(c).to_pylist() for c in ("row_id", "other_id", "words", "other_words"))):
            share = share_of(a.split(" "), b.split(" "))
            if share >= SHARE:
                rows.append((row_id, other_id, share))
        columns = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], names=["row_id", "other_id", "share"])


def _links(pairs: DataFrame, texts: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """(row_id, other_id, share) of the pairs that hold, whole texts compared. others: where the other record's text is."""
    own = texts.select("row_id", "words")
    other = (texts if others is None else others).select(F.col("row_id").alias("other_id"), F.col("words").alias("other_words"))
    both = pairs.select("row_id", "other_id").join(own, "row_id").join(other, "other_id")
    return both.repartition(slices(pairs.sparkSession)).mapInArrow(_verify, "row_id long, other_id long, share double")


def suffixes(texts: DataFrame) -> DataFrame:
    """The suffix table of normalised texts. ``texts``: row_id, batch_no, words."""
    return texts.select("row_id", "batch_no", "words").mapInArrow(_suffixes, SUFFIXES)


# Of L words in common order, at least 3 L - n - m - 1 follow each other directly in both texts of n and m words, as
# each word left out parts two at most. With L >= SHARE * max(n, m) that is (3 * SHARE - 2) * n - 1 for either text.


def _least_common(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Words two texts of n and m words must have in common order."""
    return np.ceil(SHARE * np.maximum(n, m) - 1e-9).astype(np.int64)


def _marks(coded: np.ndarray, bits: int) -> bytes:
    """A bit for each bucket of words, the first, second .. time a word stands counting as words of their own: whether their
    number is odd. A word that only one of two texts has flips one bit."""
    order = np.sort(coded)
    new = np.concatenate(([True], order[1:] != order[:-1]))
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    with np.errstate(over="ignore"):
        one = (order ^ (np.arange(len(order), dtype=np.uint64) - first.astype(np.uint64)) * _BASE) * np.uint64(0xBF58476D1CE4E5B9)
    return np.packbits(np.bincount(((one >> np.uint64(40)) % np.uint64(bits)).astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def _word_pairs(found: list[str], codes: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words, hashes of the pairs of adjacent words)."""
    for w in found:
        if w not in codes:
            codes[w] = xxhash.xxh64_intdigest(w)
    coded = np.fromiter((codes[w] for w in found), np.uint64, len(found))
    with np.errstate(over="ignore"):
        both = coded[:-1] * _BASE + coded[1:]
        both = (both ^ (both >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return coded, both ^ (both >> np.uint64(32))


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        codes: dict[str, int] = {}
        for text in batch.column("words").to_pylist():
            _, both = _word_pairs(text.split(" "), codes)
            np.add.at(counts, (both % np.uint64(BUCKETS)).astype(np.int64), 1)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["bucket", "n"])


def shard_names(spark: SparkSession, shards: int) -> np.ndarray:
    """Numbers that name shards so that a shuffle into as many partitions puts one shard in each."""
    names: dict[int, int] = {}
    low, step = 0, 16 * shards
    while len(names) < shards:
        for r in spark.range(low, low + step).select(F.col("id").cast("int").alias("i"), F.pmod(F.hash(F.col("id").cast("int")), F.lit(shards)).alias("p")).collect():
            names.setdefault(r["p"], r["i"])
        low += step
    return np.array([names[p] for p in range(shards)], np.int64)


def _prefix(usual: np.ndarray, names: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes: dict[str, int] = {}
            rows = []
            for row_id, batch_no, text in zip(*(batch.column(c).to_pylist() for c in ("row_id", "batch_no", "words"))):
                found = text.split(" ")
                n = len(found)
                must = math.ceil((3 * SHARE - 2) * n - 1 - 1e-9)
                if must < 1:
                    continue  # so few words must all be equal: an exact copy
                coded, both = _word_pairs(found, codes)
                rank = usual[(both % np.uint64(BUCKETS)).astype(np.int64)]
                order = np.lexsort((both, rank))
                last = order[n - 1 - must]
                # all places of a pair that is in the prefix at one
                own = np.flatnonzero((rank < rank[last]) | ((rank == rank[last]) & (both <= both[last])))
                ranks = np.empty(n - 1, np.int64)
                ranks[order] = np.arange(n - 1)
                marks, wide = _marks(coded, BITS), _marks(coded, WIDE_BITS) if n >= WIDE_FROM else b""
                shard = (both[own] >> np.uint64(32)) % np.uint64(len(names))
                sorting = np.argsort(shard, kind="stable")
                own, ends = own[sorting], np.searchsorted(shard[sorting], np.arange(len(names) + 1, dtype=np.uint64))
                keys, places, near = (both[own] & np.uint64(0xFFFFFFFF)).astype(np.uint32), own.astype(np.int32), np.minimum(ranks[own], 0xFFFF).astype(np.uint16)
                for k in np.flatnonzero(np.diff(ends)):
                    part = slice(ends[k], ends[k + 1])
                    rows.append((int(names[k]), row_id, batch_no, n, marks, wide, keys[part].tobytes(), places[part].tobytes(), near[part].tobytes()))
            columns = list(zip(*rows)) or [()] * 9
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 5)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["shard", "row_id", "batch_no", "n", "marks", "wide", "keys", "places", "ranks"])

    return run


def usual_pairs(texts: DataFrame) -> np.ndarray:
    """How often the pairs of adjacent words occur, in ``BUCKETS`` sums, which bounds what the driver holds."""
    counted = texts.select("words").mapInArrow(_count_pairs, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    usual = np.zeros(BUCKETS, np.int64)
    usual[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    return usual


def prefixes(texts: DataFrame, usual: np.ndarray, shards: int) -> DataFrame:
    """The rarest pairs of adjacent words of each text (row_id, batch_no, n, words), by shard.

    Any order of the pairs gives exact results if it is the same for all texts; rare ones first gives few meetings. Of a pair
    the shard and 32 bits of its hash are kept: others that fall on them only add candidates.
    """
    return texts.select("row_id", "batch_no", "words").mapInArrow(_prefix(usual, shard_names(texts.sparkSession, shards)), PREFIXES)


def _meet(table: pa.Table) -> pa.Table:
    """(row_id, other_id) of one shard: records and earlier accepted ones that may have enough words in common order.

    The pairs of words of all records stand sorted by pair and length; each looks ahead to the last that is not too long, found
    by binary search, so that two records meet once. Two texts of n and m >= n words must share (3 * SHARE - 1) * m - n - 1 pairs, hence one
    among the first 2 n - (3 * SHARE - 1) * m + 1 of the one and n - (3 * SHARE - 2) * m + 1 of the other, by rarity: the longer the other, the fewer.
    """
    ids, numbers, n = (table[c].to_numpy() for c in ("row_id", "batch_no", "n"))
    n = n.astype(np.int32)
    asks, held = (table[c].to_numpy(zero_copy_only=False).astype(bool) for c in ("asks", "accepted"))
    marks = np.frombuffer(b"".join(table["marks"].to_pylist()), np.uint64).reshape(-1, BITS // 64)
    wide = np.frombuffer(b"".join(table["wide"].to_pylist()), np.uint64).reshape(-1, WIDE_BITS // 64)
    wide_at = np.cumsum(n >= WIDE_FROM) - 1
    raw = table["keys"].to_pylist()
    own = np.repeat(np.arange(len(ids), dtype=np.int32), [len(k) // 4 for k in raw])
    keys = np.frombuffer(b"".join(raw), np.uint32).astype(np.int64)
    places = np.frombuffer(b"".join(table["places"].to_pylist()), np.int32)
    ranks = np.frombuffer(b"".join(table["ranks"].to_pylist()), np.uint16)
    when = np.empty(len(ids), np.int32)
    when[np.lexsort((ids, numbers))] = np.arange(len(ids), dtype=np.int32)
    sorting = (keys << 31) | n[own]
    order = np.argsort(sorting, kind="stable")
    sorting, own, places, ranks = sorting[order], own[order], places[order], ranks[order].astype(np.int32)
    longest = np.floor(np.minimum(n[own] / SHARE, (2 * n[own] + 1 - ranks) / (3 * SHARE - 1)) + 1e-9).astype(np.int64)
    ahead = np.maximum(np.searchsorted(sorting, (sorting >> 31 << 31) | longest, "right") - np.arange(len(own)) - 1, 0)
    ends, sizes = np.cumsum(ahead), n[own]
    met, start = [], 0
    least_of = np.ceil(SHARE * np.arange(int(n.max(initial=0)) + 1) - 1e-9).astype(np.int32)
    while start < len(own):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + AT_ONCE, "right")))
        many = ahead[start:stop]
        b = np.arange(ends[stop - 1] - done, dtype=np.int64) + np.repeat(np.arange(start + 1, stop + 1) - (ends[start:stop] - many - done), many)
        i, size, j, other = np.repeat(places[start:stop], many), np.repeat(sizes[start:stop], many), places[b], sizes[b]
        least = least_of[other]  # of the two the later in the order is the longer
        near = np.flatnonzero(np.minimum(i, j) + np.minimum(size - i, other - j) >= least)
        b, least = b[near], least[near]
        x, y = np.repeat(own[start:stop], many)[near], own[b]
        later = when[x] > when[y]
        near = np.flatnonzero(np.where(later, asks[x] & held[y], asks[y] & held[x]) & (x != y))
        x, y, least, later = x[near], y[near], least[near], later[near]
        # bits in which the signatures differ: at most the words that only one of the two has
        room = n[x] + n[y] - 2 * least
        apart = np.bitwise_count(marks[x, 0] ^ marks[y, 0]).astype(np.int32)
        for k in range(1, BITS // 64):
            left = np.flatnonzero(apart <= room)
            if len(left) < len(x):
                x, y, later, room, apart = x[left], y[left], later[left], room[left], apart[left]
            apart += np.bitwise_count(marks[x, k] ^ marks[y, k])
        left = np.flatnonzero(apart <= room)
        x, y = np.where(later[left], x[left], y[left]), np.where(later[left], y[left], x[left])
        met.append(np.unique(x.astype(np.int64) * len(ids) + y))
        start = stop
    pairs = np.unique(np.concatenate(met)) if met else np.zeros(0, np.int64)
    x, y = pairs // max(1, len(ids)), pairs % max(1, len(ids))
    alike = np.ones(len(pairs), bool)
    both = np.flatnonzero((n[x] >= WIDE_FROM) & (n[y] >= WIDE_FROM))
    for start in range(0, len(both), AT_ONCE // (WIDE_BITS // 64)):
        part = both[start : start + AT_ONCE // (WIDE_BITS // 64)]
        a, b = x[part], y[part]
        apart = np.bitwise_count(wide[wide_at[a]] ^ wide[wide_at[b]]).sum(axis=1, dtype=np.int64)
        alike[part] = apart <= n[a] + n[b] - 2 * _least_common(n[a], n[b])
    x, y = x[alike], y[alike]
    return pa.table([pa.array(ids[x]), pa.array(ids[y])], names=["row_id", "other_id"])


def _routed(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the suffixes with the shard of each, pairs with the first records of hot beginnings).

    Where the first words are hot, more of them decide on the shard, up to 80; beyond, the record does. Members of
    a hot beginning that are parted so would not meet: each is paired with the first record of that beginning.
    """
    total = table.count()
    shards = max(slices(table.sparkSession), total // SHARD + 1)
    least = max(LEAST_HOT, int(total * HOT))
    route: Column = F.substring("key", 1, 8)
    table = table.withColumn("route", route)
    firsts = table.sparkSession.createDataFrame([], PAIRS)
    for depth in range(1, LEVELS + 1):
        hot = table.groupBy("route").agg(F.count("*").alias("count"), F.min(F.struct("batch_no", "row_id", "n")).alias("first"))
        hot = materialize(hot.filter(F.col("count") > least).select("route", "first"), "hot")  # at most 1 / HOT rows
        if hot.isEmpty():
            break
        table = table.join(F.broadcast(hot), "route", "left")
        alike = F.least("n", "first.n") >= SHARE * F.greatest("n", "first.n")
        asked = table.filter(F.col("first").isNotNull() & (F.struct("batch_no", "row_id") > F.struct("first.batch_no", "first.row_id")) & alike)
        firsts = firsts.unionByName(asked.groupBy("row_id", F.col("first.row_id").alias("other_id")).agg(F.max("starts").alias("starts"), F.count("*").alias("hits")))
        more = F.substring("key", 1, 8 + 4 * depth) if depth < LEVELS else F.concat("route", F.pmod("row_id", F.lit(64)).cast("string").cast("binary"))
        table = table.withColumn("route", F.when(F.col("first").isNotNull(), more).otherwise(F.col("route"))).drop("first")
    return table.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards))).drop("route"), firsts


def normalised(conversations: DataFrame) -> DataFrame:
    """(row_id, batch_no, n, digest, words) of the rows that have an id, a batch and at least one word; a repeated id counts once."""
    picked = conversations.select(F.col("conv_row_id").cast("long").alias("row_id"), F.col("batch_no").cast("long").alias("batch_no"), F.col("transcript").alias("text"))
    picked = picked.filter(F.col("row_id").isNotNull() & F.col("batch_no").isNotNull() & F.col("text").isNotNull())
    return materialize(picked.mapInArrow(_normal, TEXTS).dropDuplicates(["row_id"]), "texts")


def _first_search(first: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, pairs tried) of neighbours in the suffix arrays, followed to the records they lead back to."""
    routed, firsts = _routed(materialize(suffixes(first), "suffixes"))
    near = routed.groupBy("shard").applyInArrow(_shard, PAIRS).unionByName(firsts)
    covered = near.groupBy("row_id", "other_id").agg(F.sum("hits").alias("hits"), F.max("starts").alias("starts"))
    tried = materialize(covered.filter(F.col("hits") >= COVERAGE * F.col("starts")).select("row_id", "other_id"), "pairs")
    links = materialize(_links(tried, first), "links")
    order = first.select(F.col("row_id").alias("other_id"), "batch_no")
    # a neighbour may itself repeat an accepted record that was further off in the array: compare with that as well
    while True:
        root = links.join(order, "other_id").groupBy("row_id").agg(F.min(F.struct("batch_no", "other_id")).alias("r")).select(F.col("row_id").alias("other_id"), F.col("r.other_id").alias("root"))
        more = links.join(root, "other_id").select("row_id", F.col("root").alias("other_id")).distinct().join(tried, ["row_id", "other_id"], "left_anti")
        more = materialize(more, "more")
        if more.isEmpty():
            return links, tried
        tried = tried.unionByName(more)
        links = materialize(links.unionByName(_links(more, first)), "links")


def _resolved(first: DataFrame, usual: np.ndarray, shards: int, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(links from duplicates to accepted records, prefixes) of records none of which is an exact copy of another.

    known: links (row_id, other_id, share) of some of them to records accepted earlier.
    """
    links, tried = _first_search(first)
    if known is not None:
        links = materialize(links.unionByName(known), "links")
    # every record meets every accepted one, until no record is newly accepted
    ahead = materialize(prefixes(first, usual, shards), "prefixes")
    met = first.select("row_id").limit(0)
    while True:
        settled = materialize(_settle(links), "settled")
        fresh = first.select("row_id").join(settled.select("row_id"), "row_id", "left_anti").join(met, "row_id", "left_anti")
        fresh = materialize(fresh, "fresh")
        if fresh.isEmpty():
            return settled, ahead
        met = met.unionByName(fresh)
        flagged = ahead.withColumn("asks", F.lit(True)).join(fresh.withColumn("accepted", F.lit(True)), "row_id", "left").withColumn("accepted", F.coalesce("accepted", F.lit(False)))
        more = flagged.repartition(shards, "shard").groupBy("shard").applyInArrow(_meet, "row_id long, other_id long").distinct().join(tried, ["row_id", "other_id"], "left_anti")
        more = materialize(more, "more")
        if more.isEmpty():
            return settled, ahead
        tried = tried.unionByName(more)
        links = materialize(links.unionByName(_links(more, first)), "links")


def _heads(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(digest, head) of all texts, and the first record of each text."""
    head = texts.groupBy("digest").agg(F.min(F.struct("batch_no", "row_id")).alias("first")).select("digest", F.col("first.row_id").alias("head"))
    return head, materialize(texts.join(head.select(F.col("head").alias("row_id")), "row_id", "left_semi"), "first")


def _reported(texts: DataFrame, head: DataFrame, settled: DataFrame, order: DataFrame) -> DataFrame:
    """(accepted_id, duplicate_id, share): of several accepted records that with most in common, of equals the first; copies as their head."""
    best = settled.join(order.select(F.col("row_id").alias("other_id"), "batch_no"), "other_id").groupBy("row_id").agg(F.min(F.struct((-F.col("share")).alias("share"), "batch_no", "other_id")).alias("b"))
    best = best.select(F.col("row_id").alias("head"), F.col("b.other_id").alias("accepted_id"), (-F.col("b.share")).alias("share"))
    found = texts.select("row_id", "digest").join(head, "digest").join(best, "head", "left")
    found = found.filter(F.col("accepted_id").isNotNull() | (F.col("row_id") != F.col("head")))
    return found.select(F.coalesce("accepted_id", "head").alias("accepted_id"), F.col("row_id").alias("duplicate_id"), F.coalesce("share", F.lit(1.0)).alias("share"))


def duplicates(conversations: DataFrame) -> DataFrame:
    """(accepted_id, duplicate_id, share): each repeated record with the accepted one it repeats.

    Rows are taken by batch_no, then conv_row_id; rows without either, and texts without a word, are left out. A
    record that repeats several accepted ones is given with the one that shares most, of equals the first. An empty table
    gives no rows. All batches are history and intake in one; ``History`` takes them in as they come.
    """
    texts = normalised(conversations)
    head, first = _heads(texts)
    usual = usual_pairs(first)
    settled, _ = _resolved(first, usual, max(slices(first.sparkSession), int(usual.sum()) // PREFIX_SHARD + 1))
    return _reported(texts, head, settled, first)


class History:
    """Accepted records on storage, in a folder that all executors share: segments of texts and of their rarest pairs, by shard.

    A segment is written once and never changed. An intake adds one; while the one before is less than twice as large, both
    are written as one new segment (as many rows are rewritten as the logarithm of all intakes). A numbered manifest names the segments that
    count: one that is interrupted leaves the last manifest, and with it the history, as it was. The order of pairs is that of the first intake.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._root = jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path + "/manifests")
        if not self._fs.exists(place):
            return []
        return sorted(int(s.getPath().getName()) for s in self._fs.listStatus(place) if s.getPath().getName().isdigit() and self._fs.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))

    def manifest(self) -> dict:
        """{segments: [{name, rows}], usual}; nothing was taken in yet where there are no segments."""
        numbers = self._numbers()
        if not numbers:
            return {"number": 0, "segments": [], "usual": None}
        return json.loads(self.spark.read.text(f"{self.path}/manifests/{numbers[-1]}").first()[0])

    def _publish(self, state: dict) -> None:
        number = state["number"] + 1
        self.spark.createDataFrame([(json.dumps({**state, "number": number}),)], "value string").coalesce(1).write.text(f"{self.path}/manifests/{number}")

    def _read(self, state: dict, kind: str, schema: str) -> DataFrame:
        parts = [f"{self.path}/{kind}/segment={s['name']}" for s in state["segments"]]
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{kind}").parquet(*parts).select(*[c.split()[0] for c in schema.split(", ")])

    def _usual(self, state: dict) -> np.ndarray:
        table = self.spark.read.parquet(f"{self.path}/{state['usual']}").toArrow()  # BUCKETS rows at most
        usual = np.zeros(BUCKETS, np.int64)
        usual[table["bucket"].to_numpy()] = table["n"].to_numpy()
        return usual

    def accepted(self) -> DataFrame:
        """(row_id, batch_no, n, digest, words) of all accepted records."""
        return self._read(self.manifest(), "texts", TEXTS)

    def take_in(self, conversations: DataFrame) -> DataFrame:
        """(accepted_id, duplicate_id, share) of the new rows; what is accepted of them is history from then on.

        The rows are later than all of history whatever their batch_no; among themselves they are taken by batch_no, then id.
        """
        state = self.manifest()
        texts = normalised(conversations)
        held = self._read(state, "texts", TEXTS)
        copies = materialize(texts.select("row_id", "digest").join(held.select("digest", F.col("row_id").alias("accepted_id")), "digest").select("accepted_id", F.col("row_id").alias("duplicate_id"), F.lit(1.0).alias("share")), "copies")
        rest = materialize(texts.join(copies.select(F.col("duplicate_id").alias("row_id")), "row_id", "left_anti"), "rest")
        head, first = _heads(rest)
        if state["usual"] is None:
            usual, name = usual_pairs(first), f"usual-{uuid.uuid4().hex}"
            at = np.flatnonzero(usual)
            self.spark.createDataFrame(pa.table({"bucket": at, "n": usual[at]})).write.parquet(f"{self.path}/{name}")
            state = {**state, "usual": name}
        else:
            usual = self._usual(state)
        known = self._known(state, first, held, usual) if state["segments"] else None
        settled, ahead = _resolved(first, usual, STORED_SHARDS, known)
        order = first.select("row_id", "batch_no").unionByName(held.select("row_id", (F.col("batch_no") - (1 << 40)).alias("batch_no")))
        result = materialize(_reported(rest, head, settled, order).unionByName(copies), "result")
        kept = first.join(settled.select("row_id"), "row_id", "left_anti")
        self._append(state, kept, ahead.join(kept.select("row_id"), "row_id", "left_semi"))
        return result

    def _known(self, state: dict, first: DataFrame, held: DataFrame, usual: np.ndarray) -> DataFrame:
        """Links of new records to accepted ones. Only the shards that the new records fall into are read."""
        asked = materialize(prefixes(first, usual, STORED_SHARDS), "asked")
        shards = [r["shard"] for r in asked.select("shard").distinct().collect()]  # STORED_SHARDS at most
        old = self._read(state, "prefixes", PREFIXES).filter(F.col("shard").isin(shards))
        # ids of history stand before all new ones, whatever their number
        both = asked.withColumn("asks", F.lit(True)).withColumn("accepted", F.lit(False)).unionByName(old.withColumn("batch_no", F.col("batch_no") - (1 << 40)).withColumn("asks", F.lit(False)).withColumn("accepted", F.lit(True)))
        pairs = materialize(both.repartition(STORED_SHARDS, "shard").groupBy("shard").applyInArrow(_meet, "row_id long, other_id long").distinct(), "met")
        wanted = held.join(pairs.select(F.col("other_id").alias("row_id")).distinct(), "row_id", "left_semi")
        return materialize(_links(pairs, first, wanted), "known")

    def _append(self, state: dict, texts: DataFrame, ahead: DataFrame) -> None:
        texts = materialize(texts.select("row_id", "batch_no", "n", "digest", "words"), "kept")
        rows = texts.count()
        if not rows:
            return self._publish(state) if state["number"] == 0 else None
        segments = list(state["segments"])
        while segments and segments[-1]["rows"] < 2 * rows:
            last = segments.pop()
            old = {**state, "segments": [last]}
            texts, ahead, rows = texts.unionByName(self._read(old, "texts", TEXTS)), ahead.unionByName(self._read(old, "prefixes", PREFIXES).select(*ahead.columns)), rows + last["rows"]
        name = f"{state['number']:06d}-{uuid.uuid4().hex[:8]}"
        texts.write.option("compression", "zstd").parquet(f"{self.path}/texts/segment={name}")
        ahead.repartition("shard").sortWithinPartitions("shard", "row_id").write.option("compression", "zstd").partitionBy("shard").parquet(f"{self.path}/prefixes/segment={name}")
        self._publish({**state, "segments": [*segments, {"name": name, "rows": rows}]})


def _settle(links: DataFrame) -> DataFrame:
    """The links that lead from a duplicate to an accepted record.

    A record is accepted once all it is linked to are duplicates, and a duplicate once one of them is accepted.
    Each round settles at least the earliest records that are open.
    """
    linked = links.select("row_id").distinct()
    accepted = fresh = links.select(F.col("other_id").alias("id")).distinct().join(linked.withColumnRenamed("row_id", "id"), "id", "left_anti")
    left = links.select("row_id", "other_id")
    while True:
        repeated = left.join(fresh.withColumnRenamed("id", "other_id"), "other_id", "left_semi").select("row_id").distinct()
        repeated = materialize(repeated, "repeated")
        undecided = left.join(repeated, "row_id", "left_anti")
        after = materialize(undecided.join(repeated.withColumnRenamed("row_id", "other_id"), "other_id", "left_anti"), "left")
        fresh = materialize(undecided.select("row_id").distinct().join(after, "row_id", "left_anti").withColumnRenamed("row_id", "id"), "fresh")
        if not fresh.isEmpty():
            accepted = accepted.unionByName(fresh)
        elif after.isEmpty():
            break
        left = after
    to_accepted = links.join(accepted.withColumnRenamed("id", "other_id"), "other_id", "left_semi")
    return to_accepted.join(accepted.withColumnRenamed("id", "row_id"), "row_id", "left_anti")


def found(conversations: DataFrame) -> DataFrame:
    return duplicates(conversations).select("accepted_id", "duplicate_id")


def incremental(conversations: DataFrame, path: str, steps: int = 3) -> DataFrame:
    """(accepted_id, duplicate_id, share) as ``duplicates`` gives, but taken in by ``steps`` intakes of neighbouring batches.

    Intakes are cut so that each holds about as many batches.
    """
    numbers = [r["batch_no"] for r in conversations.select("batch_no").filter("batch_no is not null").distinct().orderBy("batch_no").collect()]  # one for each batch
    history = History(conversations.sparkSession, path)
    parts = [numbers[i * len(numbers) // steps : (i + 1) * len(numbers) // steps] for i in range(steps)]
    found = [history.take_in(conversations.filter(F.col("batch_no").between(part[0], part[-1]))) for part in parts if part]
    schema = "accepted_id long, duplicate_id long, share double"
    result = conversations.sparkSession.createDataFrame([], schema)
    for part in found:
        result = result.unionByName(part)
    return result
