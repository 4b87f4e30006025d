"""Problem 9: passages of evaluation items inside corpus documents.

Method: a BM25 inverted index of the items, in blocks with the greatest weight of each term (block-max
WAND). Every run of ``RUN`` words of every document is a query. The blocks of its rarest word are gone through and left as soon
as another word's block weight shows that none of their items can reach the threshold; the items of the blocks that remain are
scored word by word in the same way. Who reaches the threshold is verified word by word, and question and answer are compared as well.

All words of a run are mandatory: what a block or an item lacks ends its score. The threshold is the least score of an item that holds
all words, the sum of each word's least weight in any item. A leaked run scores at least that, so retrieval misses none.

Items are sent to the executors in indexes of up to ``INDEX_WORDS`` words, some 50,000 items; that bound is checked. Documents are read
once for each such index: once for all test sets of that size.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Consecutive words that make a leak.
RUN = 13
BLOCK = 16
K1, B = 1.2, 0.75
#: Words of the items in one index, passages, questions and answers, so what is sent to executors stays bounded.
INDEX_WORDS = 4_000_000
#: Words of documents that are looked up at once, and pairs of a run and a block.
CHUNK, PAIRS = 1 << 17, 1 << 19
#: For rounding in running sums.
SLACK = 1e-2
#: Share of a question's words that a document must hold to count as holding the question.
QUESTION = 0.8
WORD = re.compile(r"[^\W_]+")
LEAKS = "doc_id long, item_id long, score double, runs int, question_share double, answer_seen boolean, extent string"


def words(text: str | None) -> list[str]:
    """Runs of letters and digits, in lower case."""
    return WORD.findall(text.lower()) if text else []


def _spans(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, place) of the ranges that start at ``first`` and hold ``count`` places each."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)


class Postings:
    """Weights of (term, place), a place being a block or an item; sorted, so that a term's places are one range."""

    def __init__(self, terms: np.ndarray, places: np.ndarray, weights: np.ndarray, n_terms: int, n_places: int) -> None:
        keys = terms.astype(np.int64) * n_places + places
        order = np.lexsort((-weights, keys))
        self.keys, first = np.unique(keys[order], return_index=True)
        self.weights, self.n_places = weights[order][first], n_places
        self.first = np.searchsorted(self.keys, np.arange(n_terms + 1, dtype=np.int64) * n_places)

    def count(self, terms: np.ndarray) -> np.ndarray:
        return self.first[terms + 1] - self.first[terms]

    def look_up(self, terms: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether the term is there, its weight)."""
        key = terms.astype(np.int64) * self.n_places + places
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return self.keys[at] == key, self.weights[at]


class Index:
    """The inverted index of a bounded number of items."""

    def __init__(self, items: list[tuple[int, str | None, str | None, str | None]]) -> None:
        same: dict[tuple[str, ...], list[int]] = defaultdict(list)
        self.asked: dict[int, tuple[set[str], list[str]]] = {}
        for item_id, passage, question, answer in items:
            found = tuple(words(passage))
            if len(found) >= RUN and item_id not in same[found]:
                same[found].append(item_id)
                self.asked.setdefault(item_id, (set(words(question)), words(answer)))
        passages = sorted(p for p, ids in same.items() if ids)
        self.items = [same[p] for p in passages]
        self.ids: dict[str, int] = {}
        self.passages = [np.array([self.ids.setdefault(w, len(self.ids)) for w in p], np.int32) for p in passages]
        n, mean = len(passages), sum(map(len, passages)) / max(1, len(passages))
        terms, places, tf = [], [], []
        for i, p in enumerate(self.passages):
            t, c = np.unique(p, return_counts=True)
            terms.append(t)
            places.append(np.full(len(t), i))
            tf.append(c)
        if not n:
            return
        term, place, count = np.concatenate(terms), np.concatenate(places), np.concatenate(tf).astype(np.float64)
        df = np.bincount(term, minlength=len(self.ids))
        length = np.array([len(p) for p in self.passages])
        weight = np.log(1 + (n - df[term] + 0.5) / (df[term] + 0.5)) * count * (K1 + 1) / (count + K1 * (1 - B + B * length[place] / mean))
        self.by_item = Postings(term, place, weight, len(self.ids), n)
        self.by_block = Postings(term, place // BLOCK, weight, len(self.ids), (n + BLOCK - 1) // BLOCK)
        self.least, self.most = np.full(len(self.ids), np.inf), np.zeros(len(self.ids))
        np.minimum.at(self.least, term, weight)
        np.maximum.at(self.most, term, weight)

    def _narrowed(self, postings: Postings, run: np.ndarray, place: np.ndarray, score: np.ndarray, asked: np.ndarray, need: np.ndarray, ahead: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The (run, place) whose score can reach what the run needs, word by word, rare ones first. ahead: the most that the words to come can add."""
        for k in range(1, RUN):
            there, more = postings.look_up(asked[run, k], place)
            score = score + more
            kept = np.flatnonzero(there & (score + ahead[run, k] >= need[run]))
            run, place, score = run[kept], place[kept], score[kept]
        return run, place, score

    def candidates(self, coded: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """(first word, item's passage, score) for each run that starts at a word of ``coded``."""
        if len(coded) < RUN or not self.items:
            return
        unknown = np.concatenate(([0], np.cumsum(coded == len(self.ids))))
        starts = np.flatnonzero(unknown[RUN:] == unknown[:-RUN])
        if not len(starts):
            return
        asked = coded[starts[:, None] + np.arange(RUN)]
        asked = np.take_along_axis(asked, np.argsort(self.by_block.count(asked), axis=1, kind="stable"), axis=1)
        need = self.least[asked].sum(axis=1) - SLACK
        most = self.most[asked]
        ahead = np.cumsum(most[:, ::-1], axis=1)[:, ::-1] - most
        many = self.by_block.count(asked[:, 0])
        ends = np.cumsum(many)
        low = 0
        while low < len(starts):
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PAIRS, "right")))
            run, at = _spans(self.by_block.first[asked[low:high, 0]], many[low:high])
            run = run + low
            run, block, _ = self._narrowed(self.by_block, run, self.by_block.keys[at] % self.by_block.n_places, self.by_block.weights[at], asked, need, ahead)
            rare = asked[run, 0].astype(np.int64) * self.by_item.n_places
            first = np.searchsorted(self.by_item.keys, rare + block * BLOCK)
            last = np.searchsorted(self.by_item.keys, rare + np.minimum((block + 1) * BLOCK, self.by_item.n_places))
            owner, at = _spans(first, last - first)
            run, item, score = self._narrowed(self.by_item, run[owner], self.by_item.keys[at] % self.by_item.n_places, self.by_item.weights[at], asked, need, ahead)
            yield from zip(starts[run].tolist(), item.tolist(), score.tolist())
            low = high

    def holds(self, item: int, run: np.ndarray) -> bool:
        """Whether the item's passage has the run word by word."""
        passage = self.passages[item]
        return any((passage[k : k + RUN] == run).all() for k in np.flatnonzero(passage[: len(passage) - RUN + 1] == run[0]))

    def leaks(self, ids: list[int], texts: list[str | None]) -> list[tuple]:
        out: list[tuple] = []
        none = len(self.ids)
        get = self.ids.get
        batch: list[tuple[int, list[str], int]] = []
        codes: list[int] = []

        def close() -> None:
            coded = np.array(codes, np.int32)
            starts = [b[2] for b in batch]
            best: dict[tuple[int, int], list] = {}
            for first, i, score in self.candidates(coded):
                if self.holds(i, coded[first : first + RUN]):
                    doc = int(np.searchsorted(starts, first, side="right")) - 1
                    was = best.setdefault((doc, i), [0.0, 0])
                    was[0], was[1] = max(was[0], score), was[1] + 1
            for (doc, i), (score, runs) in best.items():
                doc_id, found, _ = batch[doc]
                seen = set(found)
                for item_id in self.items[i]:
                    question, answer = self.asked[item_id]
                    share = len(question & seen) / len(question) if question else 0.0
                    answered, posed = bool(answer) and set(answer) <= seen, bool(question) and share >= QUESTION
                    extent = "whole item" if answered and posed else "passage and answer" if answered else "passage and question" if posed else "passage"
                    out.append((doc_id, item_id, score, runs, share, answered, extent))
            batch.clear()
            codes.clear()

        for doc_id, text in zip(ids, texts):
            found = words(text)
            if len(found) < RUN:
                continue
            batch.append((doc_id, found, len(codes)))
            codes += [get(w, none) for w in found]
            codes.append(none)  # no passage reaches into the next document
            if len(codes) >= CHUNK:
                close()
        if batch:
            close()
        return out


def _search(items: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for batch in batches:
            index = index or Index(items.value)
            rows = index.leaks(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
            columns = list(zip(*rows)) or [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.float64(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "item_id", "score", "runs", "question_share", "answer_seen", "extent"])

    return run


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, runs, question_share, answer_seen, extent), once for each pair that leaked.

    score is the best of the document's runs against the item. runs tells how many runs they have in common, extent what
    of the item the document holds. Null and short texts and items leak nothing; items of one passage all count; repeated
    rows of documents or items count once.
    """
    picked = items.select(F.col("item_id").cast("long").alias("item_id"), "passage", "question", "answer").filter(F.col("item_id").isNotNull() & F.col("passage").isNotNull())
    # words by their gaps: an upper bound of what an item adds to an index
    size = F.length(F.concat_ws(" ", "passage", "question", "answer")) / 2 + 1
    total = picked.agg(F.coalesce(F.sum(size), F.lit(0.0))).first()[0]
    passes = int(total // INDEX_WORDS) + 1
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("text").isNotNull())
    numbered = picked.withColumn("pass", F.pmod(F.xxhash64("item_id"), F.lit(passes)))
    found = None
    for k in range(passes):
        part = numbered.filter(F.col("pass") == k).drop("pass")
        held = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in part.orderBy("item_id", "passage").collect()])  # some INDEX_WORDS words
        leaked = texts.mapInArrow(_search(held), LEAKS)
        found = leaked if found is None else found.unionByName(leaked)
    return found.dropDuplicates(["doc_id", "item_id"])


def found(docs: DataFrame, items: DataFrame) -> DataFrame:
    return leaks(docs, items).select("doc_id", "item_id")
