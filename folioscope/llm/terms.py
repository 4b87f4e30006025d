"""Record terms: the encoded input that term counting and term scoring share.

A record is a distinct ``digest_id``; rows without one are no records. A term of the field
``keywords`` is a list member in NFC, stripped, in lower case; null and empty members are
no terms. A ``word_count`` is a term by its decimal digits.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENTRY_SCHEMA = "digest_id long, field_name string, term string, tf long"


def normal_term(raw: str) -> str:
    """NFC, stripped of outer white space, lower case."""
    return unicodedata.normalize("NFC", unicodedata.normalize("NFC", raw).strip().lower())


def records(docs: DataFrame) -> DataFrame:
    """One row per digest_id. Repeats are equal in all columns, so any of them will do.

    Missing columns of the two counted fields are taken as null, further columns are ignored.
    """
    have = set(docs.columns)
    words = F.col("keywords").cast("array<string>") if "keywords" in have else F.lit(None).cast("array<string>")
    count = F.col("word_count").cast("long") if "word_count" in have else F.lit(None).cast("long")
    picked = docs.select(F.col("digest_id").cast("long").alias("digest_id"), words.alias("keywords"), count.alias("word_count"))
    return picked.filter(F.col("digest_id").isNotNull()).dropDuplicates(["digest_id"])


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        lists = batch.column(1)
        parent = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
        coded = pc.list_flatten(lists).dictionary_encode()
        raw = coded.dictionary.to_pylist()
        codes = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        order: dict[str, int] = {}
        recode = np.empty(len(raw) + 1, np.int64)
        for i, value in enumerate(raw):
            term = normal_term(value)
            recode[i] = order.setdefault(term, len(order)) if term else -1
        recode[-1] = -1
        codes = recode[codes]
        kept = codes >= 0
        size = max(1, len(order))
        cells, tf = np.unique(parent[kept] * size + codes[kept], return_counts=True)
        terms = pa.array(list(order), pa.string())
        counts = batch.column(2)
        numbered = pc.indices_nonzero(pc.is_valid(counts))
        yield pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([ids.take(pa.array(cells // size)), ids.take(numbered)]).cast(pa.int64()),
                pa.array(["keywords"] * len(cells) + ["word_count"] * len(numbered), pa.string()),
                pa.concat_arrays([terms.take(pa.array(cells % size)), counts.take(numbered).cast(pa.string())]),
                pa.concat_arrays([pa.array(tf.astype(np.int64)), pa.array(np.ones(len(numbered), np.int64))]),
            ],
            names=["digest_id", "field_name", "term", "tf"],
        )


def entries(docs: DataFrame) -> DataFrame:
    """(digest_id, field_name, term, tf): every distinct term of every record, once, with its count there."""
    return records(docs).select("digest_id", "keywords", "word_count").mapInArrow(_encode, ENTRY_SCHEMA)
