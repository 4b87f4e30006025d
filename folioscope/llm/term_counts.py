"""Problem 1: how often every distinct value occurs, and in how many records.

Method: a global integer dictionary, encoded terms, count arrays for each block of records,
and the sum of these arrays by identifier range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm.terms import entries
from folioscope.runtime import materialize

#: Identifiers in one count array.
RANGE = 1 << 14
#: Blocks of records whose counts meet in one array before arrays are summed.
BLOCKS_PER_ARRAY = 64
RARE_RECORDS = 2
COMMON_PERCENT = 5

#: Bytes of a place in a count array, and of a term in a list of those that occur: the shorter of both is sent.
DENSE_BYTES, SPARSE_BYTES = 16, 20

ARRAYS = "id_range long, ids array<int>, occurrences array<long>, records array<long>"
COUNTS = "term_id long, occurrences long, records long"


def dense_dictionary(blockwise: DataFrame) -> DataFrame:
    """(field_name, term, term_id): identifiers 0 .. number of terms - 1.

    Terms keep the place they have within their partition; partitions get their offset from
    one count each, so that nothing but those counts meets in one task. The table is
    written before it is numbered, as identifiers must not change when a task is repeated.
    """
    place = F.monotonically_increasing_id()
    numbered = materialize(
        blockwise.select("field_name", "term").distinct().withColumn("place", place)
        .select("field_name", "term", F.shiftright("place", 33).alias("part"), F.col("place").bitwiseAND(F.lit((1 << 33) - 1)).alias("local")),
        "dictionary",
    )
    sizes = numbered.groupBy("part").count().orderBy("part").collect()  # one row per partition
    offset, rows = 0, []
    for row in sizes:
        rows.append((row["part"], offset))
        offset += row["count"]
    starts = numbered.sparkSession.createDataFrame(rows, "part long, start long")
    return numbered.join(F.broadcast(starts), "part").select("field_name", "term", (F.col("start") + F.col("local")).alias("term_id"))


def _scatter(table: pa.Table) -> pa.Table:
    """The count arrays of one range and group of blocks. Where most places are empty, those that are not are listed with their numbers."""
    span = int(table["id_range"][0].as_py())
    ids = table["term_id"].to_numpy() - span * RANGE
    total = [np.zeros(RANGE, np.int64) for _ in range(2)]
    for array, name in zip(total, ("occurrences", "records")):
        np.add.at(array, ids, table[name].to_numpy())
    used = np.flatnonzero(total[1])
    sparse = len(used) * SPARSE_BYTES < RANGE * DENSE_BYTES
    lists = [pa.array([x[used] if sparse else x], pa.list_(pa.int64())) for x in total]
    return pa.table([pa.array([span], pa.int64()), pa.array([used.astype(np.int32) if sparse else None], pa.list_(pa.int32())), *lists], names=["id_range", "ids", "occurrences", "records"])


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up a group's arrays, batch by batch; two arrays are all that is held."""
    total, span = None, 0
    for batch in batches:
        span = int(batch.column("id_range")[0].as_py())
        total = total or [np.zeros(RANGE, np.int64) for _ in range(2)]
        for ids, *counts in zip(*(batch.column(n) for n in ("ids", "occurrences", "records"))):
            at = ids.values.to_numpy() if ids.is_valid else slice(None)
            for array, own in zip(total, counts):
                array[at] += own.values.to_numpy()
    if total is not None:
        used = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(span * RANGE + used), pa.array(total[0][used]), pa.array(total[1][used])], names=["term_id", "occurrences", "records"])


def term_counts(docs: DataFrame) -> DataFrame:
    """(field_name, term, occurrences, records, mark) of every distinct term.

    ``mark`` is ``rare`` for a term of at most ``RARE_RECORDS`` records, else ``common`` for one in
    more than ``COMMON_PERCENT`` in 100 of all records, else null; in a collection so small that
    both hold, a term is rare. Records without terms count among all records. No records give
    no rows. Repeated rows count once. A term may fill any share of the rows: counts leave a block
    as one row for each term.
    """
    found = entries(docs).withColumn("block", F.spark_partition_id())
    blockwise = materialize(found.groupBy("block", "field_name", "term").agg(F.sum("tf").alias("occurrences"), F.count("*").alias("records")), "blocks")
    dictionary = materialize(dense_dictionary(blockwise), "terms")
    coded = blockwise.join(dictionary, ["field_name", "term"]).select(
        F.floor(F.col("term_id") / RANGE).alias("id_range"), F.floor(F.col("block") / BLOCKS_PER_ARRAY).alias("blocks"), "term_id", "occurrences", "records"
    )
    arrays = coded.groupBy("id_range", "blocks").applyInArrow(_scatter, ARRAYS)
    totals = arrays.groupBy("id_range").applyInArrow(_sum, COUNTS)
    n = docs.agg(F.countDistinct("digest_id")).first()[0]
    mark = F.when(F.col("records") <= RARE_RECORDS, "rare").when(F.col("records") * 100 > COMMON_PERCENT * n, "common")
    return totals.join(dictionary, "term_id").select("field_name", "term", "occurrences", "records", mark.cast(T.StringType()).alias("mark"))


def found(docs: DataFrame) -> DataFrame:
    return term_counts(docs).filter(F.col("mark").isNotNull()).select("field_name", "term", "mark")
