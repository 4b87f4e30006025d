"""Problem 6: how characteristic a term is of a record.

Method: correspondence analysis of the table record x term. A cell's residual is observed
minus expected count over the square root of the expected one; the adjusted residual also
divides by the root of (1 - row share) * (1 - column share). All of it is DataFrame arithmetic.

The contract of ``p6_found`` ranks by a logarithmic weight of the same margins, which orders
terms differently than residuals do. ``term_residuals`` gives both measures of every cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.terms import entries
from folioscope.runtime import materialize

#: A term in at least this share of the records is hot. As a record of k terms can hold k at most,
#: there are at most (terms of a record, on average) / share of them, whatever the collection's size.
HOT_SHARE = 0.001
DIGITS = 9


def _with_margins(cells: DataFrame, columns: DataFrame, n: int) -> DataFrame:
    """Join the columns' margins to the cells; the bounded hot terms by broadcast, so no key of the shuffle is hot."""
    least = max(1, int(n * HOT_SHARE))
    hot, cold = columns.filter(F.col("df") >= least), columns.filter(F.col("df") < least)
    fields = ["df", "column_total"]
    at_once = cells.join(F.broadcast(hot), "term", "left")
    done = at_once.filter(F.col("df").isNotNull())
    rest = at_once.filter(F.col("df").isNull()).drop(*fields).join(cold, "term")
    return done.unionByName(rest)


def term_residuals(docs: DataFrame) -> DataFrame:
    """(digest_id, term, tf, df, expected, residual, adjusted, weight) for each term of each record's keywords.

    ``weight`` is (1 + ln tf) * (ln((n + 1) / (df + 1)) + 1), rounded to 9 decimals. A margin that holds
    the whole table leaves no variance; its adjusted residual is 0. Records without a term are not
    in the table; no records give no rows.
    """
    cells = materialize(entries(docs).filter(F.col("field_name") == "keywords").select("digest_id", "term", "tf"), "cells")
    columns = materialize(cells.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("column_total")), "columns")
    rows = cells.groupBy("digest_id").agg(F.sum("tf").alias("row_total"))
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("row_total"), F.lit(0))).first()
    joined = _with_margins(cells, columns, n).join(rows, "digest_id")
    expected = F.col("row_total") * F.col("column_total") / F.lit(float(max(total, 1)))
    spread = (1 - F.col("row_total") / F.lit(float(max(total, 1)))) * (1 - F.col("column_total") / F.lit(float(max(total, 1))))
    residual = (F.col("tf") - F.col("expected")) / F.sqrt("expected")
    weight = (1 + F.log(F.col("tf").cast("double"))) * (F.log((F.lit(n) + 1) / (F.col("df") + 1)) + 1)
    return (
        joined.withColumn("expected", expected)
        .withColumn("residual", residual)
        .withColumn("adjusted", F.when(spread > 0, F.col("residual") / F.sqrt(spread)).otherwise(F.lit(0.0)))
        .select("digest_id", "term", "tf", "df", "expected", "residual", "adjusted", F.round(weight, DIGITS).alias("weight"))
    )


def _first(scored: DataFrame, by: str) -> DataFrame:
    """Each record's top term; of equals the first by code point. Aggregates before it shuffles."""
    best = F.min(F.struct((-F.col(by)).alias("score"), F.col("term"))).alias("best")
    return scored.groupBy("digest_id").agg(best).select("digest_id", F.col("best.term").alias("term"))


def found(docs: DataFrame) -> DataFrame:
    """(digest_id, term): the term of the highest ``weight``, which is the contract's measure over the margins that the residuals are made of."""
    return _first(term_residuals(docs), "weight")


def most_characteristic(docs: DataFrame) -> DataFrame:
    """(digest_id, term): the term of the highest adjusted residual, rounded to 9 decimals."""
    return _first(term_residuals(docs).withColumn("adjusted", F.round("adjusted", DIGITS)), "adjusted")
