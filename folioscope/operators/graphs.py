"""Connected classes over a table of links, without a class ever meeting in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.runtime import materialize, with_lookup


def classes(links: DataFrame) -> DataFrame:
    """(id, class_id): the least id that each linked id is connected to. links: (a, b).

    Alternates linking every node's larger neighbours to its least one and its smaller neighbours to the least as
    well, until each node links to the least of its class alone; rounds grow with the logarithm of the longest chain.
    """
    edges = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialize(edges, "edges")
    size = edges.count()
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # a node of very many neighbours is sent to them, see with_lookup
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("rows"))
        large = with_lookup(both, least, ["u"], 2 * size).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        starred = materialize(large.filter(F.col("u") != F.col("v")).distinct(), "large")
        low = starred.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("rows"))
        small = with_lookup(starred, low, ["u"], starred.count()).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        after = materialize(small.filter(F.col("u") != F.col("v")).distinct(), "small")
        count = after.count()
        same = count == size and after.join(edges, ["u", "v"], "left_anti").isEmpty()
        edges, size = after, count
        if same:
            break
    heads = edges.select(F.col("v").alias("id"), F.col("v").alias("class_id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("class_id")).unionByName(heads)
