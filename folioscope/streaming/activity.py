"""Structured Streaming over arriving rows: windowed activity, a ledger that takes each export in once, and newest versions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators.exports import ledger_new, newest


def windowed(events: DataFrame, width: str = "1 day", late: str | None = None) -> DataFrame:
    """(start, event_type, events, users, value): for a stream with a watermark of ``late``, for a table without.

    Users are counted exactly on a table. A stream cannot count distinct ones exactly in bounded state: there the column is
    ``users_about``, an estimate.
    """
    source = events.withWatermark("ts", late) if late else events
    users = F.approx_count_distinct("user_id").alias("users_about") if late else F.countDistinct("user_id").alias("users")
    counted = source.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("events"), users, F.round(F.sum("value"), 2).alias("value"))
    return counted.select(F.col("w.start").alias("start"), "event_type", "events", counted.columns[3], "value")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = None) -> DataFrame:
    """(user_id, start, end, events) of sessions that a gap ends."""
    source = events.withWatermark("ts", late) if late else events
    counted = source.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("events"))
    return counted.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")


def take_in(stream: DataFrame, ledger_path: str, accept: Callable[[DataFrame, str], None], checkpoint: str):
    """Hand each export that is not yet recorded under its fingerprint to ``accept``, under the name of its intake.

    The ledger is written before ``accept`` runs, under the number of the batch: ``pending``, and ``done`` once accept returned. A batch that is
    repeated after a failure finds what it had pending and hands over the same exports under the same name, so an ``accept`` that
    overwrites by that name takes nothing in twice, and none is lost. Content decides, not arrival, so nothing is late.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark, name = batch.sparkSession, f"intake-{number:08d}"
        jvm = spark.sparkContext._jvm
        place = lambda kind: jvm.org.apache.hadoop.fs.Path(f"{ledger_path}/{kind}/{name}/_SUCCESS")
        files = place("done").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if files.exists(place("done")):
            return
        if not files.exists(place("pending")):
            known = ledger(spark, ledger_path).filter(F.col("intake") != name)
            ledger_new(batch, known).select("export_key", "fingerprint").distinct().write.mode("overwrite").parquet(f"{ledger_path}/pending/{name}")
        pending = spark.read.schema("export_key string, fingerprint string").parquet(f"{ledger_path}/pending/{name}")
        accept(batch.join(pending, ["export_key", "fingerprint"], "left_semi"), name)
        pending.write.mode("overwrite").parquet(f"{ledger_path}/done/{name}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(export_key, fingerprint, intake) of all exports that intakes have recorded."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/pending")
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    schema = "export_key string, fingerprint string"
    if not files.exists(root):
        return spark.createDataFrame([], schema + ", intake string")
    found = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{path}/pending")
    return found.withColumn("intake", F.regexp_extract(F.input_file_name(), r"(intake-\d+)/[^/]*$", 1))


def newest_in_batch(batch: DataFrame, known: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The newest row of each key over what is known and what arrived."""
    return newest(known.unionByName(batch), keys, [F.col(order)])
