"""Session helpers shared by all operators: durable intermediate tables and table access."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can read and write.

    It is the one named in ``spark.checkpoint.dir``. Only where that is unset, as in
    tests on a local master, a folder of this machine is made.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = getattr(spark, "_folioscope_dir", None)
        if base is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
            base = "file://" + tempfile.mkdtemp(prefix="folioscope-")
            spark._folioscope_dir = base
    return base.rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """This application's own folder below the shared one. It is deleted when the application ends."""
    path = f"{shared_dir(spark)}/folioscope/{spark.sparkContext.applicationId}"
    if getattr(spark, "_folioscope_scratch", None) != path:
        jvm = spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
        spark._folioscope_scratch = path
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    Cuts the lineage with a table that survives the loss of executors, and keeps
    later reads column-pruned. Nothing is held on one machine.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete every table that ``materialize`` wrote for this application, before it ends."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test or corpus table by name."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


#: Tables of up to so many bytes may be spread over the cores by a shuffle; larger ones are read as they are split.
SMALL_BYTES = 1 << 30


def spread(df: DataFrame) -> DataFrame:
    """A table for work on every row: a small one of fewer partitions than cores, a single file say, goes over all of them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > SMALL_BYTES or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


#: A key of this share of all rows is hot; there are at most 1 / HOT_SHARE of them, whatever the collection's size.
HOT_SHARE = 0.001


def with_lookup(rows: DataFrame, lookup: DataFrame, keys: list[str], total: int, weight: str = "rows") -> DataFrame:
    """rows joined with lookup, which has each key once and tells by ``weight`` how many rows have it; that column is dropped.

    Hot keys, of which there is a bounded number, are sent to their rows; the others meet by shuffle, so no task gets a hot key's rows.
    """
    least = max(2, int(total * HOT_SHARE))
    hot, cold = lookup.filter(F.col(weight) >= least).drop(weight), lookup.filter(F.col(weight) < least).drop(weight)
    return rows.join(F.broadcast(hot), keys).unionByName(rows.join(cold, keys))


def slices(spark: SparkSession) -> int:
    """Partitions for a stage whose work, not its bytes, needs all cores."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's source to the executors, once for each session, so that no worker needs it installed."""
    if not getattr(spark, "_folioscope_shipped", False):
        root = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="folioscope-src-")) / "folioscope.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as bundle:
            for source in sorted(root.rglob("*.py")):
                bundle.write(source, source.relative_to(root.parent).as_posix())
        spark.sparkContext.addPyFile(str(target))
        spark._folioscope_shipped = True
    return spark
