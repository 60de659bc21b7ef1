"""Session set-up, the shared folder, and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows times this many bytes is taken as the size of a narrow table held in memory as a hash relation.
ROW_BYTES = 128
#: No side larger than this is ever broadcast.
BROADCAST_LIMIT = 64 * 1024 * 1024


def get_spark(cores: str | int = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the library expects; on a cluster use the session at hand."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TIDEFRAME_DRIVER_MEMORY", "8g"))
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once an application, so that they need no copy of their own."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import shutil
    from pathlib import Path

    root = Path(__file__).resolve().parent
    at = tempfile.mkdtemp(prefix="tideframe-zip-")  # read by the driver only, which serves it to the executors
    copy = Path(at) / "src"
    shutil.copytree(root, copy / root.name, ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(f"{at}/tideframe_package", "zip", copy))
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir``.

    Only where that is unset, as in tests on one machine, a folder of our own is made; on a
    cluster without the setting this raises rather than fall back on a machine-local folder.
    """
    got = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not got:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        got = "file://" + tempfile.mkdtemp(prefix="tideframe-")
        spark.conf.set("spark.checkpoint.dir", got)
    return got.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/tideframe/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def clean_scratch(spark: SparkSession) -> None:
    """Delete what this application has put into the shared folder; frames that read it can no longer be used."""
    from tideframe.functions import fs

    fs.delete(spark, f"{shared_dir(spark)}/tideframe/{spark.sparkContext.applicationId}")


def materialise(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Cut the lineage by a table in the shared folder: it outlives any executor, and is read as columns."""
    spark = df.sparkSession
    path = scratch(spark, name)
    w = df.write.mode("overwrite").option("compression", "zstd")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int, row_bytes: int = ROW_BYTES, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``df`` marked for broadcast if its counted rows prove it small, else left to a shuffled join."""
    return F.broadcast(df) if rows * row_bytes <= limit else df


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where a scan has fewer parts than there are cores, as with one small file; else unchanged.

    For work that is heavy on each row and would otherwise stay in the scan's few tasks. A table of any size has
    more parts than that and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
