"""Session settings and the shared folder used for checkpoints and working tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the library relies on. Cluster values (executors, memory, shuffle partitions) belong
# to spark-submit; nothing here fixes them.
REQUIRED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}

# Tables that stay are written with it: about half the bytes of Spark's default.
CODEC = "zstd"
# Names a row of a written table, see named_rows.
ROW = "_row_name"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def lake_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, and the place reliable checkpoints go.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where driver and
    executors are one process, falls back to a temporary folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if named:
        if current is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    if current is not None:
        return os.path.dirname(current.rstrip("/"))
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="millrace-")
    sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never reused, so nothing has to be cleared."""
    return f"{shared_root(spark)}/work/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back: the lineage ends there, a lost
    executor cannot change what was written, and the optimizer knows its size."""
    path = scratch_path(df.sparkSession, label)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def named_rows(df: DataFrame) -> DataFrame:
    """A table as read from Parquet files, with a column ``ROW`` that tells its rows apart: the file and the place in it.
    Unlike a number given while reading, it is the same whenever, and however split, the files are read."""
    return df.withColumn(ROW, F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, an action's shuffle files go when it ends. Else they stay until the driver happens to collect its garbage,
    and a cycle of many actions holds the shuffles of all. A frame that is run again makes them anew."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
