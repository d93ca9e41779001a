"""Writing an intermediate table once so that later steps read it, not its lineage."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``; it is required."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{folder.rstrip('/')}/signalframe"


def new_folder(spark: SparkSession, label: str = "stage") -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal the rows of a few unsplittable files (zip, gzip, one row group) to ``partitions`` tasks; off by default."""
    return df.repartition(partitions) if partitions else df


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Store a table in the shared folder and return a scan of it.  Runs a job.

    Later steps get column pruning and true sizes, and a lost executor costs a
    re-read of parquet instead of a re-run of everything before.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def expire(spark: SparkSession, hours: float) -> int:
    """Delete staged tables last written more than ``hours`` ago; returns how many.

    Call it from a maintenance job: a table that a running job still reads must
    not be older than that.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return 0
    limit = (time.time() - hours * 3600) * 1000
    old = [s.getPath() for s in fs.listStatus(folder) if s.getModificationTime() < limit]
    for path in old:
        fs.delete(path, True)
    return len(old)
