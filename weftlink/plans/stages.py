"""Stage boundaries of the linkage job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster shares, spark.checkpoint.dir. Where that is unset, a temporary one in local mode, as in tests; an error on a cluster."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="weftlink-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path under the shared folder. Nothing is created."""
    return f"{shared_root(spark)}/{tag}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def kept(df: DataFrame) -> DataFrame:
    """df computed once into the shared folder, so later steps and retries after lost executors reread it."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
