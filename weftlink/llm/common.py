"""Session helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SEPARATOR = r"[\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir). Where it is unset, a temporary one in local mode, as in tests; an error on a cluster."""
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if context.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="weftlink-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new path under the shared root. Nothing is created."""
    return f"{shared_root(spark)}/{tag}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def cut(df: DataFrame) -> DataFrame:
    """Compute df once into the shared folder. Later readers, and retries after lost executors, reread those files."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=True)


def written(df: DataFrame, path: str) -> DataFrame:
    """df written to a path under the shared root, and read from there."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the actions inside the block only."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def doc_hash(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo modulus; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % modulus


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def own_columns(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


#: Rows that a broadcast side may have; counted before it is used.
FEW = 100_000
#: Parts into which a side is dealt that meets one that is too long to broadcast.
SALTS = 16


def packed(df: DataFrame, **more: Column) -> DataFrame:
    """df as one struct column, row, beside the columns given: whatever df's columns are called, nothing clashes. unpacked undoes it."""
    return df.select(F.struct(*own_columns(df)).alias("row"), *[c.alias(n) for n, c in more.items()])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def settled(df: DataFrame, *names: str) -> DataFrame:
    """df whose columns ``names`` are computed once a row: later filters aren't pushed below them, where they would hold every expression anew."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*kept, F.inline(F.array(F.struct(*names))))


def beside(rows: DataFrame, side: DataFrame, count: int, key: str, spread: Column) -> DataFrame:
    """rows joined to side, which has one row per key (count of them): broadcast if it is short, else with the rows of a key dealt over SALTS tasks by spread."""
    if count <= FEW:
        return rows.join(F.broadcast(side), key)
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("__salt")
    return rows.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("long")).join(side.select("*", salts), [key, "__salt"]).drop("__salt")
