"""Written intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpoint.session import scratch_path

#: Rows of one or two bigint columns that may be broadcast: at most a few dozen MB in each executor.
BROADCAST_ROWS = 500_000


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table below ``spark.checkpoint.dir`` and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch = path
    return table


#: Whether Spark deletes the shuffle files of a query when it ends, and not when the driver has collected its plan.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame, name: str) -> DataFrame:
    """``written``, and the shuffle files of the write are deleted with its end; one collection by ``release`` often leaves them."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return written(df, name)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that no later step reads; whatever was made from them has to be written by then."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps: it does once the driver has collected the plans that made them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def few_rows(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a written table has at most ``limit`` rows; counted, not guessed."""
    return df.count() <= limit


def broadcast_if_few(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a written table of narrow rows for broadcast if its counted size allows it."""
    return F.broadcast(df) if few_rows(df, limit) else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
