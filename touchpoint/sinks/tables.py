"""Table sinks: upserts, appends, replacements, ledgers, dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from touchpoint.operators.keys import latest_per_key
from touchpoint.operators.validate import check, speaker_rules, strict
from touchpoint.paths import exists
from touchpoint.session import scratch_path


#: Column that cuts an upserted table into partitions by key.
BUCKET = "key_bucket"


def upsert_rows(rows: DataFrame, path: str, key: str, order: Sequence[Column], buckets: int = 16) -> None:
    """Insert or replace rows of a parquet table by key; of equal keys in ``rows`` the first in ``order`` counts.

    The table is partitioned by a hash of the key. Only the partitions that the rows fall into are read, merged and
    overwritten, all in one job that replaces them when it commits. Repeating it gives the same table; one writer at a time.
    ``buckets`` must stay the same for a table; every task writes a file for each, so a small table should have few.
    """
    spark = rows.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    newest = latest_per_key(rows.where(F.col(key).isNotNull()), [key], order).withColumn(BUCKET, bucket)
    if exists(spark, path):
        new = stored_once(newest, "upsert")
        touched = [r[BUCKET] for r in new.select(BUCKET).distinct().collect()]
        current = spark.read.schema(new.schema).parquet(path).where(F.col(BUCKET).isin(touched))
        newest = current.join(new.select(key), key, "left_anti").unionByName(new)
    newest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """Current rows of a table written by ``upsert_rows``; one per key."""
    return spark.read.parquet(path).drop(BUCKET)


def stored_once(df: DataFrame, name: str) -> DataFrame:
    """The frame, written below the shared scratch folder and read back, so that its several readers compute it once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a table, creating it when absent; all of them or none."""
    df.write.mode("append").parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    df.write.jdbc(url, table, mode="append", properties=options)


def replace_table(df: DataFrame, path: str) -> None:
    """Drop, recreate, load."""
    df.write.mode("overwrite").parquet(path)


class Ledger:
    """Set of processed ids. Adding writes only the ids that are new."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path, key

    def read(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], f"{self.key} string")
        return self.spark.read.schema(f"{self.key} string").parquet(self.path)

    def add(self, ids: DataFrame) -> None:
        new = ids.select(F.col(self.key).cast("string").alias(self.key)).where(F.col(self.key).isNotNull()).distinct()
        new.join(self.read(), self.key, "left_anti").write.mode("append").parquet(self.path)

    def export(self) -> DataFrame:
        """The ids in order."""
        return self.read().distinct().orderBy(self.key)


def publish_speakers(speakers: DataFrame, path: str) -> None:
    """Replace the speaker dimension that later runs use; an invalid speaker fails the job."""
    replace_table(strict(check(speakers, speaker_rules())), path)
