"""Table sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType, TimestampNTZType, TimestampType

from touchpoint.operators.keys import key_set
from touchpoint.paths import exists


def read_table(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """Parquet table, optionally filtered; comparisons are pushed into the scan.

    Timestamps stored without zone are read as UTC. They are declared so rather than cast, because a
    filter on a cast column would not reach the scan.
    """
    df = spark.read.parquet(path)
    if any(isinstance(f.dataType, TimestampNTZType) for f in df.schema.fields):
        zoned = [
            StructField(f.name, TimestampType() if isinstance(f.dataType, TimestampNTZType) else f.dataType, f.nullable)
            for f in df.schema.fields
        ]
        df = spark.read.schema(StructType(zoned)).parquet(path)
    return df if where is None else df.where(where)


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy work on a scan of few files at least one partition per slot.

    A scan that already has as many partitions as slots, as any large one has, is returned
    unchanged and is not shuffled.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= slots else df.repartition(slots)


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, parts: int, **options: str
) -> DataFrame:
    """Database table, read in ``parts`` ranges of a numeric key; filters and ``max`` are pushed down."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=lower, upperBound=upper, numPartitions=parts,
        properties={"pushDownAggregate": "true", **options},
    )


def read_keys(spark: SparkSession, path: str, key: str, kind: str) -> DataFrame:
    """Distinct keys of a target; none when it does not exist yet. Only the key column is read.

    Any other failure is raised: treating an unreadable target as empty would write everything again.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], f"{key} {kind}")
    return key_set(spark.read.parquet(path), key)
