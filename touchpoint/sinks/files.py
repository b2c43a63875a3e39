"""File sinks: keyed JSON Lines, raw payloads, CSV, single objects, destinations."""

from __future__ import annotations

import os
from collections.abc import Sequence
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpoint.functions.text import BUCKET_SCHEME
from touchpoint.operators.keys import latest_per_key
from touchpoint.paths import exists, qualified, write_object


class Destination(str, Enum):
    """Where a job writes: below the working folder, or to a bucket."""

    LOCAL = "local"
    GCS = "gcs"

    @classmethod
    def parse(cls, value: str) -> Destination:
        try:
            return cls(value)
        except ValueError:
            valid = ", ".join(d.value for d in cls)
            raise ValueError(f"Invalid destination type: '{value}'. Valid values are: {valid}") from None

    def url(self, bucket: str) -> str:
        return f"{BUCKET_SCHEME}{bucket}" if self is Destination.GCS else f"{os.getcwd()}/out/{bucket}"


def is_cloud(url: str | None) -> bool:
    """True for a bucket URL; anything but a string is an error."""
    if not isinstance(url, str):
        raise ValueError(f"Invalid bucket url: {url}")
    return url.startswith(BUCKET_SCHEME)


def newest_objects(df: DataFrame, order: Sequence[Column], name: str = "file_name") -> DataFrame:
    """One row per object name, the newest: a later record overwrites one of the same name."""
    return latest_per_key(df, [name], order)


def write_keyed_json(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Records as JSON Lines with their ``file_name`` as a column.

    Many records share a file: one object per record does not scale. With ``partition_by`` the rows of a folder are brought
    together first, or every task would write a file for every folder; Spark splits a folder with most of the rows over many
    tasks. Use ``export_objects`` for the exact one-object-per-record layout.
    """
    df = df.hint("rebalance", *partition_by) if partition_by else df
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    writer.partitionBy(*partition_by).json(path) if partition_by else writer.json(path)


def export_objects(df: DataFrame, root: str, name: str = "file_name", value: str = "value") -> None:
    """One object per row below ``root``. Opt-in: for small exports.

    A rerun of a task writes the same objects again, so the result does not change. Names that
    would leave the folder fail the job. Tasks write to the file system that Spark resolves ``root`` to.
    """
    root = qualified(df.sparkSession, root)

    def write(rows) -> None:
        for row in rows:
            write_object(root, row[name], row[value].encode())

    df.select(name, value).foreachPartition(write)


def line_objects(rows: DataFrame, key: str = "id", name: str = "file_name") -> DataFrame:
    """JSON Lines content per object, (file_name, value), for ``export_objects``.

    Copies of a line are reduced to one per object and key before the lines of an object, which are
    one record's own, are joined in key order.
    """
    line = F.to_json(F.struct(*[c for c in rows.columns if c != name]), {"ignoreNullFields": "false"})
    lined = latest_per_key(rows.select(name, key, line.alias("_line")), [name, key], [F.desc("_line")])
    listed = lined.groupBy(name).agg(F.sort_array(F.collect_list(F.struct(key, "_line"))).alias("_lines"))
    return listed.select(name, F.array_join("_lines._line", "\n").alias("value"))


def safe_names(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Rows whose object name stays in its folder."""
    parts = F.split(name, "/")
    return df.where((F.col(name) != "") & ~F.col(name).startswith("/") & ~F.array_contains(parts, ".."))


def raw_objects(payloads: DataFrame, value: str = "payload") -> DataFrame:
    """Payloads with a name made from their content, each content once.

    A time-ordered random name would land the same payload again on every replay.
    """
    named = payloads.select(F.sha2(value, 256).alias("object_key"), F.col(value).alias("payload"))
    return named.dropDuplicates(["object_key"])


def append_raw(payloads: DataFrame, path: str, value: str = "payload") -> None:
    """Append the payloads that are not stored yet."""
    new = raw_objects(payloads, value)
    spark = payloads.sparkSession
    if exists(spark, path):
        new = new.join(spark.read.parquet(path).select("object_key"), "object_key", "left_anti")
    new.write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV folder whose part files all have the header, so that it reads back as one table."""
    df.write.mode("overwrite").options(header="true", escape='"').csv(path)
