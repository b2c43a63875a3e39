"""Streams that replace one-event-per-call endpoints.

Every batch writes below its own number and replaces what a failed attempt left there, so a
restarted stream gives the same tables. File order is not name order: "newest" is always decided by
a column, never by arrival.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from touchpoint.datasets import Dataset
from touchpoint.operators.enrich import Embedder
from touchpoint.operators.joins import resolve_names
from touchpoint.operators.validate import REASON, flag_first
from touchpoint.paths import exists
from touchpoint.plans.records import embed_upsert
from touchpoint.schemas import struct_type
from touchpoint.sinks.outcomes import report_frame

UNPARSED = "not a document of this schema"


def event_stream(spark: SparkSession, landing: str, schema: str, max_files: int = 1000, text: str | None = None) -> DataFrame:
    """Events of a landing folder, parsed; a line that does not parse has nulls only, and its text in the column ``text``."""
    fields = struct_type(schema).fields + ([StructField(text, StringType(), True)] if text else [])
    reader = spark.readStream.schema(StructType(fields)).option("maxFilesPerTrigger", max_files)
    return (reader.option("columnNameOfCorruptRecord", text) if text else reader).json(landing)


def payload_stream(spark: SparkSession, landing: str, max_files: int = 1000) -> DataFrame:
    """Unparsed lines of a landing folder."""
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(landing)


def _start(writer: DataStreamWriter, checkpoint: str, drain: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer).start()


def land_raw(payloads: DataFrame, path: str, checkpoint: str, drain: bool = False, replays_within: str = "7 days") -> StreamingQuery:
    """Store every payload untouched with a key made from its content, each content once.

    The stream remembers the keys of the last ``replays_within``, counted from when a payload was taken in, so no payload comes
    late and none is lost; a replay after that time is stored again. The state has one key per content and is
    spread over the partitions of the key.
    """
    keyed = payloads.select(F.sha2("value", 256).alias("object_key"), F.col("value").alias("payload"), F.current_timestamp().alias("taken_at"))
    fresh = keyed.withWatermark("taken_at", replays_within).dropDuplicatesWithinWatermark(["object_key"])
    return _start(fresh.drop("taken_at").writeStream.format("parquet").option("path", path), checkpoint, drain)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads; the stream has removed replays, so nothing is shuffled here."""
    return spark.read.schema("object_key string, payload string").parquet(path)


def land_events(
    events: DataFrame,
    flag: Callable[[DataFrame], DataFrame],
    transform: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    drain: bool = False,
    text: str | None = None,
) -> StreamingQuery:
    """Validate and transform events; accepted ones below ``valid``, the others, with reason, below ``rejected``.

    ``flag`` adds the reject reason, ``transform`` the columns to store; both work row by row, so one
    pass over the batch writes both outputs. ``text`` is the column in which ``event_stream`` keeps lines that do not parse;
    they are rejects with their text.
    """
    def write(batch: DataFrame, number: int) -> None:
        status = F.when(F.col(REASON).isNull(), "valid").otherwise("rejected")
        rows = transform(flag(_unparsed(batch, text))).withColumn("status", status)
        rows.write.mode("overwrite").partitionBy("status").parquet(f"{path}/batch={number}")

    return _start(events.writeStream.foreachBatch(write), checkpoint, drain)


def read_landed(spark: SparkSession, path: str, status: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("status") == status).drop("status", "batch")


def _unparsed(batch: DataFrame, text: str | None) -> DataFrame:
    return flag_first(batch, F.when(F.col(text).isNotNull(), UNPARSED)) if text else batch


def land_embeddings(
    events: DataFrame,
    dataset: Dataset,
    path: str,
    log: str,
    embedder: Embedder,
    checkpoint: str,
    batch_size: int = 35,
    drain: bool = False,
    text: str | None = None,
) -> StreamingQuery:
    """Validate, drop blank texts and stored keys, embed, append to the table at ``path``; with rejects and counts of every batch.

    ``log`` is this stream's own folder: refused events (lines that do not parse with their text) go to ``<log>/rejects``, refused
    texts to ``<log>/failed`` and the counts to ``<log>/report``, each under the number of the batch. The report is written
    last: a batch that has one is done and is passed over when it is repeated; one without is done again, and finds its rows stored.
    """
    def write(batch: DataFrame, number: int) -> None:
        report = f"{log}/report/batch={number}"
        if exists(batch.sparkSession, report):
            return
        run = embed_upsert(_unparsed(batch, text), dataset, path, embedder, batch_size)
        for name, rows in (("rejects", run.rejects), ("failed", run.failed)):
            rows.write.mode("overwrite").parquet(f"{log}/{name}/batch={number}")
        report_frame(batch, run.report).write.mode("overwrite").parquet(report)

    return _start(events.writeStream.foreachBatch(write), checkpoint, drain)


def land_resolved(
    events: DataFrame,
    name: str,
    speakers: Callable[[SparkSession], DataFrame],
    position: str,
    path: str,
    checkpoint: str,
    drain: bool = False,
) -> StreamingQuery:
    """Add the speaker's mail address to events; the dimension is read again for every batch."""
    def write(batch: DataFrame, number: int) -> None:
        resolved = resolve_names(batch, name, speakers(batch.sparkSession), position, "speaker")
        resolved.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _start(events.writeStream.foreachBatch(write), checkpoint, drain)
