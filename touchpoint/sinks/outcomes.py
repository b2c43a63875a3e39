"""One write for all outcomes of a job, with their counts.

A job that stores accepted rows, reports refused ones and counts both would read its input once for each. Instead every
row gets its status, all rows are written once, partitioned by status, and the counts are observed during that
write. Later steps read only their own status back.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from touchpoint.operators.validate import REASON
from touchpoint.session import scratch_path

VALID, REJECTED = "valid", "rejected"


@dataclass(frozen=True)
class Settled:
    """Rows by status and how many there are of each."""

    rows: DataFrame
    counts: dict[str, int]

    def of(self, *status: str) -> DataFrame:
        return self.rows.where(F.col("_status").isin(*status)).drop("_status")


def settle(df: DataFrame, statuses: Sequence[str], status: Column, name: str, drop: Sequence[str] = ()) -> Settled:
    """Write all rows once below the shared scratch folder, by status; a status outside ``statuses`` fails the job.

    Columns in ``drop`` serve the status only and are not written.
    The counts belong to the tasks that wrote the rows, so a repeated task does not count twice.
    """
    known = F.when(status.isin(*statuses), status).otherwise(F.raise_error(F.concat(F.lit("unknown status "), F.coalesce(status, F.lit("null")))).cast("string"))
    seen = Observation(name)
    marked = df.withColumn("_status", known).drop(*drop)
    observed = marked.observe(seen, *[F.count_if(F.col("_status") == s).alias(s) for s in statuses])
    path = scratch_path(df.sparkSession, name)
    observed.write.partitionBy("_status").parquet(path)
    counts = {s: seen.get[s] for s in statuses}
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    return Settled(stored, counts)


def settle_flagged(flagged: DataFrame, name: str) -> Settled:
    """Rows with a reject reason are ``rejected``, the others ``valid``."""
    return settle(flagged, (VALID, REJECTED), F.when(F.col(REASON).isNull(), VALID).otherwise(REJECTED), name)


def report_frame(df: DataFrame, counts: dict[str, int]) -> DataFrame:
    """The counts of a run as one row, for storing beside its outputs."""
    names = list(counts)
    return df.sparkSession.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} bigint" for n in names))
