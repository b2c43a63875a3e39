"""CSV folder of event attendees → JSON lines, one aggregate CSV, counts per source.

The folder is parsed once: every row is flagged, all rows are written by status, and the outputs are made from that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpoint.functions.dates import filename_date
from touchpoint.functions.names import attendee_name
from touchpoint.operators.keys import counts_by_source
from touchpoint.operators.project import align_schema, with_constants
from touchpoint.operators.validate import REASON, required_rules, with_reason
from touchpoint.schemas import ATTENDEE
from touchpoint.sinks.files import newest_objects, write_csv, write_keyed_json
from touchpoint.sinks.outcomes import REJECTED, VALID, report_frame, settle_flagged
from touchpoint.sources.files import POSITION, file_stem, flag_csv_rows, flag_sidecars, row_numbers, unread_files

REQUIRED = {"source": ("string", True), "event_url": ("string", True), "created_at": ("timestamp", True)}


@dataclass(frozen=True)
class Attendees:
    """``rejects`` has the file, the number of the row in it (null for a whole file) and the reason."""

    aligned: DataFrame
    objects: DataFrame
    counts: DataFrame
    rejects: DataFrame
    report: dict[str, int]


def tagged(rows: DataFrame, as_of: str) -> DataFrame:
    """Source and date from each row's file name, then the standard columns, position and reject reason."""
    stem = file_stem(F.col("_file"))
    created = filename_date(stem, F.lit(as_of).cast("timestamp"))
    constants = {"source": stem, "created_at": created, "event_url": F.col("event_url")}
    place = f"{POSITION} {rows.schema[POSITION].dataType.simpleString()}"
    return align_schema(with_constants(rows, ATTENDEE, constants), f"{ATTENDEE}, {place}, {REASON} string")


def flagged(spark: SparkSession, folder: str, as_of: str) -> DataFrame:
    """Every row of the folder with the first reason against it: its cells, its file's sidecar, its fields."""
    rows = flag_sidecars(flag_csv_rows(spark, folder), spark, folder)
    return with_reason(tagged(rows, as_of), required_rules(REQUIRED, ("event_url",)))


def plan(spark: SparkSession, folder: str, as_of: str) -> Attendees:
    """Parses the folder; the frames read what was stored by then. Of equal object names the later row wins."""
    settled = settle_flagged(flagged(spark, folder, as_of), "attendees")
    valid, rejected = settled.of(VALID).drop(REASON), settled.of(REJECTED)
    named = valid.withColumn("file_name", attendee_name(F.col("source"), F.col("created_at"), F.col("email"), F.col("name")))
    numbered = row_numbers(rejected, settled.rows.select(POSITION), "row_no")
    unread = unread_files(spark, folder, [".csv", ".json"])
    return Attendees(
        valid.drop(POSITION),
        newest_objects(named, [F.desc(POSITION)]).drop(POSITION),
        counts_by_source(valid, "source"),
        numbered.select(F.col(f"{POSITION}.file").alias("row_key"), "row_no", REASON).unionByName(unread, allowMissingColumns=True),
        settled.counts,
    )


def run(spark: SparkSession, folder: str, out: str, as_of: str) -> dict[str, int]:
    """Write objects, aggregate, counts per source, rejects and the run's counts."""
    built = plan(spark, folder, as_of)
    write_keyed_json(built.objects, f"{out}/objects", ["source"])
    write_csv(built.aligned, f"{out}/aggregate")
    built.counts.write.mode("overwrite").json(f"{out}/counts")
    built.rejects.write.mode("overwrite").json(f"{out}/rejects")
    report_frame(built.rejects, built.report).write.mode("overwrite").json(f"{out}/report")
    return built.report
