"""Call events → transcript messages, flat rows; text exports → call events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpoint.functions.calls import recording_id
from touchpoint.functions.names import call_name
from touchpoint.operators.exports import export_events, parse_exports
from touchpoint.operators.flatten import explode_lists, flatten_structs, keyed_rows
from touchpoint.operators.project import warehouse_rows
from touchpoint.operators.transcripts import transcript_messages
from touchpoint.operators.validate import REASON, Checked, check
from touchpoint.schemas import CALL_EVENT, CALL_TABLE, MESSAGE_TABLE
from touchpoint.sinks.files import raw_objects, write_keyed_json
from touchpoint.sinks.outcomes import REJECTED, VALID, report_frame, settle_flagged
from touchpoint.sources.files import REFUSED, flag_json, parse_json, read_exports, read_speakers


REQUIRED = ("id", "recording", "meeting", "fathom_user", "transcript")


def read_events(payloads: DataFrame, payload: str) -> Checked:
    """Posted call events given as JSON text."""
    return parse_json(payloads.select(payload), payload, CALL_EVENT, REQUIRED)


def transcripts_of(events: DataFrame) -> DataFrame:
    """The columns of a call event that its messages need."""
    return events.select(
        F.col("recording.url").alias("url"),
        F.col("meeting.title").alias("title"),
        F.col("meeting.scheduled_start_time").alias("date"),
        F.col("transcript.plaintext").alias("plaintext"),
    )


def messages(events: DataFrame, speakers: DataFrame, position: str) -> Checked:
    """Attributed messages of call events, as warehouse rows."""
    checked = transcript_messages(transcripts_of(events), speakers, position)
    return checked.then(lambda valid: warehouse_rows(valid, MESSAGE_TABLE))


def flat_rows(events: DataFrame) -> Checked:
    """One warehouse row per domain and invitee of a call; calls without a recording id are refused."""
    checked = check(
        events.withColumn("_recording", recording_id(F.col("recording.url"))),
        [(F.col("_recording").isNotNull(), "no recording id in url")],
    )
    def flatten(valid: DataFrame) -> DataFrame:
        flat = flatten_structs(valid.drop("id"))
        numbered = explode_lists(flat, ["meeting_external_domains", "meeting_invitees"], "_number")
        rows = keyed_rows(flatten_structs(numbered), F.col("_recording"), "_number")
        return warehouse_rows(rows, CALL_TABLE)

    return checked.then(flatten)


def named_messages(rows: DataFrame) -> DataFrame:
    """Messages with the name of their call's object."""
    return rows.withColumn("file_name", call_name(F.col("date"), F.col("recording_id"), F.col("title")))


def named_flat_rows(rows: DataFrame) -> DataFrame:
    start = F.col("meeting_scheduled_start_time")
    return rows.withColumn("file_name", call_name(start, F.col("recording_id"), F.col("meeting_title")))


def exported_events(spark: SparkSession, folder: str, as_of: str, origin: str, email: str, team: str) -> Checked:
    parsed = parse_exports(read_exports(spark, folder), as_of)
    return parsed.then(lambda valid: export_events(valid, origin, email, team))


def run_messages(events: DataFrame, speakers: DataFrame, position: str, out: str) -> None:
    built = messages(events, speakers, position)
    write_keyed_json(named_messages(built.valid), f"{out}/messages")
    built.rejects.write.mode("overwrite").json(f"{out}/rejects")


def run_posted_messages(spark: SparkSession, payloads: DataFrame, payload: str, speakers: str, out: str) -> dict[str, int]:
    """Posted call events (JSON text) and the speaker file → messages, rejects and the run's counts.

    The payloads are parsed once; a payload that is no call event is a reject with its text, a call that cannot be cut into
    messages one with its url. An empty speaker file fails the job.
    """
    people = read_speakers(spark, speakers)
    settled = settle_flagged(flag_json(payloads.select(payload), payload, CALL_EVENT, REQUIRED), "call-events")
    built = messages(settled.of(VALID), people, "idx")
    write_keyed_json(named_messages(built.valid), f"{out}/messages")
    unread = settled.of(REJECTED).select(F.col(REFUSED).alias("text"), REASON)
    rejects = unread.unionByName(built.rejects.select("row_key", "url", REASON), allowMissingColumns=True)
    rejects.write.mode("overwrite").json(f"{out}/rejects")
    report_frame(payloads, settled.counts).write.mode("overwrite").json(f"{out}/report")
    return settled.counts


def run_flat(events: DataFrame, out: str) -> None:
    built = flat_rows(events)
    write_keyed_json(named_flat_rows(built.valid), f"{out}/calls")
    built.rejects.select("row_key", "reject_reason").write.mode("overwrite").json(f"{out}/rejects")


def run_import(spark: SparkSession, folder: str, out: str, as_of: str, origin: str, email: str, team: str) -> None:
    built = exported_events(spark, folder, as_of, origin, email, team)
    payloads = built.valid.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("payload"))
    raw_objects(payloads).write.mode("overwrite").json(f"{out}/raw")
    built.rejects.select("path", "reject_reason").write.mode("overwrite").json(f"{out}/rejects")
