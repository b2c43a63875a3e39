"""Call exports (one text file per call) → call events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpoint.functions import calls, dates
from touchpoint.operators.keys import running_total
from touchpoint.operators.validate import Checked, check


def parse_exports(files: DataFrame, as_of) -> Checked:
    """Header fields and transcript body of export files given as (path, value).

    Files without text are skipped; files whose url, date or title cannot be read are refused.
    ``as_of`` is the day from which the missing year is inferred.
    """
    lined = files.where(F.col("value") != "").withColumn("lines", F.split("value", "\n"))
    first = F.get("lines", F.lit(0))
    marker = calls.export_marker(F.col("lines"))
    parsed = lined.select(
        "path",
        calls.export_title(first).alias("title"),
        dates.export_date(calls.export_month_day(first), F.lit(as_of).cast("timestamp")).alias("date"),
        F.coalesce(F.when(marker.contains(":"), calls.export_minutes(marker)), F.lit(0.0)).alias("duration_minutes"),
        calls.export_url(marker).alias("url"),
        calls.transcript_body(F.col("value")).alias("full_text"),
        calls.lines_after_mark(F.col("lines")).alias("content"),
    )
    return check(
        parsed,
        [
            (F.col("url").isNotNull(), "URL is None"),
            (F.col("date").isNotNull(), "Date is None"),
            (F.col("title").isNotNull(), "Title is None"),
        ],
    )


def running_ids(df: DataFrame, key: str, name: str) -> DataFrame:
    """Gap-free ids from 0 in the order of a unique key, numbered block by block: no task sorts the whole table."""
    counted = running_total(df.withColumn("_all", F.lit(0)), ["_all"], [key], F.lit(1), "_number")
    return counted.withColumn(name, F.col("_number") - 1).drop("_number", "_all")


def export_events(parsed: DataFrame, origin: str, email: str, team: str) -> DataFrame:
    """Call events of parsed exports; fields an export does not carry are null or the given defaults."""
    numbered = running_ids(parsed, "path", "id")
    nothing = F.lit(None)
    return numbered.select(
        "id",
        F.struct(F.col("url"), F.col("duration_minutes").alias("duration_in_minutes")).alias("recording"),
        F.struct(
            F.col("date").alias("scheduled_start_time"),
            nothing.cast("timestamp").alias("scheduled_end_time"),
            nothing.cast("int").alias("scheduled_duration_in_minutes"),
            F.lit(origin).alias("join_url"),
            F.col("title"),
            nothing.cast("boolean").alias("has_external_invitees"),
            nothing.cast("array<struct<domain_name: string>>").alias("external_domains"),
            nothing.cast("array<struct<name: string, email: string, is_external: boolean>>").alias("invitees"),
        ).alias("meeting"),
        F.struct(F.lit(origin).alias("name"), F.lit(email).alias("email"), F.lit(team).alias("team")).alias(
            "fathom_user"
        ),
        F.struct(F.col("full_text").alias("plaintext")).alias("transcript"),
    )
