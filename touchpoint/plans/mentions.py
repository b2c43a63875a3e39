"""Mention exports (CSV) → deduplicated mention events."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpoint.functions.dates import event_timestamp
from touchpoint.functions.names import mention_name
from touchpoint.operators.keys import latest_per_key
from touchpoint.operators.joins import stack_frames
from touchpoint.operators.project import (
    align_schema, event_defaults, json_line, mention_defaults, resolve_spellings, spelled_fields,
)
from touchpoint.operators.validate import REASON, Checked, flag_mentions, required_rules, split_checked, with_reason
from touchpoint.schemas import MENTION, MENTION_SPELLINGS, MENTION_TABLE
from touchpoint.sinks.files import newest_objects, write_keyed_json
from touchpoint.sinks.outcomes import REJECTED, VALID, report_frame, settle_flagged
from touchpoint.sources.files import POSITION, flag_csv_rows, parse_json, row_numbers, unread_files

NOT_TIMED = {n: t for n, t in MENTION_TABLE.items() if n not in ("timestamp", "bookmarked")}


def flag_typed(rows: DataFrame) -> DataFrame:
    """Mentions with their fields named, defaulted and timed, and the reason against those that lack a required field.

    Position and earlier reason of a row are kept.
    """
    extra = [c for c in (POSITION, REASON) if c in rows.columns]
    kept = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in extra)
    named = resolve_spellings(rows, {**MENTION_SPELLINGS, **{c: (c,) for c in extra}})
    flag_given = "bookmarked" in named.columns
    readable = "bookmarked IS NULL OR try_cast(bookmarked AS boolean) IS NOT NULL" if flag_given else "true"
    defaulted = mention_defaults(named.withColumn("_readable", F.expr(readable)))
    aligned = align_schema(defaulted, f"{MENTION}, _readable boolean" + (f", {kept}" if kept else ""))
    rules = [
        *required_rules(NOT_TIMED),
        (F.col("timestamp").isNotNull(), "timestamp"),
        (F.col("_readable"), "bookmarked"),
    ]
    return with_reason(aligned.withColumn("timestamp", event_timestamp(F.col("timestamp"))), rules).drop("_readable")


def typed(rows: DataFrame) -> Checked:
    """``flag_typed`` split into mentions and refused rows."""
    return split_checked(flag_typed(rows))


def newest_per_url(mentions: DataFrame) -> DataFrame:
    """One mention per url: the latest, then the one with the smallest source id."""
    return latest_per_key(mentions, ["url"], [F.desc("timestamp"), F.asc("source_id")])


def events(mentions: DataFrame) -> DataFrame:
    """Event, its JSON line and its object name; the position of a mention is kept."""
    place = [c for c in (POSITION,) if c in mentions.columns]
    fields = mentions.drop(*place)
    wrapped = mentions.select(*place, F.lit("mention_created").alias("action"), F.struct(*fields.columns).alias("data"))
    name = mention_name(
        F.col("data.source"), F.col("data.keyword"), F.col("data.timestamp"), F.col("data.author")
    )
    return wrapped.select("*", json_line(wrapped.drop(*place)).alias("value"), name.alias("file_name"))


@dataclass(frozen=True)
class Mentions:
    """``rejects`` has the file, the number of the row in it (null for a whole file) and the reason."""

    objects: DataFrame
    rejects: DataFrame
    report: dict[str, int]


def plan(spark: SparkSession, folder: str, multi_line: bool = True) -> Mentions:
    """Parses the exports once. One mention per url; of equal object names the later row of the exports wins.

    Turn ``multi_line`` off for exports without line breaks inside quotes, so that large files are split.
    """
    settled = settle_flagged(flag_typed(flag_csv_rows(spark, folder, multi_line)), "mentions")
    valid, rejected = settled.of(VALID).drop(REASON), settled.of(REJECTED)
    objects = newest_objects(events(newest_per_url(valid)), [F.desc(POSITION)]).drop(POSITION)
    numbered = row_numbers(rejected, settled.rows.select(POSITION), "row_no")
    rejects = numbered.select(F.col(f"{POSITION}.file").alias("row_key"), "row_no", REASON)
    return Mentions(objects, rejects.unionByName(unread_files(spark, folder, [".csv"]), allowMissingColumns=True), settled.counts)


def from_payloads(payloads: DataFrame, payload: str) -> Checked:
    """Posted mention events (JSON text) → (file_name, value) with the mention as a JSON line.

    Rejects carry the reason: text that is no event, an action that is not taken, a missing field.
    """
    opened = parse_json(payloads.select(payload), payload, "action string, data string", ("data",), raw=("data",))
    taken = opened.then(lambda events: flag_mentions(event_defaults(events)))
    accepted = split_checked(taken.valid)
    read = typed(spelled_fields(accepted.valid.select("data"), "data"))

    def lines() -> DataFrame:
        mentions = read.valid
        name = mention_name(F.col("source"), F.col("keyword"), F.col("timestamp"), F.col("author"))
        return mentions.select(name.alias("file_name"), json_line(mentions).alias("value"), "timestamp")

    def rejects() -> DataFrame:
        return stack_frames([c.rejects.select(REASON) for c in (opened, accepted, read)])

    return Checked(lambda: newest_objects(lines(), [F.desc("timestamp"), F.desc("value")]), rejects)


def run_payloads(payloads: DataFrame, payload: str, out: str) -> None:
    built = from_payloads(payloads, payload)
    write_keyed_json(built.valid, f"{out}/objects")
    built.rejects.write.mode("overwrite").json(f"{out}/rejects")


def run(spark: SparkSession, folder: str, out: str, multi_line: bool = True) -> dict[str, int]:
    """Write objects, rejects and the run's counts."""
    built = plan(spark, folder, multi_line)
    write_keyed_json(built.objects, f"{out}/objects")
    built.rejects.write.mode("overwrite").json(f"{out}/rejects")
    report_frame(built.rejects, built.report).write.mode("overwrite").json(f"{out}/report")
    return built.report
