"""Transcripts: text → lines → attributed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpoint.functions import calls
from touchpoint.functions.text import organization, row_identifier
from touchpoint.operators.joins import resolve_names
from touchpoint.operators.keys import running_total
from touchpoint.operators.validate import REASON, Checked, with_reason

NO_SPEAKER = "content before the first speaker"
BAD_WATCH = "invalid watch link"
BAD_URL = "no recording id in url"


def with_lines(calls_df: DataFrame) -> DataFrame:
    """Add the recording id, the transcript's ``lines`` and the positions of the header lines.

    ``lines`` and ``heads`` are columns of their own so that the expressions that follow refer to
    them instead of splitting the text again for every line.
    """
    return (
        calls_df.withColumn("recording_id", calls.recording_id(F.col("url")))
        .withColumn("lines", calls.transcript_lines(F.col("plaintext")))
        .withColumn(
            "heads",
            F.filter(
                F.transform("lines", lambda line, i: F.when(calls.is_header(line), i)), lambda i: i.isNotNull()
            ),
        )
    )


def call_lines(calls_df: DataFrame, call: str) -> DataFrame:
    """Line table of calls: (call, n from 0, line), blank lines left out.

    The split itself is exploded. From an exploded column Spark would infer a filter on its size and
    split every transcript once more for it.
    """
    return calls_df.select(call, F.posexplode(calls.transcript_lines(F.col("plaintext"))).alias("n", "line"))


def flag_transcripts(lined: DataFrame) -> DataFrame:
    """Calls without a recording id, with text before the first speaker or with a broken watch line are refused."""
    return with_reason(
        lined,
        [
            (F.col("recording_id").isNotNull(), BAD_URL),
            ((F.size("lines") == 0) | (F.get("heads", F.lit(0)) == 0), NO_SPEAKER),
            (~F.exists("lines", calls.is_bad_watch), BAD_WATCH),
        ],
    )


def explode_messages(flagged: DataFrame) -> DataFrame:
    """One row per message of the accepted calls: the header line and the content lines up to the next header.

    A transcript is one value of one row, so it is cut inside the row: no shuffle, no window. A
    refused call explodes to nothing instead of being filtered out: Spark would move the filter
    below the projections and split every transcript again just to decide on it.
    """
    def until_next(head: Column, k: Column) -> Column:
        end = F.coalesce(F.get("heads", k + 1), F.size("lines"))
        return F.struct(
            (k + 1).alias("message_id"),
            F.get("lines", head).alias("header"),
            F.slice("lines", head + 2, end - head - 1).alias("content"),
        )

    kept = [c for c in flagged.columns if c not in ("lines", "heads", "plaintext", REASON)]
    accepted = F.when(F.col(REASON).isNull(), F.transform("heads", until_next))
    return flagged.select(*kept, F.inline(accepted))


def message_fields(content: Column) -> dict[str, Column]:
    """Text, action item and watch link of a message from its ordered content lines.

    The text is all spoken parts joined by a blank; of several action items or links the last counts.
    """
    spoken = F.filter(F.transform(content, calls.spoken_text), lambda part: part.isNotNull())
    return {
        "message": F.array_join(spoken, " "),
        "action_item": calls.action_item(F.try_element_at(F.filter(content, calls.is_action), F.lit(-1))),
        "watch_link": calls.watch_link(F.try_element_at(F.filter(content, calls.is_watch), F.lit(-1))),
    }


def attributed(messages: DataFrame, speakers: DataFrame, position: str) -> DataFrame:
    """Add offset, speaker, organisation and message key from the header line."""
    named = messages.withColumn("speaker_name", calls.header_speaker(F.col("header")))
    resolved = resolve_names(named, "speaker_name", speakers, position, "speaker")
    return resolved.select(
        "*",
        calls.offset_seconds(calls.header_offset(F.col("header"))).alias("timestamp"),
        organization(F.col("speaker")).alias("organization"),
        calls.message_key(F.col("recording_id"), F.col("message_id")).alias("id"),
    ).drop("speaker_name", "header")


def transcript_messages(calls_df: DataFrame, speakers: DataFrame, position: str) -> Checked:
    """Messages of calls given as (url, title, date, plaintext), and the refused calls."""
    flagged = flag_transcripts(with_lines(calls_df))
    columns = [
        "id", "recording_id", "message_id", "url", "title", "date", "timestamp", "speaker", "organization",
        "message", "action_item", "watch_link",
    ]

    def messages() -> DataFrame:
        cut = explode_messages(flagged).withColumns(message_fields(F.col("content")))
        return attributed(cut.drop("content"), speakers, position).select(*columns)

    def rejects() -> DataFrame:
        kept = [c for c in flagged.columns if c not in ("lines", "heads", "plaintext", REASON)]
        reason = F.explode(F.when(F.col(REASON).isNotNull(), F.array(REASON))).alias(REASON)
        return flagged.select(row_identifier(kept).alias("row_key"), *kept, reason)

    return Checked(messages, rejects)


def number_messages(lines: DataFrame, call: str, order: list[str]) -> DataFrame:
    """Message number of every line of a *line table*: header lines open a message.

    For calls that arrive as many rows, where one call may hold a large part of the table. Lines
    before the first header get number 0.
    """
    opens = F.when(calls.is_header(F.col("line")), 1).otherwise(0)
    return running_total(lines, [call], order, opens, "message_id")


def assemble_messages(numbered: DataFrame, call: str, order: list[str]) -> DataFrame:
    """One row per message of a numbered line table.

    Each output text is one value, so the lines of one message, never those of a whole call, meet.
    """
    content = ~calls.is_header(F.col("line"))
    place = F.struct(*order)
    spoken = F.struct(*order, calls.spoken_text(F.col("line")).alias("part"))
    keeps = content & calls.spoken_text(F.col("line")).isNotNull()
    return (
        numbered.groupBy(call, "message_id")
        .agg(
            F.max(F.when(~content, F.col("line"))).alias("header"),
            F.sort_array(F.collect_list(F.when(keeps, spoken))).alias("_parts"),
            F.max_by(calls.action_item(F.col("line")), F.when(content & calls.is_action(F.col("line")), place)).alias(
                "action_item"
            ),
            F.max_by(calls.watch_link(F.col("line")), F.when(content & calls.is_watch(F.col("line")), place)).alias(
                "watch_link"
            ),
        )
        .withColumn("message", F.array_join(F.col("_parts.part"), " "))
        .drop("_parts")
    )
