"""Recorded calls: recording ids, transcript lines, export headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchpoint.functions.text import strip

# The line shapes of a transcript and of an export.
HEADER_PATTERN = r"(?Ud)^([0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?)\s+-\s+(.+?)(?:\s+\(([^)]+)\))?$"
WATCH_PATTERN = r"(?Ud)^- WATCH:\s*(https?://[^\s]+)(?:\s+(.*))?"
ACTION_PREFIX = "ACTION ITEM:"
WATCH_PREFIX = "- WATCH:"
RECORDING_MARK = "VIEW RECORDING"
BODY_MARK = "---"
CALL_PATH_PATTERN = r"^/calls/([0-9]+)"
SHARE_PATH_PATTERN = r"^/share/([A-Za-z0-9_-]+)"

_URL_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"


def _found(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def recording_id(url: Column) -> Column:
    """Id at the start of the URL path, after ``/calls/`` or ``/share/``; null without one."""
    path = F.regexp_extract(url, _URL_PATH, 1)
    return F.coalesce(_found(path, CALL_PATH_PATTERN, 1), _found(path, SHARE_PATH_PATTERN, 1))


def offset_seconds(offset: Column) -> Column:
    """``MM:SS`` or ``H:MM:SS`` as whole seconds; null for any other shape."""
    parts = F.split(offset, ":")
    seconds = F.element_at(parts, -1).try_cast("double").try_cast("int")
    minutes = F.get(parts, F.size(parts) - 2).try_cast("int")
    hours = F.when(F.size(parts) == 3, F.get(parts, F.lit(0)).try_cast("int")).otherwise(0)
    return F.when(F.size(parts).isin(2, 3), hours * 3600 + minutes * 60 + seconds)


def is_header(line: Column) -> Column:
    return line.rlike(HEADER_PATTERN)


def header_offset(line: Column) -> Column:
    return _found(line, HEADER_PATTERN, 1)


def header_speaker(line: Column) -> Column:
    return strip(_found(line, HEADER_PATTERN, 2))


def header_group(line: Column) -> Column:
    """The text in brackets after the name. Parsed, but no output uses it."""
    return _found(line, HEADER_PATTERN, 3)


def header_parts(line: Column) -> Column:
    """Offset, speaker and group of a header in one pass over the line; null fields for other lines."""
    mark = "\u0001"
    marked = F.regexp_replace(line, HEADER_PATTERN, f"$1{mark}$2{mark}$3")
    parts = F.when((marked != line) & ~line.contains(mark), F.split(marked, mark))
    field = lambda i: F.nullif(F.get(parts, F.lit(i)), F.lit(""))
    return F.struct(field(0).alias("offset"), strip(field(1)).alias("speaker"), field(2).alias("group"))


def is_action(line: Column) -> Column:
    return line.startswith(ACTION_PREFIX)


def action_item(line: Column) -> Column:
    return F.when(is_action(line), strip(F.substring(line, len(ACTION_PREFIX) + 1, 2**31 - 1)))


def is_watch(line: Column) -> Column:
    return line.startswith(WATCH_PREFIX)


def watch_link(line: Column) -> Column:
    return _found(line, WATCH_PATTERN, 1)


def watch_text(line: Column) -> Column:
    return F.nullif(strip(F.regexp_extract(line, WATCH_PATTERN, 2)), F.lit(""))


def is_bad_watch(line: Column) -> Column:
    return is_watch(line) & ~line.rlike(WATCH_PATTERN)


def spoken_text(line: Column) -> Column:
    """The part of a content line that belongs to the message; null when it adds nothing."""
    return F.when(is_action(line), F.lit(None)).when(is_watch(line), watch_text(line)).otherwise(line)


def message_key(recording: Column, number: Column) -> Column:
    """``<recording>-00001``; numbers above 99999 keep all their digits."""
    return F.format_string("%s-%05d", recording, number)


def transcript_lines(plaintext: Column) -> Column:
    """Stripped, non-blank lines of a transcript."""
    return F.filter(F.transform(F.split(plaintext, "\n"), strip), lambda line: line != "")


def export_title(first_line: Column) -> Column:
    """Text before the last `` - `` of an export's first line."""
    return _found(first_line, r"(?s)^(.*) - (.*)$", 1)


def export_month_day(first_line: Column) -> Column:
    return F.regexp_replace(strip(_found(first_line, r"(?s)^(.*) - (.*)$", 2)), r"\s+", " ")


def export_marker(lines: Column) -> Column:
    """The recording line, looked for in the first five lines only."""
    return F.get(F.filter(F.slice(lines, 1, 5), lambda line: line.contains(RECORDING_MARK)), F.lit(0))


def export_url(marker: Column) -> Column:
    """Text after the last colon; the scheme cut off by that colon is put back."""
    tail = strip(F.substring_index(marker, ":", -1))
    url = F.when(tail.startswith("//"), F.concat(F.lit("https:"), tail)).otherwise(tail)
    return F.when(marker.contains(":"), url)


def export_minutes(marker: Column) -> Column:
    """Number after the first dash, 0 when it cannot be read."""
    after_dash = strip(F.get(F.split(F.substring_index(marker, ":", 1), "-"), F.lit(1)))
    number = F.get(F.split(after_dash, r"\s+"), F.lit(0)).try_cast("double")
    return F.coalesce(number, F.lit(0.0))


def lines_after_mark(lines: Column) -> Column:
    """Lines after the first one that equals the body mark; all lines without one."""
    marks = F.array_position(F.transform(lines, strip), BODY_MARK)
    return F.slice(lines, marks.cast("int") + 1, F.size(lines))


def transcript_body(text: Column) -> Column:
    """Text after the first line that contains the body mark, without the blank lines that follow it.

    Without the mark the whole text is returned; nothing after the mark gives an empty string.
    """
    lines = F.split(text, "\n")
    mark = F.array_position(F.transform(lines, lambda line: line.contains(BODY_MARK)), True).cast("int")
    rest = F.slice(lines, mark + 1, F.size(lines))
    start = F.array_position(F.transform(rest, lambda line: strip(line) != ""), True).cast("int")
    body = F.when(start > 0, F.array_join(F.slice(rest, start, F.size(rest)), "\n")).otherwise("")
    return F.when(mark > 0, body).otherwise(text)
