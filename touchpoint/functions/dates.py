"""Date and time parsing and printing. Everything is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date formats of the inputs and of the file names.
STAMP_FORMAT = "yyyy_MM_dd_HH_mm_ss"
DAY_FORMAT = "yyyyMMdd"
DAY_SECOND_FORMAT = "yyyyMMdd-HHmmss"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
CONTACT_FORMAT = "d MMM yyyy"
MENTION_FORMAT = "MMM d yyyy HH:mm:ss 'GMT'xx"
EXPORT_FORMAT = "MMMM d yyyy"

# Years used to date exports that carry no year.
FIRST_YEAR = 2024
TRANSITION_YEAR = 2025
FUTURE_YEAR = 2026
FAR_FUTURE_DAYS = 180

_WEEKDAY = r"(?i)^(?:mon|tue|wed|thu|fri|sat|sun)\s+"


def stamp(at: Column) -> Column:
    return F.date_format(at, STAMP_FORMAT)


def iso(at: Column) -> Column:
    """ISO-8601 with a numeric zone; the fraction is printed only when there is one."""
    micros = F.date_format(at, "SSSSSS")
    fraction = F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise("")
    return F.concat(F.date_format(at, ISO_FORMAT), fraction, F.date_format(at, "xxx"))


def event_timestamp(text: Column) -> Column:
    """``Mon Jan 15 2024 10:30:00 GMT+0000`` or ISO-8601; null when neither fits."""
    spaced = F.regexp_replace(text, r"\s+", " ")
    verbose = F.try_to_timestamp(
        F.regexp_replace(F.when(spaced.rlike(_WEEKDAY), spaced), _WEEKDAY, ""), F.lit(MENTION_FORMAT)
    )
    standard = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}|$)"), text).try_cast("timestamp")
    return F.coalesce(verbose, standard)


def filename_date(stem: Column, as_of: Column) -> Column:
    """Date at the start of a file stem: ``Y-m-d-…`` with four or more parts, else ``Ymd-…``.

    A stem without a date gets ``as_of``, a job parameter, so that a rerun gives the same result.
    """
    parts = F.split(stem, "-")
    first = F.get(parts, F.lit(0))
    dashed = F.concat_ws("-", F.slice(parts, 1, 3))
    dashed_date = F.when(
        (F.size(parts) >= 4) & dashed.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"),
        F.try_to_timestamp(dashed, F.lit("yyyy-M-d")),
    )
    compact_date = F.when(
        (F.size(parts) >= 2) & first.rlike(r"^\d{8}$"), F.try_to_timestamp(first, F.lit(DAY_FORMAT))
    )
    return F.coalesce(dashed_date, compact_date, as_of)


def contact_date(text: Column) -> Column:
    """``15 Jan 2024`` as a timestamp; null when it is no such date."""
    spaced = F.regexp_replace(text, r"\s+", " ")
    return F.try_to_timestamp(
        F.when(spaced.rlike(r"^\d{1,2} [A-Za-z]{3} \d{4}$"), spaced), F.lit(CONTACT_FORMAT)
    )


def age(birth: Column, today: Column) -> Column:
    """Full years at ``today``."""
    birthday_ahead = F.date_format(today, "MMdd") < F.date_format(birth, "MMdd")
    return F.year(today) - F.year(birth) - birthday_ahead.cast("int")


def restamp(at: Column, target: Column) -> Column:
    """The time of day of ``at`` on the day of ``target``."""
    return F.date_trunc("day", target.cast("timestamp")) + (at - F.date_trunc("day", at))


def same_weekday(at: Column, target: Column) -> Column:
    return F.dayofweek(at) == F.dayofweek(target)


def export_date(month_day: Column, as_of: Column) -> Column:
    """Date of an export whose header has only ``January 15``.

    In the transition year a date after ``as_of`` is last year's. From the future year on it is the
    transition year's, unless this year's date lies more than ``FAR_FUTURE_DAYS`` ahead. Before
    that, it is this year's. A 29 February that the chosen year lacks gives null.
    """
    def dated(year: Column) -> Column:
        return F.try_to_timestamp(F.concat_ws(" ", month_day, year.cast("string")), F.lit(EXPORT_FORMAT))

    this_year = F.year(as_of)
    current = dated(this_year)
    return (
        F.when(
            this_year == TRANSITION_YEAR,
            F.when(current > as_of, dated(F.lit(FIRST_YEAR))).otherwise(dated(F.lit(TRANSITION_YEAR))),
        )
        .when(
            this_year >= FUTURE_YEAR,
            F.when(current > as_of + F.make_dt_interval(F.lit(FAR_FUTURE_DAYS)), current).otherwise(
                dated(F.lit(TRANSITION_YEAR))
            ),
        )
        .otherwise(current)
    )
