from datetime import date, datetime

from pyspark.sql import functions as F

from touchpoint.functions import dates


def test_stamp(evaluate):
    assert evaluate(dates.stamp, [datetime(2024, 3, 5, 8, 7, 9)], "timestamp") == ["2024_03_05_08_07_09"]


def test_iso(evaluate):
    values = [datetime(2024, 1, 15, 10, 30, 45), datetime(2024, 1, 15, 10, 30, 45, 5), None]
    assert evaluate(dates.iso, values, "timestamp") == [
        "2024-01-15T10:30:45+00:00", "2024-01-15T10:30:45.000005+00:00", None,
    ]


def test_event_timestamp(evaluate):
    cases = {
        "Mon Jan 15 2024 10:30:00 GMT+0000": datetime(2024, 1, 15, 10, 30),
        "Mon Jan 15 2024 10:30:00 GMT+0200": datetime(2024, 1, 15, 8, 30),
        "2024-01-15T10:30:00+00:00": datetime(2024, 1, 15, 10, 30),
        "2024-01-15T10:30:00Z": datetime(2024, 1, 15, 10, 30),
        "2024-01-15": datetime(2024, 1, 15),
        "2024": None,
        "": None,
        "   ": None,
        "not-a-date": None,
        "Jan 15 2024 10:30:00 GMT+0000": None,
    }
    assert evaluate(dates.event_timestamp, cases) == list(cases.values())


def test_filename_date(evaluate):
    now = datetime(2030, 1, 1)
    cases = {
        "2025-11-11-statsig_experimentation": datetime(2025, 11, 11),
        "20251111-conference": datetime(2025, 11, 11),
        "2024-03-15-multi-part-source-name": datetime(2024, 3, 15),
        "2024-13-45-x": now,
        "20240115-a-b-c": datetime(2024, 1, 15),
        "conference": now,
        "20251111": now,
        "some-event": now,
    }
    assert evaluate(lambda v: dates.filename_date(v, F.lit(now)), cases) == list(cases.values())


def test_contact_date(evaluate):
    cases = {
        "15 Jan 2024": datetime(2024, 1, 15), "5 Mar 2023": datetime(2023, 3, 5), "29 Feb 2024": datetime(2024, 2, 29),
        "29 Feb 2023": None, "2024-01-15": None, "Jan 15 2024": None, "15/01/2024": None, "": None, "32 Jan 2024": None,
    }
    assert evaluate(dates.contact_date, cases) == list(cases.values())


def test_age(evaluate):
    def at(day):
        return lambda v: dates.age(v, F.lit(day).cast("date"))

    births = [date(2000, 2, 29), date(2000, 3, 1), date(2000, 2, 28)]
    assert evaluate(at("2023-02-28"), births, "date") == [22, 22, 23]


def test_restamp_and_weekday(evaluate):
    at = [datetime(2023, 7, 3, 23, 59, 59, 7)]
    assert evaluate(lambda v: dates.restamp(v, F.lit("2024-03-04")), at, "timestamp") == [
        datetime(2024, 3, 4, 23, 59, 59, 7)
    ]
    sunday_to_monday = [datetime(2024, 3, 3), datetime(2024, 3, 4)]
    assert evaluate(lambda v: dates.same_weekday(v, F.lit("2023-07-03").cast("date")), sunday_to_monday, "timestamp") == [False, True]


def test_export_year(evaluate):
    def found(as_of, values):
        return evaluate(lambda v: dates.export_date(v, F.lit(as_of).cast("timestamp")), values)

    assert found("2026-02-03", ["April 1", "December 1", "August 2", "August 3"]) == [
        datetime(2025, 4, 1), datetime(2026, 12, 1), datetime(2025, 8, 2), datetime(2026, 8, 3),
    ]
    assert found("2025-06-01", ["January 15", "July 4", "June 1"]) == [
        datetime(2025, 1, 15), datetime(2024, 7, 4), datetime(2025, 6, 1),
    ]
    assert found("2024-06-01", ["December 1", "nothing", "February 30"]) == [datetime(2024, 12, 1), None, None]
