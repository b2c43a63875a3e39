"""Object names of the records. Patterns, separators and endings are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchpoint.functions.dates import DAY_FORMAT, DAY_SECOND_FORMAT, stamp
from touchpoint.functions.text import clean_string, sanitize

ENDING = ".jsonl"


def _joined(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def mention_name(source: Column, keyword: Column, at: Column, author: Column) -> Column:
    return _joined(
        clean_string(source), "-", clean_string(keyword), "-", stamp(at), "-", clean_string(author), ENDING
    )


def attendee_name(source: Column, created_at: Column, email: Column, name: Column) -> Column:
    """Mail address, else name, else no third part; an empty string counts as absent.

    The source is lower-cased but otherwise kept as given.
    """
    who = F.coalesce(F.nullif(email, F.lit("")), F.nullif(name, F.lit("")))
    suffix = F.coalesce(_joined("-", sanitize(F.replace(who, F.lit("@"), F.lit("·")))), F.lit(""))
    return F.lower(_joined(source, "-", F.date_format(created_at, DAY_FORMAT), suffix, ENDING))


def call_name(start: Column, recording: Column, title: Column) -> Column:
    return _joined(stamp(start), "-", recording, "-", clean_string(title), ENDING)


def transaction_name(at: Column, key: Column, user: Column) -> Column:
    when = F.date_format(at, DAY_SECOND_FORMAT)
    return _joined(when, "-txn-", key.cast("string"), "-user-", user.cast("string"), ENDING)


def product_name(key: Column) -> Column:
    return _joined("product-", key.cast("string"), ENDING)
