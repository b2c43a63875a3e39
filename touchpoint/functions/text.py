"""Text cleaning, file names and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters changed in file names. The first three have replacements, the rest are
# deleted; a blank becomes a middle dot, both slashes become an underscore.
NAME_CHARS = " /\\()[]{}<>|:,.!?'"
NAME_REPLACEMENTS = "·__"

# The characters that count as blank at the ends of a string.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Length of a value shown in a row identifier, and the columns tried first.
IDENTIFIER_LENGTH = 50
IDENTIFIER_COLUMNS = ("id", "primary_key", "pk", "key", "uuid")

# Top-level names that never receive mail.
NO_MAIL_DOMAINS = ("arpa", "invalid", "local", "localhost", "onion", "test")

_LOCAL_ATOM = "[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+"
_DOMAIN_LABEL = "[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?"
EMAIL_PATTERN = rf"^{_LOCAL_ATOM}(?:\.{_LOCAL_ATOM})*@(?:{_DOMAIN_LABEL}\.)+[A-Za-z][A-Za-z0-9-]*[A-Za-z0-9]$"
WEB_URL_PATTERN = r"^[hH][tT][tT][pP][sS]?://(?:[^/?#@\s]*@)?[^/?#@:\s]+(?::[0-9]{1,5})?(?:[/?#]\S*)?$"

BUCKET_SCHEME = "gs://"


def strip(text: Column) -> Column:
    """Remove blanks, Unicode ones included, from both ends."""
    return F.btrim(text, F.lit(BLANKS))


def is_blank(text: Column) -> Column:
    """True for null, empty and blank-only text."""
    return F.coalesce(strip(text), F.lit("")) == ""


def sanitize(text: Column) -> Column:
    """Make a string usable as an object name."""
    return F.translate(text, NAME_CHARS, NAME_REPLACEMENTS)


def clean_string(text: Column) -> Column:
    """Lower case, strip, sanitise."""
    return sanitize(strip(F.lower(text)))


def is_email(text: Column) -> Column:
    """Mail-address check.

    A regular-expression approximation of the full grammar: no quoted local parts, no address
    literals, ASCII domains only, and none of the names in ``NO_MAIL_DOMAINS``.
    """
    top_level = F.lower(F.substring_index(F.substring_index(text, "@", -1), ".", -1))
    shape = text.rlike(EMAIL_PATTERN) & (F.length(F.substring_index(text, "@", 1)) <= 64)
    return F.coalesce(shape & (F.length(text) <= 254) & ~top_level.isin(*NO_MAIL_DOMAINS), F.lit(False))


def is_web_url(text: Column) -> Column:
    """http or https URL with a host. Approximates the full URL grammar."""
    return F.coalesce(text.rlike(WEB_URL_PATTERN) & (F.length(text) <= 2083), F.lit(False))


def organization(speaker: Column) -> Column:
    """Domain of a speaker that is a mail address, else null."""
    return F.when(is_email(speaker), F.substring_index(speaker, "@", -1))


def bucket_table_name(name: Column) -> Column:
    """Bucket name as a table name."""
    return F.replace(name, F.lit("-"), F.lit("_"))


def bucket_url(name: Column) -> Column:
    return F.concat(F.lit(BUCKET_SCHEME), name)


def bucket_from_url(url: Column) -> Column:
    """Table name of a bucket URL."""
    return bucket_table_name(F.replace(url, F.lit(BUCKET_SCHEME), F.lit("")))


def row_identifier(columns: list[str]) -> Column:
    """Short ``column=value`` label of a row for reports.

    The first usual key column wins even when its value is null (shown as ``None``); without one,
    the first non-null column in order is shown, cut to a fixed length.
    """
    for name in IDENTIFIER_COLUMNS:
        if name in columns:
            return F.expr(f"concat('{name}=', coalesce(string(`{name}`), 'None'))")
    labels = [
        f"concat('{name}=', if(length(string(`{name}`)) > {IDENTIFIER_LENGTH},"
        f" concat(left(string(`{name}`), {IDENTIFIER_LENGTH}), '...'), string(`{name}`)))"
        for name in columns
    ]
    return F.expr(f"coalesce({', '.join([*labels, repr('unknown_model')])})")
