"""Checks that split a frame into valid rows and rejects with a reason."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpoint.functions.text import is_blank, is_email, is_web_url, row_identifier

REASON = "reject_reason"

# Texts returned to the sender of an invalid record.
INVALID = "Invalid webhook: "
BAD_TRANSACTION_ID = "Invalid transaction ID"
BAD_USER_ID = "Invalid user ID"
EMPTY_BODY = "Empty receipt body"
BAD_PRODUCT_ID = "Invalid product ID"
EMPTY_PRODUCT_ID = "Empty product ID"
EMPTY_TITLE = "Empty product title"
EMPTY_DESCRIPTION = "Empty product description"
BAD_HID = "Invalid hid"
BAD_CATEGORY_HID = "Invalid product_category_hid"
MENTION_ACTION = "mention_created"

Rule = tuple[Column, str | Column]


class Checked:
    """Rows split by a reject reason; both sides are built when asked for.

    Writing both reads the input twice. A job that needs both flags its rows and writes them once with
    ``sinks.outcomes.settle``.
    """

    def __init__(self, valid: Callable[[], DataFrame], rejects: Callable[[], DataFrame]):
        self._valid, self._rejects = valid, rejects

    @cached_property
    def valid(self) -> DataFrame:
        """The accepted rows."""
        return self._valid()

    @cached_property
    def rejects(self) -> DataFrame:
        """The refused rows with ``row_key`` and ``reject_reason``."""
        return self._rejects()

    def then(self, valid: Callable[[DataFrame], DataFrame], rejects: Callable[[DataFrame], DataFrame] | None = None) -> Checked:
        """The same split with further steps on either side."""
        return Checked(lambda: valid(self.valid), lambda: rejects(self.rejects) if rejects else self.rejects)


def with_reason(df: DataFrame, rules: list[Rule], prefix: str = "") -> DataFrame:
    """Add the reasons why a row is invalid, joined by a comma; null for a valid row.

    A rule is (condition that must hold, reason). A null condition counts as not held. A row that an earlier
    step has refused keeps that reason.
    """
    reasons = [
        F.when(~F.coalesce(holds, F.lit(False)), reason if isinstance(reason, Column) else F.lit(reason))
        for holds, reason in rules
    ]
    joined = F.concat_ws(", ", *reasons)
    return flag_first(df, F.when(joined != "", F.concat(F.lit(prefix), joined)))


def flag_first(df: DataFrame, reason: Column) -> DataFrame:
    """Set the reject reason of the rows that have none yet."""
    return df.withColumn(REASON, F.coalesce(F.col(REASON), reason) if REASON in df.columns else reason)


def split_checked(flagged: DataFrame) -> Checked:
    """Split a flagged frame."""
    def rejects() -> DataFrame:
        names = [c for c in flagged.columns if c != REASON]
        return flagged.where(F.col(REASON).isNotNull()).select(row_identifier(names).alias("row_key"), "*")

    return Checked(lambda: flagged.where(F.col(REASON).isNull()).drop(REASON), rejects)


def check(df: DataFrame, rules: list[Rule], prefix: str = "") -> Checked:
    return split_checked(with_reason(df, rules, prefix))


def flag_mentions(df: DataFrame) -> DataFrame:
    """Only newly created mentions are taken; the reason names the action that was sent."""
    refused = ~F.coalesce(F.col("action") == MENTION_ACTION, F.lit(False))
    return df.withColumn(REASON, F.when(refused, F.concat(F.lit(INVALID), F.coalesce("action", F.lit("")))))


def receipt_rules() -> list[Rule]:
    return [
        (F.col("id") > 0, BAD_TRANSACTION_ID),
        (F.col("user_id") > 0, BAD_USER_ID),
        (~is_blank(F.col("body")), EMPTY_BODY),
    ]


def product_rules() -> list[Rule]:
    return [(F.col("id") > 0, BAD_PRODUCT_ID), (~is_blank(F.col("title")), EMPTY_TITLE)]


def description_rules() -> list[Rule]:
    return [
        (~is_blank(F.col("id")), EMPTY_PRODUCT_ID),
        (~is_blank(F.col("title")), EMPTY_TITLE),
        (~is_blank(F.col("description")), EMPTY_DESCRIPTION),
        (F.col("hid") > 0, BAD_HID),
        (F.col("product_category_hid") > 0, BAD_CATEGORY_HID),
    ]


def required_rules(table: dict[str, tuple[str, bool]], non_empty: tuple[str, ...] = ()) -> list[Rule]:
    """Required columns must be there and castable; only ``non_empty`` ones may not be ''."""
    rules: list[Rule] = []
    for name, (kind, required) in table.items():
        holds = [f"`{name}` IS NOT NULL"] if required else []
        if kind != "string":
            holds.append(f"(`{name}` IS NULL OR try_cast(`{name}` AS {kind}) IS NOT NULL)")
        if name in non_empty:
            holds.append(f"`{name}` <> ''")
        if holds:
            rules.append((F.expr(" AND ".join(holds)), name))
    return rules


def contact_rules() -> list[Rule]:
    present = ("first_name", "last_name", "company", "position", "connected_on", "timestamp")
    return [
        *[(F.col(name).isNotNull(), name) for name in present],
        (is_web_url(F.col("url")), "url"),
        (is_email(F.col("email_address")), "email_address"),
    ]


def speaker_rules() -> list[Rule]:
    return [(~is_blank(F.col("name")), "name"), (is_email(F.col("email")), "email")]


def text_rules(text: str) -> list[Rule]:
    """The text to embed must not be blank; the reason shows its length before and after stripping."""
    length = F.coalesce(F.length(text), F.lit(0)).cast("string")
    return [(~is_blank(F.col(text)), F.concat(F.lit("empty text, length "), length))]


def status_split(status: Column) -> Column:
    """A remote answer without a status, or no answer, is a failure."""
    return F.when(status.isNull(), "failed").otherwise("successful")


def strict(checked: Checked) -> DataFrame:
    """The valid rows of a job that must not have rejects.

    Runs a query for one reject and raises with its reason.
    """
    first = checked.rejects.select("row_key", REASON).first()
    if first is not None:
        raise ValueError(f"{first['row_key']}: {first[REASON]}")
    return checked.valid
