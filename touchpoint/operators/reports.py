"""Run reports and failure triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The largest batch the embedding service takes, and the size used beyond it.
MAX_BATCH = 250
REDUCED_BATCH = 249

# Classes of write failures and the texts that mark them, in order of precedence.
EXISTS_TEXT = "already exists"
NOT_FOUND_TEXT = "was not found"
UNINDEXED_TEXTS = ("number of un-indexed rows", "exceeds the maximum")
RATE_TEXTS = ("429", "Too many concurrent writes")
RATE_TEXT_ANY_CASE = "retry limit"
TIMEOUT_TEXTS_ANY_CASE = ("timeout", "timed out")
RETRY_TEXTS_ANY_CASE = ("429", "too many", "rate limit", "retry")


def batch_size(requested: int) -> int:
    return REDUCED_BATCH if requested > MAX_BATCH else requested


def failure_class(message: Column) -> Column:
    """Class of a write failure by its message."""
    low = F.lower(message)
    rate = message.contains(RATE_TEXTS[0]) | message.contains(RATE_TEXTS[1]) | low.contains(RATE_TEXT_ANY_CASE)
    timeout = low.contains(TIMEOUT_TEXTS_ANY_CASE[0]) | low.contains(TIMEOUT_TEXTS_ANY_CASE[1])
    return (
        F.when(message.contains(EXISTS_TEXT), "EXISTS")
        .when(message.contains(NOT_FOUND_TEXT), "NOT_FOUND")
        .when(
            message.contains(UNINDEXED_TEXTS[0]) & message.contains(UNINDEXED_TEXTS[1]), "MAX_UNINDEXED_ROWS_EXCEEDED"
        )
        .when(rate, "RATE_LIMITED")
        .when(timeout, "TIMEOUT")
        .otherwise("UNEXPECTED")
    )


def is_retryable(message: Column) -> Column:
    """Rate limits are retried; an unclassified failure too when its text speaks of one."""
    low = F.lower(message)
    hints = F.lit(False)
    for text in RETRY_TEXTS_ANY_CASE:
        hints = hints | low.contains(text)
    kind = failure_class(message)
    return (kind == "RATE_LIMITED") | ((kind == "UNEXPECTED") & hints)


def run_report(flags: DataFrame, size: int) -> DataFrame:
    """Counts of a run from one boolean column per fate: invalid, skipped, failed, embedded.

    ``n_batches`` is what one stream of full batches needs; batching per task may use more calls.
    """
    size = batch_size(size)
    sent = F.count_if(F.col("embedded") | F.col("failed"))
    return flags.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if("invalid").alias("n_invalid"),
        F.count_if("skipped").alias("n_skipped"),
        F.count_if("failed").alias("n_failed"),
        F.count_if("embedded").alias("n_embedded"),
        F.ceil(sent / F.lit(size)).cast("bigint").alias("n_batches"),
    )
