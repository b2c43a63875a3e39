"""Jobs over typed records: embedding upsert, backfill, replayed transactions, profiles, contacts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpoint.datasets import Dataset
from touchpoint.functions.dates import age, contact_date, restamp, same_weekday
from touchpoint.functions.text import row_identifier
from touchpoint.operators import reports
from touchpoint.operators.enrich import (
    PROFILE_FALLBACK, Embedder, StatusClient, TextClient, embed_rows, generate_text, lookup_status, template_text,
)
from touchpoint.operators.keys import allocate_ids, latest_per_key, resume, sample_rows
from touchpoint.operators.project import receipts_of
from touchpoint.operators.validate import REASON, Checked, check, contact_rules, text_rules, with_reason
from touchpoint.schemas import with_embedding
from touchpoint.sinks.files import newest_objects, write_keyed_json
from touchpoint.sinks.outcomes import REJECTED, VALID, report_frame, settle
from touchpoint.sinks.tables import Ledger, append_rows, replace_table, stored_once
from touchpoint.sources.files import (
    BLANK_LINE, POSITION, REFUSED, flag_json_docs, flag_json_lines, row_numbers, unread_files,
)
from touchpoint.sources.tables import read_keys

SKIPPED, OPEN, EMBEDDED, FAILED, BLANK = "skipped", "open", "embedded", "failed", "blank"


@dataclass(frozen=True)
class EmbedRun:
    """Counts of a run, the refused records with their reason, and the records whose text the service refused."""

    report: dict[str, int]
    rejects: DataFrame
    failed: DataFrame


def flag_for_embedding(records: DataFrame, dataset: Dataset) -> DataFrame:
    """Records with the first reason against embedding them: a broken rule, a blank text, no key."""
    flagged = with_reason(dataset.flagged(records), text_rules(dataset.text))
    return with_reason(flagged, [(F.col(dataset.key).isNotNull(), f"no {dataset.key}")])


def embed_upsert(
    records: DataFrame, dataset: Dataset, path: str, embedder: Embedder, batch_size: int = 35, parallelism: int | None = None, window: int = 1
) -> EmbedRun:
    """Embed the records that are valid and not stored yet, and append them to the table.

    The records are read once: each gets its status, and all are written by status and counted in that write.
    Only what is open then goes to the costly service, one row per key, and its answers are written before they are
    appended. A repeated run finds its keys stored and adds nothing.
    """
    spark, key = records.sparkSession, dataset.key
    schema = with_embedding(dataset.schema)
    stored = read_keys(spark, path, key, schema[key].dataType.simpleString()).withColumn("_stored", F.lit(True))
    marked = flag_for_embedding(records, dataset).join(stored, key, "left")
    status = F.when(F.col(REASON).isNotNull(), REJECTED).when(F.col("_stored"), SKIPPED).otherwise(OPEN)
    first = settle(marked, (REJECTED, SKIPPED, OPEN), status, f"{dataset.name}-records", ["_stored"])
    new = latest_per_key(first.of(OPEN).drop(REASON), [key], dataset.ordering())
    answered = F.when(F.col("embedding").isNotNull(), EMBEDDED).otherwise(FAILED)
    second = settle(embed_rows(new, dataset.text, embedder, batch_size, parallelism, window), (EMBEDDED, FAILED), answered, f"{dataset.name}-embedded")
    append_rows(second.of(EMBEDDED).select(*schema.names), path)
    sent = sum(second.counts.values())
    report = {
        "n_total": sum(first.counts.values()), "n_invalid": first.counts[REJECTED], "n_skipped": first.counts[SKIPPED],
        "n_repeated": first.counts[OPEN] - sent, "n_failed": second.counts[FAILED], "n_embedded": second.counts[EMBEDDED],
        "n_batches": -(-sent // reports.batch_size(batch_size)),
    }
    rejected = first.of(REJECTED)
    names = [c for c in rejected.columns if c != REASON]
    return EmbedRun(report, rejected.select(row_identifier(names).alias("row_key"), "*"), second.of(FAILED).drop("embedding"))


def backfill(
    ids: DataFrame, key: str, succeeded: Ledger, failed: Ledger, client: StatusClient, run_path: str,
    parallelism: int | None = None, window: int = 1,
) -> None:
    """Look up the ids that have not succeeded yet and note each in a ledger.

    ``parallelism`` bounds the calls in flight in all, ``window`` those of a task.

    The answers are written to ``run_path`` once, so that the two ledgers do not ask the service twice.
    """
    todo = resume(ids.select(F.col(key).cast("string").alias(key)), succeeded.read(), key)
    lookup_status(todo, key, client, parallelism, window).write.mode("overwrite").parquet(run_path)
    answers = ids.sparkSession.read.parquet(run_path)
    succeeded.add(answers.where("ok").select(key))
    failed.add(answers.where("not ok").select(key))


def replayed(history: DataFrame, target_date: str, user_id: int, seed: str, size: int) -> DataFrame:
    """New transactions for a day: a sample of the same weekday's history, re-dated and re-numbered."""
    target = F.lit(target_date).cast("timestamp")
    matching = history.where(same_weekday(F.col("at"), target))
    drawn = sample_rows(matching, "id", seed, size).withColumnRenamed("id", "_old")
    dated = drawn.withColumn("at", restamp(F.col("at"), target)).withColumn("user_id", F.lit(user_id).cast("bigint"))
    numbered = allocate_ids(dated, history, "id", [F.md5(F.concat(F.lit(seed), F.col("_old").cast("string"))), F.col("_old")])
    return numbered.select("id", "amount", "at", "description", "user_id", "payer_id", "payee_id")


def run_replay(
    history: DataFrame, target_date: str, user_id: int, seed: str, size: int, transactions: str, receipts: str | None
) -> None:
    """Append the replayed transactions, and their receipts when a path is given; receipts that are refused go to ``<receipts>-rejects``."""
    new = stored_once(replayed(history, target_date, user_id, seed, size), "replayed")
    append_rows(new, transactions)
    if receipts:
        made = receipts_of(new)
        append_rows(made.valid, receipts)
        append_rows(made.rejects.select("row_key", REASON), f"{receipts}-rejects")


def profiles(
    users: DataFrame, today: str, client: TextClient | None = None, parallelism: int | None = None, window: int = 1
) -> DataFrame:
    """Profile text per user from a client, or the fixed text without one; null for a user without a name or an age.

    ``parallelism`` bounds the calls in flight in all, ``window`` those of a task; without ``parallelism`` the partitioning of the
    input is kept.
    """
    aged = users.withColumn("age", age(F.to_date("dob"), F.to_date(F.lit(today))))
    complete = F.col("age").isNotNull() & F.col("name").isNotNull()
    known = aged.where(complete)
    made = generate_text(known, client, PROFILE_FALLBACK, "bio", parallelism, window) if client else template_text(
        known, PROFILE_FALLBACK, "bio"
    )
    missing = aged.where(~complete).select("id", F.lit(None).cast("string").alias("bio"))
    return made.select("id", "bio").union(missing).select(F.col("id").cast("bigint").alias("id"), "bio")


def run_profiles(
    users: DataFrame, today: str, path: str, client: TextClient | None = None, parallelism: int | None = None, window: int = 1
) -> None:
    replace_table(profiles(users, today, client, parallelism, window), path)


def contacts(rows: DataFrame) -> Checked:
    """Contacts with their dates parsed; a date that does not parse makes the row a reject."""
    return check(rows.withColumn("connected_on", contact_date(F.col("connected_on"))), contact_rules())


def _store_events(flagged: DataFrame, dataset: Dataset, out: str, unread: DataFrame | None = None) -> dict[str, int]:
    """Parse once, write by status, then the objects, of which the later one wins, and the rejects with path, line and text."""
    judged = dataset.flagged(flagged)
    blank = F.col(REASON) == BLANK_LINE
    status = F.when(F.col(REASON).isNull(), VALID).when(blank, BLANK).otherwise(REJECTED)
    settled = settle(judged, (VALID, REJECTED, BLANK), status, f"{dataset.name}-events")
    valid = settled.of(VALID).drop(REASON, REFUSED)
    write_keyed_json(newest_objects(dataset.named(valid), [F.desc(POSITION)]).drop(POSITION, "_file"), f"{out}/objects")
    numbered = row_numbers(settled.of(REJECTED), settled.rows.select(POSITION), "line_no")
    rejects = numbered.select(F.col(f"{POSITION}.file").alias("row_key"), "line_no", F.col(REFUSED).alias("text"), REASON)
    if unread is not None:
        rejects = rejects.unionByName(unread, allowMissingColumns=True)
    rejects.write.mode("overwrite").json(f"{out}/rejects")
    report_frame(judged, settled.counts).write.mode("overwrite").json(f"{out}/report")
    return settled.counts


def run_events(spark: SparkSession, dataset: Dataset, folder: str, out: str) -> dict[str, int]:
    """Files of one JSON event each → validated lines with an object name, rejects, and the run's counts."""
    suffixes = [".json", ".jsonl"]
    flagged = flag_json_docs(spark, folder, dataset.schema, suffixes, (dataset.key,))
    return _store_events(flagged, dataset, out, unread_files(spark, folder, suffixes))


def run_event_lines(spark: SparkSession, dataset: Dataset, path: str, out: str) -> dict[str, int]:
    """The same for JSON Lines."""
    return _store_events(flag_json_lines(spark, path, dataset.schema, (dataset.key,)), dataset, out)
