"""The composite jobs, end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchpoint.catalog import roles
from touchpoint.catalog.registry import query, staged
from touchpoint.catalog.roles import table, ts_text
from touchpoint.catalog.scalars import ATTENDEE_NAME_SQL, LIST_ROWS_SQL, MENTION_NAME_SQL
from touchpoint.datasets import PRODUCTS, RECEIPTS
from touchpoint.functions.dates import iso
from touchpoint.operators.enrich import HashingEmbedder
from touchpoint.plans import attendees, calls, mentions, records
from touchpoint.schemas import MESSAGE_TABLE
from touchpoint.session import scratch_path
from touchpoint.sinks.files import export_objects
from touchpoint.sinks.tables import Ledger


@query(
    "job_attendees",
    f"""WITH {roles.ATTENDEES_SQL}, {roles.UNREAD_SQL}, ok AS (SELECT *, stem AS source FROM att WHERE reason IS NULL),
    objects AS (SELECT *, {ATTENDEE_NAME_SQL} AS file_name FROM ok),
    later AS (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY c_custkey DESC) AS r FROM objects)
    SELECT 'object' AS kind, file_name AS label, name, email, CAST(1 AS BIGINT) AS n FROM later WHERE r = 1
    UNION ALL SELECT 'aggregate', source, NULL, NULL, count(*) FROM ok GROUP BY source
    UNION ALL SELECT 'reject', reason, stem || '.csv', NULL, row_no FROM att WHERE reason IS NOT NULL
    UNION ALL SELECT 'reject', reason, name, NULL, NULL FROM unread
    UNION ALL SELECT 'report', 'valid', NULL, NULL, count(*) FROM ok UNION ALL SELECT 'report', 'rejected', NULL, NULL, count(*) FROM att WHERE reason IS NOT NULL""",
)
def job_attendees(spark, sf):
    folder = staged(spark, sf, "attendees", lambda path: export_objects(roles.attendee_files(spark, sf), path))
    out = scratch_path(spark, "job-attendees")
    attendees.run(spark, folder, out, roles.AS_OF)
    nothing = F.lit(None).cast("string")
    objects = spark.read.schema("file_name string, name string, email string").json(f"{out}/objects")
    aggregate = spark.read.options(header="true", escape='"').csv(f"{out}/aggregate").groupBy("source").count()
    rejects = spark.read.schema("row_key string, row_no bigint, reject_reason string").json(f"{out}/rejects")
    return (
        objects.select(F.lit("object").alias("kind"), F.col("file_name").alias("label"), "name", "email", F.lit(1).cast("bigint").alias("n"))
        .union(aggregate.select(F.lit("aggregate"), "source", nothing, nothing, "count"))
        .union(rejects.select(F.lit("reject"), "reject_reason", "row_key", nothing, "row_no"))
        .union(_report(spark, out, "valid", "rejected").select(F.lit("report"), "label", nothing, nothing, "n"))
    )


def _report(spark, out: str, *counts: str):
    """The stored counts of a run, one row each."""
    row = spark.read.schema(", ".join(f"{c} bigint" for c in counts)).json(f"{out}/report")
    return row.select(F.explode(F.create_map(*[x for c in counts for x in (F.lit(c), F.col(c))])).alias("label", "n"))


@query(
    "job_mentions",
    f"""WITH {roles.MENTIONS_SQL}, {roles.UNREAD_SQL}, why AS (SELECT *, concat_ws(', ', CASE WHEN relevance_comment IS NULL THEN 'relevance_comment' END,
        CASE WHEN doc_id % 11 = 0 THEN 'timestamp' END) AS lacks, row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) AS row_no FROM mn),
    judged AS (SELECT *, CASE WHEN doc_id % 13 = 4 THEN '16 cells under 15 columns' ELSE nullif(lacks, '') END AS reason FROM why),
    d AS (SELECT *, {MENTION_NAME_SQL} AS file_name FROM (
        SELECT *, row_number() OVER (PARTITION BY url ORDER BY ts DESC, source_id) AS r FROM mv WHERE doc_id % 13 <> 4) WHERE r = 1)
    SELECT 'object' AS kind, file_name, 'mention_created' AS label, url, source_id, body, CAST(1 AS BIGINT) AS n FROM (
      SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY doc_id DESC) AS f FROM d) WHERE f = 1
    UNION ALL SELECT 'reject', 'mentions-' || lpad(CAST(doc_id // 100 AS VARCHAR), 8, '0') || '.csv', reason, NULL, NULL, NULL, row_no FROM judged WHERE reason IS NOT NULL
    UNION ALL SELECT 'reject', name, reason, NULL, NULL, NULL, NULL FROM unread
    UNION ALL SELECT 'report', NULL, 'valid', NULL, NULL, NULL, count(*) FROM judged WHERE reason IS NULL
    UNION ALL SELECT 'report', NULL, 'rejected', NULL, NULL, NULL, count(*) FROM judged WHERE reason IS NOT NULL""",
)
def job_mentions(spark, sf):
    folder = staged(spark, sf, "mention-exports", lambda path: export_objects(roles.mention_files(spark, sf), path))
    out = scratch_path(spark, "job-mentions")
    mentions.run(spark, folder, out)
    stored = spark.read.schema(
        "file_name string, action string, data struct<url: string, source_id: string, body: string>"
    ).json(f"{out}/objects")
    rejects = spark.read.schema("row_key string, row_no bigint, reject_reason string").json(f"{out}/rejects")
    nothing = F.lit(None).cast("string")
    return (
        stored.select(F.lit("object").alias("kind"), "file_name", F.col("action").alias("label"), "data.*", F.lit(1).cast("bigint").alias("n"))
        .union(rejects.select(F.lit("reject"), "row_key", "reject_reason", nothing, nothing, nothing, "row_no"))
        .union(_report(spark, out, "valid", "rejected").select(F.lit("report"), nothing, "label", nothing, nothing, nothing, "n"))
    )


@query(
    "job_events_etl",
    f"""WITH {roles.RECEIPTS_SQL}, judged AS (SELECT *, CASE WHEN user_id = 7 THEN 'not a document of this schema' ELSE 'Invalid webhook: ' || nullif(concat_ws(', ', CASE WHEN id <= 0 THEN 'Invalid transaction ID' END,
        CASE WHEN user_id <= 0 THEN 'Invalid user ID' END, CASE WHEN trim(body) = '' THEN 'Empty receipt body' END), '') END AS reason FROM rc)
    SELECT strftime("at", '%Y%m%d-%H%M%S') || '-txn-' || id || '-user-' || user_id || '.jsonl' AS file_name, id, body, CAST(NULL AS VARCHAR) AS reject_reason, CAST(1 AS BIGINT) AS n
      FROM judged WHERE reason IS NULL
    UNION ALL SELECT NULL, NULL, CASE WHEN user_id = 7 THEN '{{"id": ' || id || ', "at"' END, reason, 1 FROM judged WHERE reason IS NOT NULL
    UNION ALL SELECT 'report', NULL, NULL, 'valid', count(*) FROM judged WHERE reason IS NULL
    UNION ALL SELECT 'report', NULL, NULL, 'rejected', count(*) FROM judged WHERE reason IS NOT NULL
    UNION ALL SELECT 'report', NULL, NULL, 'blank', count(*) FROM rc WHERE user_id = 8""",
)
def job_events_etl(spark, sf):
    source = staged(spark, sf, "receipt-lines", lambda path: roles.receipt_lines(spark, sf).write.text(path))
    out = scratch_path(spark, "job-events")
    records.run_event_lines(spark, RECEIPTS, source, out)
    objects = spark.read.schema("file_name string, id bigint, body string, reject_reason string").json(f"{out}/objects")
    rejects = spark.read.schema("text string, reject_reason string").json(f"{out}/rejects")
    nothing, one = F.lit(None), F.lit(1).cast("bigint")
    broken = F.when(F.col("reject_reason") == "not a document of this schema", F.col("text"))
    return (
        objects.withColumn("n", one)
        .union(rejects.select(nothing.cast("string"), nothing.cast("bigint"), broken, "reject_reason", one))
        .union(_report(spark, out, "valid", "rejected", "blank").select(F.lit("report"), nothing.cast("bigint"), nothing.cast("string"), "label", "n"))
    )


@query(
    "job_events_mentions",
    f"""WITH {roles.MENTIONS_SQL}, ok AS (SELECT *, {MENTION_NAME_SQL} AS file_name FROM mv WHERE length(body) % 4 <> 1)
    SELECT file_name, source_id, body, bookmarked, CAST(NULL AS VARCHAR) AS reject_reason, CAST(1 AS BIGINT) AS n FROM (
      SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY ts DESC, url DESC) AS f FROM ok) WHERE f = 1
    UNION ALL SELECT NULL, NULL, NULL, NULL, r, count(*) FROM (SELECT CASE WHEN length(body) % 4 = 1 THEN 'Invalid webhook: mention_deleted'
      ELSE concat_ws(', ', CASE WHEN relevance_comment IS NULL THEN 'relevance_comment' END, CASE WHEN doc_id % 11 = 0 THEN 'timestamp' END) END AS r FROM mn)
      WHERE r <> '' GROUP BY r""",
)
def job_events_mentions(spark, sf):
    action = F.when(F.length("body") % 4 == 0, "mention_created").when(F.length("body") % 4 == 1, "mention_deleted")
    rows = roles.mentions(spark, sf).withColumnsRenamed({"author": "Author", "source_id": "sourceId"})
    payload = F.to_json(F.struct(action.alias("action"), F.struct(*rows.columns).alias("data")))
    out = scratch_path(spark, "job-event-mentions")
    mentions.run_payloads(rows.select(payload.alias("payload")), "payload", out)
    mention = F.from_json("value", "source_id string, body string, bookmarked boolean").alias("m")
    objects = spark.read.schema("file_name string, value string").json(f"{out}/objects").select("file_name", mention)
    rejects = spark.read.schema("reject_reason string").json(f"{out}/rejects").groupBy("reject_reason").count()
    nothing = F.lit(None)
    return objects.select(
        "file_name", "m.source_id", "m.body", "m.bookmarked", nothing.cast("string").alias("reject_reason"),
        F.lit(1).cast("bigint").alias("n"),
    ).union(
        rejects.select(
            nothing.cast("string"), nothing.cast("string"), nothing.cast("string"), nothing.cast("boolean"), "reject_reason", "count"
        )
    )


@query(
    "job_events_calls",
    f"""{LIST_ROWS_SQL} SELECT strftime(start_at, '%Y_%m_%d_%H_%M_%S') || '-' || id || '-' || lower(title) || '.jsonl' AS file_name,
      id || '-' || lpad(CAST(n AS VARCHAR), 5, '0') AS id, d AS domain_name, p AS invitee, CAST(NULL AS VARCHAR) AS reject_reason FROM e WHERE url LIKE '%/calls/%'
    UNION ALL SELECT NULL, NULL, NULL, NULL, 'no recording id in url' FROM lc WHERE url NOT LIKE '%/calls/%'""",
)
def job_events_calls(spark, sf):
    events = roles.list_calls(spark, sf)
    payloads = events.select(F.to_json(F.struct(*events.columns)).alias("payload"))
    out = scratch_path(spark, "job-event-calls")
    calls.run_flat(calls.read_events(payloads, "payload").valid, out)
    stored = spark.read.schema(
        "file_name string, id string, meeting_external_domains_domain_name string, meeting_invitees_name string, reject_reason string"
    ).json(f"{out}/calls")
    nothing = F.lit(None).cast("string")
    rejects = spark.read.schema("reject_reason string").json(f"{out}/rejects")
    return stored.withColumnsRenamed(
        {"meeting_external_domains_domain_name": "domain_name", "meeting_invitees_name": "invitee"}
    ).union(rejects.select(nothing, nothing, nothing, nothing, "reject_reason"))


@query(
    "job_messages",
    f"""WITH {roles.SPEAKERS_SQL}, {roles.MESSAGES_SQL}, judged AS (SELECT id % 19 = 5 AS cut, id, url, CASE WHEN id % 19 = 5 THEN 'not a document of this schema' WHEN id % 23 = 6 THEN 'missing fathom_user'
        ELSE nullif(concat_ws(', ', CASE WHEN recording_id IS NULL THEN 'no recording id in url' END, CASE WHEN id % 13 = 0 THEN 'content before the first speaker' END,
          CASE WHEN id % 17 = 0 THEN 'invalid watch link' END), '') END AS reason FROM calls)
    SELECT recording_id || '-' || lpad(CAST(message_id AS VARCHAR), 5, '0') AS id,
      recording_id, message_id, url, title, strftime(date, '%Y-%m-%d %H:%M:%S') AS date,
      CAST(CASE WHEN length(off) > 5 THEN CAST(split_part(off, ':', 1) AS BIGINT) * 3600 + CAST(split_part(off, ':', 2) AS BIGINT) * 60 + CAST(split_part(off, ':', 3) AS BIGINT)
        ELSE CAST(split_part(off, ':', 1) AS BIGINT) * 60 + CAST(split_part(off, ':', 2) AS BIGINT) END AS BIGINT) AS "timestamp",
      coalesce(email, who) AS speaker, split_part(email, '@', 2) AS organization, message, action_item, watch_link, CAST(NULL AS VARCHAR) AS reject_reason
    FROM ah LEFT JOIN lk ON lookup_name = lower(who) WHERE call_id % 19 <> 5 AND call_id % 23 <> 6
    UNION ALL SELECT NULL, NULL, NULL, CASE WHEN id % 19 <> 5 AND id % 23 <> 6 THEN url END, NULL, NULL, NULL, NULL, NULL,
      CASE WHEN cut THEN '{{"id": ' || id || ', "recording"' END, NULL, NULL, reason FROM judged WHERE reason IS NOT NULL""",
)
def job_messages(spark, sf):
    """Posted call events and the speaker file; the text of a payload that is no JSON stands in ``message``."""
    folder = staged(spark, sf, "speaker-file", lambda path: export_objects(roles.speaker_file(spark, sf), path))
    out = scratch_path(spark, "job-messages")
    calls.run_posted_messages(spark, roles.call_payloads(spark, sf), "payload", f"{folder}/speakers.json", out)
    kinds = ", ".join(f"{n} {t}" for n, (t, _) in MESSAGE_TABLE.items())
    rows = spark.read.schema(kinds).json(f"{out}/messages").withColumn("date", ts_text(F.col("date")))
    names = ["id", "recording_id", "message_id", "url", "title", "date", "timestamp", "speaker", "organization", "message", "action_item", "watch_link"]
    rejects = spark.read.schema("text string, url string, reject_reason string").json(f"{out}/rejects")
    text = F.when(F.col("reject_reason") == "not a document of this schema", F.col("text")).alias("message")
    return rows.select(*names).unionByName(rejects.select("url", text, "reject_reason"), allowMissingColumns=True)


@query(
    "job_calls_flat",
    f"""{LIST_ROWS_SQL} SELECT id || '-' || lpad(CAST(n AS VARCHAR), 5, '0') AS id, CAST(id AS VARCHAR) AS recording_id, url AS recording_url,
      minutes AS recording_duration_in_minutes, title AS meeting_title, strftime(start_at, '%Y-%m-%d %H:%M:%S') AS meeting_scheduled_start_time,
      d AS meeting_external_domains_domain_name, p AS meeting_invitees_name, p || '@mail.example.com' AS meeting_invitees_email,
      p = 'red' AS meeting_invitees_is_external, 'host@mail.example.com' AS fathom_user_email, CAST(NULL AS VARCHAR) AS reject_reason
    FROM e WHERE url LIKE '%/calls/%'
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'no recording id in url' FROM lc WHERE url NOT LIKE '%/calls/%'""",
)
def job_calls_flat(spark, sf):
    built = calls.flat_rows(roles.list_calls(spark, sf))
    rows = built.valid.select(
        "id", "recording_id", "recording_url", "recording_duration_in_minutes", "meeting_title",
        ts_text(F.col("meeting_scheduled_start_time")).alias("meeting_scheduled_start_time"),
        "meeting_external_domains_domain_name", "meeting_invitees_name", "meeting_invitees_email",
        "meeting_invitees_is_external", "fathom_user_email",
    )
    return rows.unionByName(built.rejects.select("reject_reason"), allowMissingColumns=True)


@query(
    "job_srt_import",
    f"""WITH {roles.EXPORTS_SQL} SELECT url, title, strftime(date, '%Y-%m-%d') AS day, text AS plaintext, CAST(NULL AS VARCHAR) AS reject_reason FROM ex WHERE url IS NOT NULL
    UNION ALL SELECT NULL, NULL, NULL, NULL, 'URL is None' FROM ex WHERE url IS NULL""",
)
def job_srt_import(spark, sf):
    folder = staged(spark, sf, "exports", lambda path: export_objects(roles.export_files(spark, sf), path))
    out = scratch_path(spark, "job-srt")
    calls.run_import(spark, folder, out, roles.EXPORT_AS_OF, "backfill", "backfill@mail.example.com", "devx")
    stored = spark.read.schema("payload string").json(f"{out}/raw")
    event = F.from_json(
        "payload",
        "recording struct<url: string>, meeting struct<title: string, scheduled_start_time: timestamp>, transcript struct<plaintext: string>",
    )
    nothing = F.lit(None).cast("string")
    rejects = spark.read.schema("reject_reason string").json(f"{out}/rejects")
    events = stored.select(event.alias("e")).select(
        F.col("e.recording.url").alias("url"), F.col("e.meeting.title").alias("title"),
        F.date_format("e.meeting.scheduled_start_time", "yyyy-MM-dd").alias("day"),
        F.col("e.transcript.plaintext").alias("plaintext"), nothing.alias("reject_reason"),
    )
    return events.union(rejects.select(nothing, nothing, nothing, nothing, "reject_reason"))


REPORT = ("n_total", "n_invalid", "n_skipped", "n_repeated", "n_failed", "n_embedded", "n_batches")


@query(
    "job_embed_upsert",
    f"""WITH {roles.PRODUCTS_SQL}, judged AS (SELECT *, CASE WHEN id <= 0 THEN 'Invalid webhook: Invalid product ID' || CASE WHEN trim(title) = '' THEN ', Empty product title' ELSE '' END
        WHEN trim(title) = '' THEN 'Invalid webhook: Empty product title' END AS reason, id IN (SELECT s_suppkey FROM supplier WHERE s_suppkey > 0) AS known FROM pr),
    runs AS (SELECT 0 AS run, count(*) AS n_total, count(*) FILTER (WHERE s_suppkey <= 0) AS n_invalid, 0 AS n_skipped, count(*) FILTER (WHERE s_suppkey > 0) AS n_embedded FROM supplier
      UNION ALL SELECT 1, count(*), count(reason), count(*) FILTER (WHERE reason IS NULL AND known), count(*) FILTER (WHERE reason IS NULL AND NOT known) FROM judged
      UNION ALL SELECT 2, count(*), count(reason), count(*) FILTER (WHERE reason IS NULL), 0 FROM judged)
    SELECT 'row' AS kind, id, CASE WHEN known THEN s_name ELSE title END AS label, CAST(64 AS BIGINT) AS n FROM judged LEFT JOIN supplier ON s_suppkey = id
      WHERE known OR reason IS NULL
    UNION ALL SELECT 'row', s_suppkey, s_name, 64 FROM supplier WHERE s_suppkey > 0 AND s_suppkey NOT IN (SELECT id FROM pr)
    UNION ALL SELECT 'reject', id, reason, 2 FROM judged WHERE reason IS NOT NULL
    UNION ALL SELECT 'report ' || run, NULL, unnest(['n_total', 'n_invalid', 'n_skipped', 'n_repeated', 'n_failed', 'n_embedded', 'n_batches']),
      unnest([n_total, n_invalid, n_skipped, 0, 0, n_embedded, CAST(ceil(n_embedded / 35.0) AS BIGINT)]) FROM runs""",
)
def job_embed_upsert(spark, sf):
    """Three loads; the third finds all its keys stored."""
    path = scratch_path(spark, "job-embed")
    stored = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"))
    loads = (stored, roles.products(spark, sf), roles.products(spark, sf))
    runs = [records.embed_upsert(rows, PRODUCTS, path, HashingEmbedder(64)) for rows in loads]
    made = spark.read.parquet(path).select(F.lit("row").alias("kind"), F.col("id").cast("bigint").alias("id"), F.col("title").alias("label"), F.size("embedding").cast("bigint").alias("n"))
    refused = runs[1].rejects.unionByName(runs[2].rejects).groupBy("id", "reject_reason").count()
    counts = [(f"report {i}", None, name, run.report[name]) for i, run in enumerate(runs) for name in REPORT]
    reports = spark.createDataFrame(counts, "kind string, id bigint, label string, n bigint")
    return made.union(refused.select(F.lit("reject"), F.col("id").cast("bigint"), "reject_reason", "count")).union(reports)


@query(
    "job_backfill",
    """SELECT CAST(conv_id AS VARCHAR) AS id, CASE WHEN conv_id IN (SELECT doc_id FROM labels) OR conv_id % 7 <> 3 THEN 'successful' ELSE 'failed' END AS outcome
    FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION SELECT CAST(doc_id AS VARCHAR), 'successful' FROM labels""",
)
def job_backfill(spark, sf):
    def client(key: str) -> int | None:
        return None if int(key) % 7 == 3 else 200

    out = scratch_path(spark, "job-backfill")
    succeeded, failed = Ledger(spark, f"{out}/successful", "id"), Ledger(spark, f"{out}/failed", "id")
    succeeded.add(table(spark, sf, "labels").select(F.col("doc_id").alias("id")))
    ids = table(spark, sf, "conversations").select(F.col("conv_id").alias("id"))
    for run in ("first", "second"):
        records.backfill(ids, "id", succeeded, failed, client, f"{out}/{run}")
    return succeeded.export().withColumn("outcome", F.lit("successful")).union(
        failed.export().withColumn("outcome", F.lit("failed"))
    )


@query(
    "job_txn_replay",
    f"""WITH {roles.TRANSACTIONS_SQL}, drawn AS (SELECT *, md5('replay' || id) AS d FROM tx
      WHERE dayofweek("at") = dayofweek(DATE '2024-03-04') ORDER BY d, id LIMIT 7)
    SELECT (SELECT max(event_id) FROM events) + row_number() OVER (ORDER BY d, id) AS id, amount,
      strftime(TIMESTAMP '2024-03-04' + ("at" - date_trunc('day', "at")), '%Y-%m-%d %H:%M:%S') AS "at", description, CAST(1 AS BIGINT) AS user_id,
      payer_id, 'Transaction: ' || description AS body FROM drawn""",
)
def job_txn_replay(spark, sf):
    out = scratch_path(spark, "job-replay")
    records.run_replay(roles.transactions(spark, sf), "2024-03-04", 1, "replay", 7, f"{out}/transactions", f"{out}/receipts")
    receipts = spark.read.parquet(f"{out}/receipts").select("id", "body")
    made = spark.read.parquet(f"{out}/transactions").join(receipts, "id")
    return made.select("id", "amount", ts_text(F.col("at")).alias("at"), "description", "user_id", "payer_id", "body")


@query(
    "job_profiles",
    f"""WITH {roles.USERS_SQL} SELECT id, CASE WHEN a >= 60 THEN name || ' is ' || a ELSE 'Hi, I''m ' || name || '. I enjoy exploring new experiences and connecting with others.' END AS bio
    FROM (SELECT *, date_part('year', DATE '2024-02-28') - date_part('year', dob) - CASE WHEN strftime(dob, '%m%d') > '0228' THEN 1 ELSE 0 END AS a FROM us)""",
)
def job_profiles(spark, sf):
    def client(row: dict) -> str | None:
        return f"{row['name']} is {row['age']}" if row["age"] >= 60 else None

    out = scratch_path(spark, "job-profiles")
    records.run_profiles(roles.users(spark, sf), "2024-02-28", out, client)
    return spark.read.parquet(out)


@query(
    "job_contacts",
    f"""WITH {roles.CONTACTS_SQL} SELECT first_name, email_address, CASE WHEN r = '' THEN strftime(connected_at, '%Y-%m-%dT%H:%M:%S+00:00') END AS connected_on, nullif(r, '') AS reject_reason
    FROM (SELECT *, concat_ws(', ', CASE WHEN connected_at IS NULL THEN 'connected_on' END, CASE WHEN url NOT LIKE 'https://%' THEN 'url' END,
      CASE WHEN email_address NOT LIKE '%+tag@%' THEN 'email_address' END) AS r FROM ct)""",
)
def job_contacts(spark, sf):
    checked = records.contacts(roles.contacts(spark, sf))
    nothing = F.lit(None).cast("string")
    valid = checked.valid.select("first_name", "email_address", iso(F.col("connected_on")).alias("connected_on"), nothing.alias("reject_reason"))
    return valid.union(checked.rejects.select("first_name", "email_address", nothing, "reject_reason"))
