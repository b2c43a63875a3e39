"""Streaming jobs, run over all files of a landing folder; results equal the batch results."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchpoint.catalog import roles
from touchpoint.catalog.registry import query, staged
from touchpoint.catalog.roles import table
from touchpoint.datasets import DESCRIPTIONS, RECEIPTS
from touchpoint.operators.enrich import HashingEmbedder
from touchpoint.operators.joins import stack_frames
from touchpoint.operators.project import json_line
from touchpoint.operators.validate import REASON
from touchpoint.paths import folder_names
from touchpoint.schemas import PRODUCT_DESCRIPTION, RECEIPT
from touchpoint.session import scratch_path
from touchpoint.streaming import landing


#: Rows of a landed file, about; a table of any size has files that one task can read.
LANDED_ROWS = 10_000


def _cut(rows):
    """The rows in as many partitions as there will be files: four, more for a larger table."""
    return rows.repartition(max(4, -(-rows.count() // LANDED_ROWS)))


def _half(spark, folder: str) -> int:
    """Files for each of two batches of a landing folder."""
    return max(2, -(-sum(name.startswith("part-") for name in folder_names(spark, folder)) // 2))


def _landed(spark, sf, name, rows):
    return staged(spark, sf, name, lambda path: _cut(rows).write.option("ignoreNullFields", "false").json(path))


@query("g01_stream_raw", "SELECT sha256(payload) AS object_key, payload FROM (SELECT DISTINCT props AS payload FROM events)")
def g01(spark, sf):
    """Every payload is landed twice, in different batches."""
    def write(path: str) -> None:
        for _ in range(2):
            _cut(table(spark, sf, "events").select("props")).write.mode("append").text(path)

    out = scratch_path(spark, "g01")
    source = staged(spark, sf, "landing-raw", write)
    landing.land_raw(landing.payload_stream(spark, source, _half(spark, source)), out, f"{out}-state", drain=True).awaitTermination()
    return landing.read_raw(spark, out)


@query(
    "g02_stream_etl",
    f"""WITH {roles.RECEIPTS_SQL}, r AS (SELECT id, user_id, body, strftime("at", '%Y%m%d-%H%M%S') || '-txn-' || id || '-user-' || user_id || '.jsonl' AS file_name,
      CASE WHEN user_id = 7 THEN 'not a document of this schema' ELSE 'Invalid webhook: ' || nullif(concat_ws(', ', CASE WHEN id <= 0 THEN 'Invalid transaction ID' END,
        CASE WHEN user_id <= 0 THEN 'Invalid user ID' END, CASE WHEN trim(body) = '' THEN 'Empty receipt body' END), '') END AS why FROM rc)
    SELECT CASE WHEN user_id <> 7 THEN id END AS id, CASE WHEN why IS NULL THEN file_name END AS file_name,
      CASE WHEN why IS NULL THEN '{{"id":' || id || ',"user_id":' || user_id || ',"body":"' || body || '"}}' WHEN user_id = 7 THEN '{{"id": ' || id || ', "at"' END AS value,
      why AS reject_reason FROM r""",
)
def g02(spark, sf):
    out = scratch_path(spark, "g02")
    source = staged(spark, sf, "landing-receipts", lambda path: _cut(roles.receipt_lines(spark, sf)).write.text(path))
    events = landing.event_stream(spark, source, RECEIPT, _half(spark, source), text="refused_text")

    def transform(rows):
        return RECEIPTS.named(rows).withColumn("value", json_line(rows.select("id", "user_id", "body")))

    landing.land_events(events, RECEIPTS.flagged, transform, out, f"{out}-state", drain=True, text="refused_text").awaitTermination()
    valid = landing.read_landed(spark, out, "valid").select("id", "file_name", "value", REASON)
    refused = landing.read_landed(spark, out, "rejected")
    cut = F.col("refused_text").isNotNull()
    return valid.union(refused.select(F.when(~cut, F.col("id")), F.lit(None).cast("string"), "refused_text", REASON))


@query(
    "g03_stream_upsert",
    f"""WITH {roles.DESCRIPTIONS_SQL}, judged AS (SELECT *, concat_ws(', ', CASE WHEN trim(id) = '' THEN 'Empty product ID' END, CASE WHEN trim(title) = '' THEN 'Empty product title' END,
        CASE WHEN trim(description, chr(10)) = '' THEN 'Empty description' END, CASE WHEN NOT hid > 0 THEN 'Invalid hid' END,
        CASE WHEN NOT product_category_hid > 0 THEN 'Invalid product_category_hid' END) AS why FROM pd),
    counted AS (SELECT count(*) AS n_total, count(*) FILTER (WHERE why <> '') AS n_invalid, count(*) FILTER (WHERE why = '') AS good FROM judged)
    SELECT 'row' AS kind, id, title, hid, length(description) AS chars, CAST(32 AS BIGINT) AS n FROM judged WHERE why = ''
    UNION ALL SELECT 'reject', NULL, 'Invalid webhook: ' || replace(why, 'Empty description', 'Empty product description'), NULL, NULL, 2 * count(*) FROM judged WHERE why <> '' GROUP BY why
    UNION ALL SELECT 'report', NULL, unnest(['n_total', 'n_invalid', 'n_skipped', 'n_failed', 'n_embedded']), NULL, NULL, unnest([2 * n_total, 2 * n_invalid, good, 0, good]) FROM counted""",
)
def g03(spark, sf):
    """All events twice; the second stream finds every key stored. With the rejects and the summed counts of all batches."""
    path = scratch_path(spark, "g03")
    source = _landed(spark, sf, "landing-descriptions", roles.descriptions(spark, sf).drop("doc_id"))
    logs = [f"{path}-{attempt}" for attempt in ("first", "again")]
    for log in logs:
        events = landing.event_stream(spark, source, PRODUCT_DESCRIPTION, _half(spark, source), text="refused_text")
        landing.land_embeddings(
            events, DESCRIPTIONS, path, log, HashingEmbedder(32), f"{log}-state", drain=True, text="refused_text"
        ).awaitTermination()
    rows = spark.read.parquet(path).select(
        F.lit("row").alias("kind"), "id", "title", "hid", F.length("description").cast("bigint").alias("chars"), F.size("embedding").cast("bigint").alias("n")
    )
    nothing, none = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    refused = stack_frames([spark.read.parquet(f"{log}/rejects") for log in logs]).groupBy(REASON).count()
    names = ["n_total", "n_invalid", "n_skipped", "n_failed", "n_embedded"]
    counts = stack_frames([spark.read.parquet(f"{log}/report") for log in logs]).agg(*[F.sum(c).alias(c) for c in names])
    pairs = F.explode(F.create_map(*[x for c in names for x in (F.lit(c), F.col(c))])).alias("label", "n")
    return rows.union(refused.select(F.lit("reject"), nothing, REASON, none, none, "count")).union(
        counts.select(pairs).select(F.lit("report"), nothing, "label", none, none, "n")
    )


@query(
    "g04_stream_static_lookup",
    f"""WITH {roles.SPEAKERS_SQL} SELECT event_id, said, coalesce(email, said) AS speaker FROM (
      SELECT event_id, CASE WHEN event_type = 'view' THEN 'Guest ' || user_id ELSE 'sup ' || user_id END AS said FROM events)
    LEFT JOIN lk ON lookup_name = lower(said)""",
)
def g04(spark, sf):
    key = F.col("user_id").cast("string")
    said = F.when(F.col("event_type") == "view", F.concat(F.lit("Guest "), key)).otherwise(F.concat(F.lit("sup "), key))
    source = _landed(spark, sf, "landing-said", table(spark, sf, "events").select("event_id", said.alias("said")))
    out = scratch_path(spark, "g04")
    events = landing.event_stream(spark, source, "event_id bigint, said string", _half(spark, source))
    landing.land_resolved(
        events, "said", lambda session: roles.speakers(session, sf), "idx", out, f"{out}-state", drain=True
    ).awaitTermination()
    return spark.read.parquet(out).drop("batch")
