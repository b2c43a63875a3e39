"""Counts, distinct keys, message assembly, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchpoint.catalog import roles
from touchpoint.catalog.registry import query
from touchpoint.catalog.roles import table
from touchpoint.datasets import PRODUCTS
from touchpoint.operators import keys, reports
from touchpoint.operators.enrich import HashingEmbedder, RefusedText
from touchpoint.operators.transcripts import assemble_messages, number_messages
from touchpoint.plans.mentions import newest_per_url, typed
from touchpoint.plans.records import embed_upsert
from touchpoint.session import scratch_path


@query(
    "a01_counts_by_source",
    """WITH d AS (SELECT nullif(source, 'src3') AS source FROM documents)
    SELECT source, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_sources FROM d WHERE source IS NOT NULL GROUP BY source
    UNION ALL SELECT NULL, count(*), count(DISTINCT source) FROM d""",
)
def a01(spark, sf):
    rows = table(spark, sf, "documents").select(F.nullif("source", F.lit("src3")).alias("source"))
    return keys.counts_by_source(rows, "source")


@query(
    "a02_distinct_by_key",
    f"""WITH {roles.MENTIONS_SQL} SELECT url, source_id, body FROM (
      SELECT *, row_number() OVER (PARTITION BY url ORDER BY ts DESC, source_id) AS r FROM mv) WHERE r = 1""",
)
def a02(spark, sf):
    return newest_per_url(typed(roles.mentions(spark, sf)).valid).select("url", "source_id", "body")


@query("a03_max_id", "SELECT CASE WHEN coalesce(max(event_id), 0) = 0 THEN 1 ELSE max(event_id) + 1 END AS next_id FROM events")
def a03(spark, sf):
    return keys.next_id(table(spark, sf, "events"), "event_id")


@query("a04_key_set", "SELECT DISTINCT user_id FROM events")
def a04(spark, sf):
    return keys.key_set(table(spark, sf, "events"), "user_id")


@query(
    "a05_message_assembly",
    f"""WITH {roles.LINES_SQL} SELECT conv_id, message_id, max(CASE WHEN is_head THEN line END) AS header,
      coalesce(string_agg(CASE WHEN NOT is_head AND line NOT LIKE 'ACTION ITEM:%' THEN line END, ' ' ORDER BY turn, pos), '') AS message,
      CAST(NULL AS VARCHAR) AS action_item, CAST(NULL AS VARCHAR) AS watch_link
    FROM wl GROUP BY conv_id, message_id""",
)
def a05(spark, sf):
    numbered = number_messages(roles.conversation_lines(spark, sf), "conv_id", ["turn", "pos"])
    return assemble_messages(numbered, "conv_id", ["turn", "pos"])


class LimitedEmbedder(HashingEmbedder):
    """Refuses texts beyond a length, as the service does with too many tokens."""

    def __init__(self, dim: int, limit: int):
        super().__init__(dim)
        self.limit = limit

    def __call__(self, texts):
        if max(map(len, texts)) > self.limit:
            raise RefusedText("The input token count exceeds the limit")
        return super().__call__(texts)


@query(
    "a06_run_report",
    """SELECT count(*) AS n_total, count(*) FILTER (WHERE bad) AS n_invalid, count(*) FILTER (WHERE NOT bad AND known) AS n_skipped, CAST(0 AS BIGINT) AS n_repeated,
      count(*) FILTER (WHERE NOT bad AND NOT known AND big) AS n_failed, count(*) FILTER (WHERE NOT bad AND NOT known AND NOT big) AS n_embedded,
      CAST(ceil(count(*) FILTER (WHERE NOT bad AND NOT known) / 249.0) AS BIGINT) AS n_batches
    FROM (SELECT lang = 'es' OR doc_id <= 0 OR trim(text) = '' AS bad, doc_id IN (SELECT doc_id FROM labels) AS known, length(text) > 20000 AS big FROM documents)""",
)
def a06(spark, sf):
    """The report of an embedding run over all documents, some of which are stored already and some too long for the service."""
    path = scratch_path(spark, "a06")
    rows = table(spark, sf, "documents")
    stored = table(spark, sf, "labels").select("doc_id").distinct()
    empty = F.array().cast("array<float>")
    stored.select(F.lit(None).cast("string").alias("title"), F.col("doc_id").alias("id"), empty.alias("embedding")).write.parquet(path)
    title = F.when(F.col("lang") == "es", " ").otherwise(F.col("text"))
    records = rows.select(title.alias("title"), F.col("doc_id").alias("id"))
    report = embed_upsert(records, PRODUCTS, path, LimitedEmbedder(4, 20_000), 300).report
    return spark.createDataFrame([tuple(report.values())], ", ".join(f"{n} bigint" for n in report))


FAILURES = [
    "Table 'users' already exists in the database",
    "Table users was not found",
    "the number of un-indexed rows (12000) exceeds the maximum of 10000",
    "HTTP 429: Too many concurrent writes. Retry limit exceeded.",
    "Request timeout: connection timed out after 30s",
    "Retry Limit hit",
    "please retry later",
    "disk full",
    "number of un-indexed rows only",
]


@query(
    "a07_error_triage",
    f"""SELECT class, retryable, count(*) AS n FROM (SELECT
        CASE i WHEN 0 THEN 'EXISTS' WHEN 1 THEN 'NOT_FOUND' WHEN 2 THEN 'MAX_UNINDEXED_ROWS_EXCEEDED' WHEN 3 THEN 'RATE_LIMITED'
          WHEN 4 THEN 'TIMEOUT' WHEN 5 THEN 'RATE_LIMITED' ELSE CASE WHEN event_type = 'error' AND i = 7 THEN 'TIMEOUT' ELSE 'UNEXPECTED' END END AS class,
        i IN (3, 5, 6) AS retryable FROM (SELECT event_type, event_id % 9 AS i FROM events)) GROUP BY ALL""",
)
def a07(spark, sf):
    choice = F.get(F.array(*[F.lit(t) for t in FAILURES]), (F.col("event_id") % 9).cast("int"))
    late = (F.col("event_type") == "error") & (choice == "disk full")
    message = F.when(late, F.concat(choice, F.lit(" and Timed Out"))).otherwise(choice)
    log = table(spark, sf, "events").select(message.alias("message"))
    classed = log.select(
        reports.failure_class(F.col("message")).alias("class"), reports.is_retryable(F.col("message")).alias("retryable")
    )
    return classed.groupBy("class", "retryable").agg(F.count(F.lit(1)).alias("n"))
