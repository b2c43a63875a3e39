"""Projections: constants, alignment, spellings, defaults, events, flattening."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchpoint.catalog import roles
from touchpoint.catalog.registry import query, staged
from touchpoint.catalog.roles import table, ts_text
from touchpoint.operators import flatten, project
from touchpoint.operators.exports import export_events, parse_exports
from touchpoint.functions.text import row_identifier
from touchpoint.operators.validate import REASON
from touchpoint.plans.mentions import typed
from touchpoint.schemas import ATTENDEE
from touchpoint.sinks.files import export_objects
from touchpoint.sources.files import read_exports

# Fields too large to log, removed from a lookup's answer.
LARGE_FIELDS = [
    "fathom_call.llm_call_summary_general",
    "fathom_call.llm_call_summary_sales",
    "fathom_call.llm_call_summary_marketing",
    "fathom_call.llm_call_type",
    "fathom_call.llm_call_insights_sales",
    "fathom_call.transcript_plaintext_list",
]


@query(
    "p01_literal_columns",
    """SELECT c_custkey, c_name AS name, 'seg-' || c_mktsegment AS source, 'https://ev.example/' || c_mktsegment AS event_url,
      '2024-05-01 00:00:00' AS created_at FROM customer""",
)
def p01(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("source"))
    constants = {
        "event_url": F.concat(F.lit("https://ev.example/"), "source"),
        "source": F.concat(F.lit("seg-"), "source"),
        "created_at": F.lit("2024-05-01").cast("timestamp"),
    }
    return project.with_constants(rows, ATTENDEE, constants).withColumn("created_at", ts_text(F.col("created_at")))


@query(
    "p02_schema_align",
    """SELECT c_name AS name, CAST(NULL AS VARCHAR) AS email, c_mktsegment AS company, CAST(NULL AS VARCHAR) AS source,
      CAST(NULL AS VARCHAR) AS event_url, CAST(NULL AS VARCHAR) AS created_at FROM customer""",
)
def p02(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("company"), F.col("c_name").alias("name"))
    return project.align_schema(rows, ATTENDEE).withColumn("created_at", ts_text(F.col("created_at")))


@query(
    "p03_alias_resolve",
    f"""WITH {roles.MENTIONS_SQL} SELECT url, title, body, source_id, author, relevance_score, 'json' AS kind FROM mn
    UNION ALL SELECT url, title, body, source_id, author, relevance_score, 'table' FROM mn""",
)
def p03(spark, sf):
    mentions = roles.mentions(spark, sf)
    columns = ["url", "title", "body", "source_id", "author", "relevance_score"]
    exported = mentions.select(
        F.col("url").alias("URL"), F.col("title").alias("Title"), "body", F.lit("unused").alias("sourceId"),
        F.col("source_id").alias("Source ID"), F.col("author").alias("Author"), F.col("relevance_score").alias("relevanceScore"),
    )
    tabular = project.resolve_spellings(exported).select(*columns, F.lit("table").alias("kind"))
    by_parity = F.pmod(F.length("body"), F.lit(2)) == 0
    payload = F.to_json(
        F.struct(
            F.when(by_parity, F.col("url")).alias("url"), F.when(~by_parity, F.col("url")).alias("URL"),
            F.col("title").alias("Title"), F.col("body").alias("Body"), F.col("source_id").alias("sourceId"),
            "author", F.col("relevance_score").alias("Relevance Score"),
        )
    )
    spelled = project.spelled_fields(mentions.select(payload.alias("payload")), "payload")
    spelled = spelled.select(*columns, F.lit("json").alias("kind"))
    return tabular.unionByName(spelled)


@query(
    "p04_defaults",
    f"""WITH {roles.MENTIONS_SQL} SELECT source_id, coalesce(bookmarked, false) AS bookmarked, 'mention_created' AS action FROM mn
    UNION ALL SELECT 'e' || event_id, false, CASE event_type WHEN 'view' THEN 'mention_created' ELSE event_type END FROM events""",
)
def p04(spark, sf):
    mentions = project.event_defaults(project.mention_defaults(roles.mentions(spark, sf)))
    events = table(spark, sf, "events").select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("source_id"),
        F.nullif(F.col("event_type"), F.lit("view")).alias("action"),
    )
    columns = ["source_id", "bookmarked", "action"]
    return mentions.select(*columns).unionByName(project.mention_defaults(project.event_defaults(events)).select(*columns))


@query(
    "p05_wrap_event",
    f"""WITH {roles.MENTIONS_SQL} SELECT source_id,
      '{{"action":"mention_created","data":' || line || '}}' AS event, line
    FROM (SELECT source_id, CAST(json_object('url', url, 'title', title, 'body', body, 'timestamp',
        strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), 'image_url', image_url, 'source', source, 'source_id', source_id, 'author', author,
        'author_avatar_url', author_avatar_url, 'author_profile_link', author_profile_link, 'relevance_score', relevance_score,
        'relevance_comment', relevance_comment, 'language', language, 'keyword', keyword, 'bookmarked', bookmarked) AS VARCHAR) AS line
      FROM mv)""",
)
def p05(spark, sf):
    wrapped = project.wrap_event(typed(roles.mentions(spark, sf)).valid)
    lined = wrapped.withColumn("event", project.json_line(wrapped))
    return lined.select(
        F.col("data.source_id").alias("source_id"), "event", F.to_json("data", project.ISO_JSON).alias("line")
    )


@query(
    "p06_struct_flatten",
    f"""WITH {roles.LIST_CALLS_SQL} SELECT id, url AS recording_url, minutes AS recording_duration_in_minutes, title AS meeting_title,
      strftime(start_at, '%Y-%m-%d %H:%M:%S') AS meeting_scheduled_start_time, 'host' AS fathom_user_name FROM lc""",
)
def p06(spark, sf):
    flat = flatten.flatten_structs(roles.list_calls(spark, sf))
    return flat.select(
        "id", "recording_url", "recording_duration_in_minutes", "meeting_title",
        ts_text(F.col("meeting_scheduled_start_time")).alias("meeting_scheduled_start_time"), "fathom_user_name",
    )


@query(
    "p07_drop_columns_count",
    """SELECT doc_id, CAST(CASE WHEN lang = 'en' THEN 6 WHEN lang = 'de' THEN 2 ELSE 0 END AS BIGINT) AS removed,
       '{"fathom_call.id":"' || doc_id || '","note":"' || source || '","id":' || doc_id || ',"ok":true,"half":0.5,"none":null,"inner":{"a":' || doc_id || '},"list":[1,"x",false]}' AS kept FROM documents""",
)
def p07(spark, sf):
    def field(name: str, langs: list[str]):
        return F.when(F.col("lang").isin(*langs), F.col("text")).alias(name)

    large = [field(name, ["en", "de"] if i < 2 else ["en"]) for i, name in enumerate(LARGE_FIELDS)]
    payload = F.to_json(
        F.struct(F.col("doc_id").cast("string").alias("fathom_call.id"), *large, F.col("source").alias("note"))
    )
    typed = F.format_string(',"id":%d,"ok":true,"half":0.5,"none":null,"inner":{"a":%d},"list":[1,"x",false]}', "doc_id", "doc_id")
    payload = F.concat(F.substring(payload, F.lit(1), F.length(payload) - 1), typed)
    kept, removed = flatten.drop_json_keys(F.col("payload"), LARGE_FIELDS)
    answers = table(spark, sf, "documents").select("doc_id", payload.alias("payload"))
    return answers.select("doc_id", removed.cast("bigint").alias("removed"), kept.alias("kept"))


@query(
    "p08_iso_datetimes",
    """SELECT event_id, t AS at, t AS inner_at, 'x' AS inner_note, t || '|' || t0 AS listed FROM (
      SELECT event_id, strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%S+00:00') AS t0,
        strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN date_part('microsecond', ts) % 1000000 = 0 THEN ''
          ELSE '.' || lpad(CAST(date_part('microsecond', ts) % 1000000 AS VARCHAR), 6, '0') END || '+00:00' AS t FROM events)""",
)
def p08(spark, sf):
    nested = table(spark, sf, "events").select(
        "event_id", F.col("ts").alias("at"), F.struct(F.col("ts").alias("at"), F.lit("x").alias("note")).alias("inner"),
        F.array("ts", F.date_trunc("day", "ts")).alias("listed"),
    )
    return flatten.iso_datetimes(nested).select(
        "event_id", "at", F.col("inner.at").alias("inner_at"), F.col("inner.note").alias("inner_note"),
        F.array_join("listed", "|").alias("listed"),
    )


@query(
    "p09_row_identifier",
    """SELECT 'id=' || c_custkey AS label FROM customer
    UNION ALL SELECT CASE WHEN lang = 'de' THEN 'text=' || CASE WHEN length(text) > 50 THEN substr(text, 1, 50) || '...' ELSE text END
      ELSE 'title=' || source END FROM documents""",
)
def p09(spark, sf):
    keyed = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id"))
    plain = table(spark, sf, "documents").select(F.when(F.col("lang") != "de", F.col("source")).alias("title"), "text")
    return keyed.select(row_identifier(keyed.columns).alias("label")).union(
        plain.select(row_identifier(plain.columns).alias("label"))
    )


@query(
    "p10_receipt_projection",
    """SELECT CASE WHEN user_id NOT IN (7, 8) THEN event_id END AS id, CASE WHEN user_id NOT IN (7, 8) THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS "at",
      CASE WHEN user_id NOT IN (7, 8) THEN user_id END AS user_id, CASE WHEN user_id NOT IN (7, 8) THEN 'Transaction: ' || event_type END AS body,
      CASE user_id WHEN 7 THEN 'id' WHEN 8 THEN 'at, description' END AS reject_reason FROM events""",
)
def p10(spark, sf):
    rows = roles.transactions(spark, sf).withColumns({
        "id": F.when(F.col("user_id") == 7, "none").otherwise(F.col("id").cast("string")),
        "at": F.when(F.col("user_id") == 8, "some day").otherwise(F.col("at").cast("string")),
        "description": F.when(F.col("user_id") != 8, F.col("description")),
    })
    made = project.receipts_of(rows)
    good = made.valid.select("id", ts_text(F.col("at")).alias("at"), "user_id", "body", F.lit(None).cast("string").alias(REASON))
    nothing = F.lit(None)
    return good.union(made.rejects.select(nothing.cast("bigint"), nothing.cast("string"), nothing.cast("bigint"), nothing.cast("string"), REASON))


@query(
    "p11_call_from_srt",
    f"""WITH {roles.EXPORTS_SQL} SELECT url, title, strftime(date, '%Y-%m-%d %H:%M:%S') AS start_at, minutes, text AS plaintext,
      CAST(NULL AS BOOLEAN) AS external, 'backfill' AS join_url, CAST(NULL AS BIGINT) AS n_ids
    FROM ex WHERE url IS NOT NULL
    UNION ALL SELECT NULL, 'ids from 0 without gaps', NULL, NULL, NULL, NULL, NULL, count(*) FROM ex WHERE url IS NOT NULL""",
)
def p11(spark, sf):
    folder = staged(spark, sf, "exports", lambda path: export_objects(roles.export_files(spark, sf), path))
    parsed = parse_exports(read_exports(spark, folder), roles.EXPORT_AS_OF)
    events = export_events(parsed.valid, "backfill", "backfill@mail.example.com", "devx")
    gap_free = (F.min("id") == 0) & (F.max("id") == F.count_distinct("id") - 1)
    ids = events.agg(F.when(gap_free, F.count_distinct("id")).alias("n_ids"), F.lit("ids from 0 without gaps").alias("title"))
    rows = events.select(
        F.col("recording.url").alias("url"), F.col("meeting.title").alias("title"),
        ts_text(F.col("meeting.scheduled_start_time")).alias("start_at"),
        F.col("recording.duration_in_minutes").alias("minutes"), F.col("transcript.plaintext").alias("plaintext"),
        F.col("meeting.has_external_invitees").alias("external"), F.col("meeting.join_url").alias("join_url"),
    )
    return rows.unionByName(ids, allowMissingColumns=True)
