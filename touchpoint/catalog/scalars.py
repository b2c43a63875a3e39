"""Text, date, URL and transcript functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchpoint.catalog import roles
from touchpoint.catalog.registry import query, staged
from touchpoint.catalog.roles import table, ts_text
from touchpoint.functions import calls, dates, names, text
from touchpoint.operators.enrich import HashingEmbedder, embed_rows
from touchpoint.operators.exports import parse_exports
from touchpoint.operators.flatten import explode_lists
from touchpoint.operators.transcripts import call_lines
from touchpoint.plans.calls import flat_rows
from touchpoint.schemas import PRODUCT, with_embedding
from touchpoint.sinks.files import export_objects
from touchpoint.sources.files import read_exports

SANITIZED = "translate({}, ' /\\()[]{{}}<>|:,.!?''', '·__')"


def _sanitized(column: str) -> str:
    return SANITIZED.format(column)


@query("x01_sanitize", f"SELECT doc_id, {_sanitized('text')} AS clean FROM documents")
def x01(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.sanitize(F.col("text")).alias("clean"))


@query(
    "x02_clean_string",
    f"""SELECT p_partkey, {_sanitized("trim(lower(chr(9) || '  ' || p_name || ' (' || p_brand || ')! ' || chr(10)), chr(9) || chr(10) || ' ')")} AS clean
    FROM part""",
)
def x02(spark, sf):
    raw = F.concat(F.lit("\t  "), "p_name", F.lit(" ("), "p_brand", F.lit(")! \n"))
    return table(spark, sf, "part").select("p_partkey", text.clean_string(raw).alias("clean"))


@query("x03_stamp", "SELECT event_id, strftime(ts, '%Y_%m_%d_%H_%M_%S') AS stamp FROM events")
def x03(spark, sf):
    return table(spark, sf, "events").select("event_id", dates.stamp(F.col("ts")).alias("stamp"))


MENTION_NAME_SQL = (
    f"{_sanitized('trim(lower(source))')} || '-' || {_sanitized('trim(lower(keyword))')} || '-' || "
    f"strftime(ts, '%Y_%m_%d_%H_%M_%S') || '-' || {_sanitized('trim(lower(author))')} || '.jsonl'"
)


@query(
    "x04_name_mention",
    f"WITH {roles.MENTIONS_SQL} SELECT source_id, {MENTION_NAME_SQL} AS file_name FROM mn WHERE doc_id % 11 <> 0",
)
def x04(spark, sf):
    timed = roles.mentions(spark, sf).withColumn("at", dates.event_timestamp(F.col("timestamp")))
    name = names.mention_name(F.col("source"), F.col("keyword"), F.col("at"), F.col("author"))
    return timed.where(F.col("at").isNotNull()).select("source_id", name.alias("file_name"))


ATTENDEE_NAME_SQL = f"""lower(stem || '-' || strftime(created_at, '%Y%m%d')
  || coalesce('-' || {_sanitized("replace(coalesce(nullif(email, ''), nullif(name, '')), '@', '·')")}, '') || '.jsonl')"""


@query(
    "x05_name_attendee",
    f"""SELECT c_custkey, {ATTENDEE_NAME_SQL} AS file_name FROM (
      SELECT c_custkey, 'Fair_2024/' || c_mktsegment AS stem, DATE '2024-01-01' + CAST(c_custkey % 300 AS INTEGER) AS created_at,
        CASE WHEN c_nationkey < 5 THEN '' WHEN c_nationkey < 8 THEN NULL ELSE c_name || '+tag@Sub.example.com' END AS email,
        CASE WHEN c_nationkey IN (0, 5) THEN NULL WHEN c_nationkey = 1 THEN '' ELSE c_name END AS name FROM customer)""",
)
def x05(spark, sf):
    nation = F.col("c_nationkey")
    email = F.when(nation < 5, "").when(nation >= 8, F.concat("c_name", F.lit("+tag@Sub.example.com")))
    who = F.when(nation == 1, "").when(~nation.isin(0, 5), F.col("c_name"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 300).cast("int"))
    name = names.attendee_name(F.concat(F.lit("Fair_2024/"), "c_mktsegment"), day, email, who)
    return table(spark, sf, "customer").select("c_custkey", name.alias("file_name"))


@query(
    "x06_name_call",
    f"""WITH {roles.CALLS_SQL} SELECT id, strftime(date, '%Y_%m_%d_%H_%M_%S') || '-' || recording_id || '-'
      || {_sanitized('trim(lower(title))')} || '.jsonl' AS file_name FROM calls""",
)
def x06(spark, sf):
    name = names.call_name(F.col("date"), calls.recording_id(F.col("url")), F.col("title"))
    return roles.calls(spark, sf).select("id", name.alias("file_name"))


@query(
    "x07_name_txn_product",
    """SELECT strftime(ts, '%Y%m%d-%H%M%S') || '-txn-' || event_id || '-user-' || user_id || '.jsonl' AS file_name FROM events
    UNION ALL SELECT 'product-' || p_partkey || '.jsonl' FROM part""",
)
def x07(spark, sf):
    txn = names.transaction_name(F.col("at"), F.col("id"), F.col("user_id"))
    product = names.product_name(F.col("id"))
    return roles.transactions(spark, sf).select(txn.alias("file_name")).unionByName(
        roles.products(spark, sf).select(product.alias("file_name"))
    )


@query(
    "x08_recording_id",
    f"""WITH {roles.CALLS_SQL} SELECT url, recording_id FROM calls
    UNION ALL SELECT url, NULL FROM pages""",
)
def x08(spark, sf):
    urls = roles.calls(spark, sf).select("url").union(table(spark, sf, "pages").select("url"))
    return urls.select("url", calls.recording_id(F.col("url")).alias("recording_id"))


@query(
    "x09_offset_seconds",
    """SELECT event_id, off, CASE event_type WHEN 'click' THEN m * 60 + s WHEN 'view' THEN h * 3600 + m * 60 + s
        WHEN 'signup' THEN h * 3600 + m * 60 + s END AS seconds
    FROM (SELECT *, CASE event_type WHEN 'click' THEN lpad(CAST(m AS VARCHAR), 2, '0') || ':' || lpad(CAST(s AS VARCHAR), 2, '0')
          WHEN 'view' THEN h || ':' || lpad(CAST(m AS VARCHAR), 2, '0') || ':' || lpad(CAST(s AS VARCHAR), 2, '0')
          WHEN 'signup' THEN h || ':' || m || ':' || s || '.5' WHEN 'error' THEN CAST(s AS VARCHAR) ELSE '1:2:3:' || s END AS off
      FROM (SELECT event_id, event_type, event_id % 60 AS s, user_id % 60 AS m, event_id % 5 AS h FROM events))""",
)
def x09(spark, sf):
    s, m, h = (F.col("event_id") % 60).cast("string"), (F.col("user_id") % 60).cast("string"), (F.col("event_id") % 5).cast("string")
    kind = F.col("event_type")
    off = (
        F.when(kind == "click", F.concat_ws(":", F.lpad(m, 2, "0"), F.lpad(s, 2, "0")))
        .when(kind == "view", F.concat_ws(":", h, F.lpad(m, 2, "0"), F.lpad(s, 2, "0")))
        .when(kind == "signup", F.concat(F.concat_ws(":", h, m, s), F.lit(".5")))
        .when(kind == "error", s)
        .otherwise(F.concat(F.lit("1:2:3:"), s))
    )
    return table(spark, sf, "events").select("event_id", off.alias("off")).select(
        "event_id", "off", calls.offset_seconds(F.col("off")).cast("bigint").alias("seconds")
    )


@query(
    "x10_event_timestamp",
    f"""WITH {roles.MENTIONS_SQL} SELECT source_id, CASE WHEN doc_id % 11 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS at FROM mn""",
)
def x10(spark, sf):
    at = dates.event_timestamp(F.col("timestamp"))
    return roles.mentions(spark, sf).select("source_id", ts_text(at).alias("at"))


@query(
    "x11_filename_date",
    """SELECT o_orderkey, strftime(CASE o_orderkey % 4 WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate ELSE TIMESTAMP '2024-06-01' END,
      '%Y-%m-%d') AS day FROM orders""",
)
def x11(spark, sf):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    compact = F.date_format("o_orderdate", "yyyyMMdd")
    case = F.col("o_orderkey") % 4
    stem = (
        F.when(case == 0, F.concat(day, F.lit("-fair-of-"), "o_orderpriority"))
        .when(case == 1, F.concat(compact, F.lit("-meetup")))
        .when(case == 2, F.concat(F.lit("2024-13-45-"), compact))
        .otherwise(compact)
    )
    found = dates.filename_date(stem, F.lit(roles.AS_OF).cast("timestamp"))
    return table(spark, sf, "orders").select("o_orderkey", F.date_format(found, "yyyy-MM-dd").alias("day"))


@query(
    "x12_contact_date",
    f"""WITH {roles.CONTACTS_SQL} SELECT c_custkey, strftime(connected_at, '%Y-%m-%dT%H:%M:%S+00:00') AS connected_on FROM ct""",
)
def x12(spark, sf):
    parsed = dates.iso(dates.contact_date(F.col("connected_on")))
    return roles.contacts(spark, sf).select("c_custkey", parsed.alias("connected_on"))


@query(
    "x13_age",
    f"""WITH {roles.USERS_SQL} SELECT id, date_part('year', DATE '2024-02-28') - date_part('year', dob)
      - CASE WHEN strftime(dob, '%m%d') > '0228' THEN 1 ELSE 0 END AS age FROM us""",
)
def x13(spark, sf):
    aged = dates.age(F.to_date("dob"), F.lit("2024-02-28").cast("date"))
    return roles.users(spark, sf).select("id", aged.cast("bigint").alias("age"))


@query(
    "x14_restamp",
    """SELECT event_id, strftime(TIMESTAMP '2024-03-04' + (ts - date_trunc('day', ts)), '%Y-%m-%d %H:%M:%S.%f') AS at FROM events""",
)
def x14(spark, sf):
    at = dates.restamp(F.col("ts"), F.lit("2024-03-04"))
    return table(spark, sf, "events").select("event_id", F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"))


# Fixed value: the header pattern in the dialect of the checking SQL.
HEADER_RE2 = r"^([0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?)\s+-\s+(.+?)(?:\s+\(([^)]+)\))?$"


@query(
    "x15_line_header",
    f"""WITH {roles.CALLS_SQL} SELECT id, n, nullif(regexp_extract(line, '{HEADER_RE2}', 1), '') AS off,
      nullif(trim(regexp_extract(line, '{HEADER_RE2}', 2)), '') AS who, nullif(regexp_extract(line, '{HEADER_RE2}', 3), '') AS grp
    FROM (SELECT id, line, row_number() OVER (PARTITION BY id ORDER BY n) - 1 AS n FROM cl WHERE line <> '')""",
)
def x15(spark, sf):
    lines = call_lines(roles.calls(spark, sf), "id")
    parts = lines.select("id", F.col("n").cast("bigint").alias("n"), calls.header_parts(F.col("line")).alias("header"))
    return parts.select("id", "n", F.col("header.offset").alias("off"), F.col("header.speaker").alias("who"), F.col("header.group").alias("grp"))


@query(
    "x16_organization",
    f"""WITH {roles.CONTACTS_SQL} SELECT c_custkey,
      CASE WHEN email_address LIKE '%+tag@%' THEN split_part(email_address, '@', 2) END AS organization FROM ct""",
)
def x16(spark, sf):
    return roles.contacts(spark, sf).select("c_custkey", text.organization(F.col("email_address")).alias("organization"))


@query(
    "x17_action_item",
    f"""WITH {roles.CALLS_SQL} SELECT id, n, CASE WHEN line LIKE 'ACTION ITEM:%' THEN trim(substr(line, 13)) END AS action_item
    FROM (SELECT id, line, row_number() OVER (PARTITION BY id ORDER BY n) - 1 AS n FROM cl WHERE line <> '')""",
)
def x17(spark, sf):
    lines = call_lines(roles.calls(spark, sf), "id")
    return lines.select("id", F.col("n").cast("bigint").alias("n"), calls.action_item(F.col("line")).alias("action_item"))


@query(
    "x18_watch_link",
    rf"""WITH {roles.CALLS_SQL} SELECT id, n, nullif(regexp_extract(line, '^- WATCH:\s*(https?://[^\s]+)(?:\s+(.*))?', 1), '') AS link,
      nullif(trim(regexp_extract(line, '^- WATCH:\s*(https?://[^\s]+)(?:\s+(.*))?', 2)), '') AS rest,
      line LIKE '- WATCH:%' AND NOT regexp_matches(line, '^- WATCH:\s*https?://[^\s]+') AS bad
    FROM (SELECT id, line, row_number() OVER (PARTITION BY id ORDER BY n) - 1 AS n FROM cl WHERE line <> '')""",
)
def x18(spark, sf):
    lines = call_lines(roles.calls(spark, sf), "id")
    line = F.col("line")
    return lines.select(
        "id", F.col("n").cast("bigint").alias("n"), calls.watch_link(line).alias("link"),
        calls.watch_text(line).alias("rest"), calls.is_bad_watch(line).alias("bad"),
    )


def _exports(spark, sf):
    folder = staged(spark, sf, "exports", lambda path: export_objects(roles.export_files(spark, sf), path))
    return parse_exports(read_exports(spark, folder), roles.EXPORT_AS_OF)


@query(
    "x19_srt_header",
    f"WITH {roles.EXPORTS_SQL} SELECT url, title, minutes FROM ex WHERE url IS NOT NULL",
)
def x19(spark, sf):
    return _exports(spark, sf).valid.select("url", "title", F.col("duration_minutes").alias("minutes"))


@query(
    "x20_year_inference",
    f"WITH {roles.EXPORTS_SQL} SELECT 'call-' || item_id || '.srt' AS file_name, strftime(date, '%Y-%m-%d') AS day FROM ex",
)
def x20(spark, sf):
    parsed = _exports(spark, sf)
    both = parsed.valid.select("path", "date").unionByName(parsed.rejects.select("path", "date"))
    return both.select(F.substring_index("path", "/", -1).alias("file_name"), F.date_format("date", "yyyy-MM-dd").alias("day"))


@query("x21_transcript_body", f"WITH {roles.EXPORTS_SQL} SELECT item_id, text AS body FROM ex")
def x21(spark, sf):
    files = roles.export_files(spark, sf)
    return files.select(
        F.regexp_extract("file_name", "([0-9]+)", 1).cast("bigint").alias("item_id"),
        calls.transcript_body(F.col("value")).alias("body"),
    )


@query(
    "x22_bucket_names",
    """SELECT DISTINCT 'devx-' || source || '-' || lang AS bucket, replace('devx-' || source || '-' || lang, '-', '_') AS table_name,
      'gs://devx-' || source || '-' || lang AS url, replace('devx-' || source || '-' || lang, '-', '_') AS back FROM documents""",
)
def x22(spark, sf):
    bucket = F.concat_ws("-", F.lit("devx"), "source", "lang")
    url = text.bucket_url(bucket)
    return (
        table(spark, sf, "documents")
        .select(
            bucket.alias("bucket"), text.bucket_table_name(bucket).alias("table_name"), url.alias("url"),
            text.bucket_from_url(url).alias("back"),
        )
        .distinct()
    )


@query("x23_message_key", "SELECT conv_id, turn, conv_id || '-' || lpad(CAST(turn + 1 AS VARCHAR), 5, '0') AS id FROM conversations")
def x23(spark, sf):
    key = calls.message_key(F.col("conv_id").cast("string"), F.col("turn") + 1)
    return table(spark, sf, "conversations").select("conv_id", "turn", key.alias("id"))


LIST_ROWS_SQL = f"""WITH {roles.LIST_CALLS_SQL},
  e AS (
    SELECT id, url, minutes, title, start_at, d, p, row_number() OVER (PARTITION BY id ORDER BY di, pi) AS n FROM
      (SELECT id, url, minutes, title, start_at, people, unnest(CASE WHEN len(domains) > 0 THEN domains ELSE [NULL] END) AS d,
              generate_subscripts(CASE WHEN len(domains) > 0 THEN domains ELSE [NULL] END, 1) AS di FROM lc) x,
      LATERAL (SELECT unnest(CASE WHEN len(x.people) > 0 THEN x.people ELSE [NULL] END) AS p,
               generate_subscripts(CASE WHEN len(x.people) > 0 THEN x.people ELSE [NULL] END, 1) AS pi) y)"""


@query("x24_explode_lists", f"{LIST_ROWS_SQL} SELECT id, n, d AS domain_name, p AS invitee FROM e")
def x24(spark, sf):
    lists = roles.list_calls(spark, sf).select(
        "id", F.col("meeting.external_domains").alias("domains"), F.col("meeting.invitees").alias("people")
    )
    rows = explode_lists(lists, ["domains", "people"], "n")
    return rows.select(
        "id", F.col("n").cast("bigint").alias("n"), F.col("domains.domain_name").alias("domain_name"),
        F.col("people.name").alias("invitee"),
    )


@query(
    "x25_flat_null_list",
    f"""{LIST_ROWS_SQL} SELECT id || '-' || lpad(CAST(n AS VARCHAR), 5, '0') AS id, CAST(NULL AS VARCHAR) AS meeting_invitees,
      CAST(NULL AS VARCHAR) AS meeting_external_domains, p AS meeting_invitees_name, d AS meeting_external_domains_domain_name
    FROM e WHERE url LIKE '%/calls/%'""",
)
def x25(spark, sf):
    return flat_rows(roles.list_calls(spark, sf)).valid.select(
        "id", "meeting_invitees", "meeting_external_domains", "meeting_invitees_name", "meeting_external_domains_domain_name"
    )


@query(
    "x26_exclude_unset",
    f"""WITH {roles.PRODUCTS_SQL} SELECT id, title, CAST(NULL AS VARCHAR) AS note, CAST(64 AS BIGINT) AS dim FROM pr WHERE trim(title) <> ''""",
)
def x26(spark, sf):
    products = roles.products(spark, sf).where(~text.is_blank(F.col("title"))).select("title", "id")
    rows = embed_rows(products, "title", HashingEmbedder(64))
    stored = spark.createDataFrame([], with_embedding(f"{PRODUCT}, note string")).unionByName(rows, allowMissingColumns=True)
    return stored.select("id", "title", "note", F.size("embedding").cast("bigint").alias("dim"))
