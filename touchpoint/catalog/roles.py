"""The given tables in the roles of touchpoint records: the same projection in Spark and in SQL.

Row numbers and remainders only vary the made-up fields (formats, names, broken values), so that
both good and bad records occur; no row of a table is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpoint.sources.tables import read_table, spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def ts_text(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss")


def _s(column: str) -> Column:
    return F.col(column).cast("string")


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _start(day: str, unit: str, number: str) -> Column:
    step = {"s": F.make_dt_interval(secs=F.col(number)), "h": F.make_dt_interval(hours=F.col(number).cast("int"))}
    return F.lit(day).cast("timestamp") + step[unit]


TRANSACTIONS_SQL = """tx AS (
  SELECT event_id AS id, CAST(round(value * 100) AS BIGINT) AS amount, ts AS "at", event_type AS description,
         user_id, user_id AS payer_id, event_id % 97 AS payee_id
  FROM events)"""


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.round(F.col("value") * 100).cast("bigint").alias("amount"),
        F.col("ts").alias("at"), F.col("event_type").alias("description"), "user_id",
        F.col("user_id").alias("payer_id"), (F.col("event_id") % 97).alias("payee_id"),
    )


RECEIPTS_SQL = """rc AS (
  SELECT event_id AS id, ts AS "at", user_id,
         CASE WHEN event_type = 'view' THEN '  ' ELSE 'Transaction: ' || event_type END AS body
  FROM events)"""


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts, some without a body; ids and users start at 0, which is not valid."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("ts").alias("at"), "user_id",
        F.when(F.col("event_type") == "view", "  ").otherwise(_text("Transaction: ", F.col("event_type"))).alias("body"),
    )


def receipt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts as JSON Lines; some lines are cut off, some are followed by a blank one."""
    rows = receipts(spark, sf_dir)
    good = F.to_json(F.struct(*rows.columns))
    cut = F.concat(F.lit('{"id": '), _s("id"), F.lit(', "at"'))
    return rows.select(F.when(F.col("user_id") == 7, cut).when(F.col("user_id") == 8, F.concat(good, F.lit("\n  "))).otherwise(good).alias("value"))



MENTIONS_SQL = """mn AS (
  SELECT doc_id, TIMESTAMP '2024-01-01' + to_seconds(doc_id * 4327) AS ts,
    'https://social.example/p/' || (n_chars % 400) AS url,
    CASE WHEN lang = 'de' THEN NULL ELSE source || ' / ' || lang END AS title, text AS body,
    CASE WHEN doc_id % 11 = 0 THEN 'not-a-date'
         WHEN doc_id % 2 = 0 THEN strftime(TIMESTAMP '2024-01-01' + to_seconds(doc_id * 4327), '%a %b %d %Y %H:%M:%S GMT+0000')
         ELSE strftime(TIMESTAMP '2024-01-01' + to_seconds(doc_id * 4327), '%Y-%m-%dT%H:%M:%S+00:00') END AS "timestamp",
    CAST(NULL AS VARCHAR) AS image_url, source, 'id_' || doc_id AS source_id,
    'Author ' || (n_chars % 50) || ' (x/y)!' AS author, CAST(NULL AS VARCHAR) AS author_avatar_url,
    'https://social.example/u/' || (n_chars % 50) AS author_profile_link,
    CASE WHEN n_chars > 1000 THEN 'high' ELSE 'low' END AS relevance_score,
    CASE WHEN n_chars % 19 = 0 THEN NULL ELSE 'chars ' || n_chars END AS relevance_comment,
    lang AS language, ' ' || upper(lang) || ' News, daily ' AS keyword,
    CASE WHEN n_chars % 3 = 0 THEN true WHEN n_chars % 3 = 1 THEN false END AS bookmarked
  FROM documents),
mv AS (
  SELECT * REPLACE (coalesce(bookmarked, false) AS bookmarked) FROM mn
  WHERE doc_id % 11 <> 0 AND relevance_comment IS NOT NULL)"""


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions as exported: timestamps as text in two formats, some unreadable, some fields missing."""
    at = _start("2024-01-01", "s", "_seconds")
    chars = F.col("n_chars")
    return (
        table(spark, sf_dir, "documents")
        .withColumn("_seconds", F.col("doc_id") * 4327)
        .select(
            _text("https://social.example/p/", (chars % 400).cast("string")).alias("url"),
            F.when(F.col("lang") != "de", _text(F.col("source"), " / ", F.col("lang"))).alias("title"),
            F.col("text").alias("body"),
            F.when(F.col("doc_id") % 11 == 0, "not-a-date")
            .when(F.col("doc_id") % 2 == 0, F.date_format(at, "EEE MMM dd yyyy HH:mm:ss 'GMT+0000'"))
            .otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
            .alias("timestamp"),
            F.lit(None).cast("string").alias("image_url"),
            "source",
            _text("id_", _s("doc_id")).alias("source_id"),
            _text("Author ", (chars % 50).cast("string"), " (x/y)!").alias("author"),
            F.lit(None).cast("string").alias("author_avatar_url"),
            _text("https://social.example/u/", (chars % 50).cast("string")).alias("author_profile_link"),
            F.when(chars > 1000, "high").otherwise("low").alias("relevance_score"),
            F.when(chars % 19 != 0, _text("chars ", _s("n_chars"))).alias("relevance_comment"),
            F.col("lang").alias("language"),
            _text(" ", F.upper("lang"), " News, daily ").alias("keyword"),
            F.when(chars % 3 == 0, True).when(chars % 3 == 1, False).alias("bookmarked"),
        )
    )


SPEAKERS_SQL = """sp AS (
  SELECT s_suppkey AS idx, s_name AS name, 'sup' || s_suppkey || '@n' || s_nationkey || '.example.com' AS email,
    CASE WHEN s_nationkey = 24 THEN NULL
         WHEN s_nationkey < 5 THEN ['SUP ' || s_suppkey, 'Supplier#' || lpad(CAST(s_suppkey - 1 AS VARCHAR), 9, '0')]
         ELSE ['SUP ' || s_suppkey] END AS aliases
  FROM supplier),
lk AS (
  SELECT lookup_name, email FROM (
    SELECT lower(n) AS lookup_name, email, row_number() OVER (PARTITION BY lower(n) ORDER BY idx DESC, place DESC) AS r
    FROM (SELECT idx, email, unnest(list_concat([name], coalesce(aliases, []))) AS n,
                 generate_subscripts(list_concat([name], coalesce(aliases, [])), 1) AS place FROM sp))
  WHERE r = 1)"""


def speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speakers with aliases; some aliases repeat another speaker's name."""
    before = _text("Supplier#", F.lpad((F.col("s_suppkey") - 1).cast("string"), 9, "0"))
    short = _text("SUP ", _s("s_suppkey"))
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("idx"), F.col("s_name").alias("name"),
        _text("sup", _s("s_suppkey"), "@n", _s("s_nationkey"), ".example.com").alias("email"),
        F.when(F.col("s_nationkey") == 24, F.lit(None))
        .when(F.col("s_nationkey") < 5, F.array(short, before))
        .otherwise(F.array(short))
        .alias("aliases"),
    )


CALLS_SQL = """dl AS (
  SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents),
dt AS (
  SELECT doc_id, string_agg(
    CASE WHEN i % 3 = 1 THEN
      CASE WHEN i <= 30 THEN lpad(CAST(i AS VARCHAR), 2, '0') || ':' || lpad(CAST(i * 7 % 60 AS VARCHAR), 2, '0')
           ELSE '1:' || lpad(CAST(i % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(i * 7 % 60 AS VARCHAR), 2, '0') END
      || ' - Supplier#' || lpad(CAST((doc_id * 7 + i) % 150 AS VARCHAR), 9, '0')
      || CASE WHEN i % 2 = 0 THEN ' (Org ' || lang || ')' ELSE '' END || chr(10)
    ELSE '' END
    || CASE WHEN i % 5 = 0 THEN 'ACTION ITEM: ' || line
            WHEN i % 7 = 0 THEN '- WATCH: https://rec.example/w/' || doc_id || '-' || i || ' ' || line
            ELSE line END, chr(10) ORDER BY i) AS plaintext
  FROM dl GROUP BY doc_id),
calls AS (
  SELECT doc_id AS id,
    CASE WHEN doc_id % 5 = 0 THEN 'https://rec.example/share/Ab_' || doc_id || '-x?tab=1'
         WHEN doc_id % 5 = 4 THEN 'https://rec.example/invalid/' || doc_id
         ELSE 'https://rec.example/calls/' || doc_id || '?t=5#frag' END AS url,
    CASE WHEN doc_id % 5 = 0 THEN 'Ab_' || doc_id || '-x' WHEN doc_id % 5 = 4 THEN NULL
         ELSE CAST(doc_id AS VARCHAR) END AS recording_id,
    'Weekly (' || source || '): ' || lang || '!' AS title,
    TIMESTAMP '2024-01-01' + to_hours(CAST(doc_id AS INTEGER)) AS date,
    CASE WHEN doc_id % 13 = 0 THEN 'nobody speaks yet' || chr(10) ELSE '' END || plaintext
      || CASE WHEN doc_id % 17 = 0 THEN chr(10) || '- WATCH: ftp://bad' ELSE '' END AS plaintext,
    n_chars
  FROM documents JOIN dt USING (doc_id)),
cl AS (
  SELECT id, recording_id, url, title, date, trim(unnest(string_split(plaintext, chr(10)))) AS line,
         generate_subscripts(string_split(plaintext, chr(10)), 1) AS n
  FROM calls),
hd AS (
  SELECT *, regexp_matches(line, '^([0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?)\\s+-\\s+(.+?)(?:\\s+\\(([^)]+)\\))?$') AS is_head,
    line LIKE 'ACTION ITEM:%' AS is_action, line LIKE '- WATCH:%' AS is_watch
  FROM cl WHERE line <> ''),
ms AS (
  SELECT *, CAST(sum(CAST(is_head AS INTEGER)) OVER (PARTITION BY id ORDER BY n) AS BIGINT) AS message_id,
    bool_or((is_watch AND NOT regexp_matches(line, '^- WATCH:\\s*https?://[^\\s]+')) ) OVER (PARTITION BY id) AS bad_watch,
    first_value(is_head) OVER (PARTITION BY id ORDER BY n) AS opens_with_head
  FROM hd)"""

MESSAGES_SQL = (
    CALLS_SQL
    + """,
am AS (
  SELECT id AS call_id, recording_id, message_id, url, title, date,
    max(CASE WHEN is_head THEN line END) AS header,
    coalesce(string_agg(CASE WHEN is_head OR is_action THEN NULL
      WHEN is_watch THEN nullif(trim(regexp_extract(line, '^- WATCH:\\s*(https?://[^\\s]+)(?:\\s+(.*))?', 2)), '')
      ELSE line END, ' ' ORDER BY n), '') AS message,
    arg_max(trim(substr(line, 13)), n) FILTER (WHERE is_action) AS action_item,
    arg_max(regexp_extract(line, '^- WATCH:\\s*(https?://[^\\s]+)', 1), n) FILTER (WHERE is_watch) AS watch_link
  FROM ms WHERE recording_id IS NOT NULL AND NOT bad_watch AND opens_with_head
  GROUP BY ALL),
ah AS (
  SELECT *, regexp_extract(header, '^([0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?)\\s+-\\s+(.+?)(?:\\s+\\(([^)]+)\\))?$', 1) AS off,
    trim(regexp_extract(header, '^([0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?)\\s+-\\s+(.+?)(?:\\s+\\(([^)]+)\\))?$', 2)) AS who
  FROM am)"""
)


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One call per document: its lines become speech under made-up headers.

    Some urls carry no recording id, some transcripts start without a speaker or end in a broken link.
    """
    def two(number: Column) -> Column:
        return F.lpad(number.cast("string"), 2, "0")

    def spoken(line: Column, i0: Column) -> Column:
        i = i0 + 1
        seconds = two(i * 7 % 60)
        offset = F.when(i <= 30, F.concat(two(i), F.lit(":"), seconds)).otherwise(
            F.concat(F.lit("1:"), two(i % 60), F.lit(":"), seconds)
        )
        who = _text(" - Supplier#", F.lpad(((F.col("doc_id") * 7 + i) % 150).cast("string"), 9, "0"))
        group = F.when(i % 2 == 0, _text(" (Org ", F.col("lang"), ")")).otherwise("")
        head = F.when(i % 3 == 1, F.concat(offset, who, group, F.lit("\n"))).otherwise("")
        link = _text("- WATCH: https://rec.example/w/", _s("doc_id"), "-", i.cast("string"), " ", line)
        content = F.when(i % 5 == 0, _text("ACTION ITEM: ", line)).when(i % 7 == 0, link).otherwise(line)
        return F.concat(head, content)

    doc = F.col("doc_id")
    return spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", "text")).select(
        doc.alias("id"),
        F.when(doc % 5 == 0, _text("https://rec.example/share/Ab_", _s("doc_id"), "-x?tab=1"))
        .when(doc % 5 == 4, _text("https://rec.example/invalid/", _s("doc_id")))
        .otherwise(_text("https://rec.example/calls/", _s("doc_id"), "?t=5#frag"))
        .alias("url"),
        _text("Weekly (", F.col("source"), "): ", F.col("lang"), "!").alias("title"),
        _start("2024-01-01", "h", "doc_id").alias("date"),
        F.concat(
            F.when(doc % 13 == 0, "nobody speaks yet\n").otherwise(""),
            F.array_join(F.transform(F.split("text", "\n"), spoken), "\n"),
            F.when(doc % 17 == 0, "\n- WATCH: ftp://bad").otherwise(""),
        ).alias("plaintext"),
        "n_chars",
    )


def call_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calls as nested events."""
    return calls(spark, sf_dir).select(
        "id",
        F.struct("url", (F.col("n_chars") / 60).alias("duration_in_minutes")).alias("recording"),
        F.struct(F.col("date").alias("scheduled_start_time"), "title").alias("meeting"),
        F.struct("plaintext").alias("transcript"),
    )


def call_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calls as posted JSON text; some are cut off, some come without their host."""
    call = calls(spark, sf_dir)
    host = F.when(F.col("id") % 23 != 6, F.struct(F.lit("h").alias("name"), F.lit("h@mail.example.com").alias("email"), F.lit("t").alias("team")))
    event = F.to_json(F.struct(
        "id", F.struct("url", (F.col("n_chars") / 60).alias("duration_in_minutes")).alias("recording"),
        F.struct(F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("scheduled_start_time"), "title").alias("meeting"),
        host.alias("fathom_user"), F.struct("plaintext").alias("transcript"),
    ))
    cut = F.concat(F.lit('{"id": '), _s("id"), F.lit(', "recording"'))
    return call.select(F.when(F.col("id") % 19 == 5, cut).otherwise(event).alias("payload"))


def speaker_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The speaker dimension as its one document, in the order of ``idx``: (file_name, value)."""
    listed = F.sort_array(F.collect_list(F.struct("idx", "name", "email", "aliases")))
    people = F.transform(listed, lambda x: F.struct(x["name"].alias("name"), x["email"].alias("email"), x["aliases"].alias("aliases")))
    return speakers(spark, sf_dir).agg(F.to_json(F.struct(people.alias("speakers_internal"))).alias("value")).select(F.lit("speakers.json").alias("file_name"), "value")


LIST_CALLS_SQL = """lc AS (
  SELECT p_partkey AS id, CASE WHEN p_size = 7 THEN 'https://rec.example/none' ELSE 'https://rec.example/calls/' || p_partkey END AS url,
    p_retailprice / 60 AS minutes, p_brand AS title, TIMESTAMP '2024-01-01' + to_hours(CAST(p_partkey AS INTEGER)) AS start_at,
    CASE WHEN p_size > 40 THEN NULL WHEN p_size < 4 THEN [] ELSE string_split(p_name || ' ' || p_type, ' ') END AS domains,
    CASE WHEN p_size > 45 THEN NULL WHEN p_size < 3 THEN [] ELSE string_split(p_name, ' ') END AS people
  FROM part)"""


def list_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One call per part with lists of domains and invitees, some of them null or empty."""
    domains = F.transform(F.split(F.concat_ws(" ", "p_name", "p_type"), " "), lambda w: F.struct(w.alias("domain_name")))
    people = F.transform(
        F.split("p_name", " "),
        lambda w: F.struct(
            w.alias("name"), F.concat(w, F.lit("@mail.example.com")).alias("email"), (w == "red").alias("is_external")
        ),
    )
    size = F.col("p_size")
    start = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("p_partkey").cast("int"))
    nothing = F.lit(None)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.struct(
            F.when(size == 7, "https://rec.example/none")
            .otherwise(_text("https://rec.example/calls/", _s("p_partkey")))
            .alias("url"),
            (F.col("p_retailprice") / 60).alias("duration_in_minutes"),
        ).alias("recording"),
        F.struct(
            start.alias("scheduled_start_time"),
            nothing.cast("timestamp").alias("scheduled_end_time"),
            nothing.cast("int").alias("scheduled_duration_in_minutes"),
            F.lit("https://join.example").alias("join_url"),
            F.col("p_brand").alias("title"),
            (size > 10).alias("has_external_invitees"),
            F.when(size > 40, nothing).when(size < 4, F.slice(domains, 1, 0)).otherwise(domains).alias("external_domains"),
            F.when(size > 45, nothing).when(size < 3, F.slice(people, 1, 0)).otherwise(people).alias("invitees"),
        ).alias("meeting"),
        F.struct(F.lit("host").alias("name"), F.lit("host@mail.example.com").alias("email"), F.lit("devx").alias("team")).alias(
            "fathom_user"
        ),
        F.struct(F.col("p_type").alias("plaintext")).alias("transcript"),
    )


LINES_SQL = """ln AS (
  SELECT conv_id, turn, unnest(string_split(txt, chr(10))) AS line, generate_subscripts(string_split(txt, chr(10)), 1) AS pos
  FROM (SELECT conv_id, turn, lpad(CAST(turn AS VARCHAR), 2, '0') || ':00 - ' || role || chr(10) || text AS txt FROM conversations)),
nl AS (
  SELECT *, regexp_matches(line, '^([0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?)\\s+-\\s+(.+?)(?:\\s+\\(([^)]+)\\))?$') AS is_head
  FROM ln WHERE trim(line) <> ''),
wl AS (
  SELECT *, CAST(sum(CAST(is_head AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY turn, pos) AS BIGINT) AS message_id FROM nl)"""


def conversation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as a line table: each turn is a header line and its text lines."""
    head = _text(F.lpad(_s("turn"), 2, "0"), ":00 - ", F.col("role"), "\n", F.col("text"))
    lines = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.posexplode(F.split(head, "\n")).alias("pos", "line")
    )
    return lines.where(F.trim("line") != "")


ATTENDEES_SQL = """att_all AS (
  SELECT c_custkey, c_nationkey % 5 AS g, c_custkey // 1000 AS b,
    c_name || ', ' || c_mktsegment || CASE WHEN c_custkey % 89 = 7 THEN repeat(' "so called", ', 400) ELSE '' END AS name,
    CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN 'desk' || (c_custkey // 40) || '@mail.example.com'
         ELSE lower(replace(c_name, '#', '.')) || '@mail.example.com' END AS email,
    CASE WHEN c_nationkey % 5 = 2 THEN NULL ELSE c_mktsegment END AS company,
    CASE WHEN c_nationkey % 5 = 3 THEN '20240405-legacy_' || (c_custkey // 1000)
         WHEN c_nationkey % 5 = 4 THEN 'undated_' || (c_custkey // 1000)
         ELSE '2024-0' || (c_nationkey % 5 + 1) || '-05-event_' || (c_custkey // 1000) END AS stem,
    CASE WHEN c_nationkey % 5 = 3 THEN TIMESTAMP '2024-04-05' WHEN c_nationkey % 5 = 4 THEN TIMESTAMP '2024-06-01'
         ELSE make_timestamp(2024, c_nationkey % 5 + 1, 5, 0, 0, 0) END AS created_at,
    CASE WHEN c_nationkey % 5 = 2 THEN 2 WHEN c_nationkey % 5 = 3 THEN 4 ELSE 3 END AS width, c_custkey % 97 = 5 AS ragged,
    CASE WHEN c_nationkey % 5 = 4 THEN 'event_url missing or empty in metadata file'
         WHEN c_nationkey % 5 = 3 AND c_custkey // 1000 % 2 = 1 THEN 'required metadata file not found' END AS no_url,
    'https://ev.example/' || (c_nationkey % 5) || '/' || (c_custkey // 1000) AS event_url
  FROM customer), att AS (
  SELECT *, CASE WHEN ragged THEN (width + 2) || ' cells under ' || width || ' columns' ELSE no_url END AS reason,
    row_number() OVER (PARTITION BY stem ORDER BY c_custkey) AS row_no FROM att_all)"""

#: Files of the attendee and mention folders that a scan passes over, with their content.
UNREAD_FILES = {"zero.csv": "", "_draft.csv": "name,email\nKa,k@x.com\n"}
UNREAD_SQL = """unread AS (SELECT * FROM (VALUES ('zero.csv', 'empty file'), ('_draft.csv', 'file names that start with _ or . are not read')) t(name, reason))"""

AS_OF = "2024-06-01"


def unread_files(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(UNREAD_FILES.items()), "file_name string, value string")


def _cell(text: Column) -> Column:
    """A quoted CSV cell."""
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def attendee_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files and sidecars of attendees: (file_name, value). A file holds at most 1000 customers.

    Some rows have two cells too many, some names thousands of characters with quotes and commas; a shared mail address
    makes records with equal object names and different content; one header has a line break in quotes.
    """
    key = F.col("c_custkey")
    g, b = F.col("c_nationkey") % 5, F.floor(key / 1000)
    said = F.when(key % 89 == 7, F.repeat(F.lit(' "so called", '), 400)).otherwise("")
    name = _cell(F.concat(F.col("c_name"), F.lit(", "), F.col("c_mktsegment"), said))
    mail = (
        F.when(key % 4 == 0, "")
        .when(key % 3 == 1, _text("desk", F.floor(key / 40).cast("string"), "@mail.example.com"))
        .otherwise(F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@mail.example.com")))
    )
    company = F.col("c_mktsegment")
    line = (
        F.when(g == 1, F.concat_ws(",", mail, name, company))
        .when(g == 2, F.concat_ws(",", name, mail))
        .when(g == 3, F.concat_ws(",", company, name, mail, F.lit("x")))
        .otherwise(F.concat_ws(",", name, mail, company))
    )
    line = F.when(key % 97 == 5, F.concat(line, F.lit(',"more, and",'))).otherwise(line)
    rows = table(spark, sf_dir, "customer").select(g.alias("g"), b.alias("b"), "c_custkey", line.alias("line"))
    grouped = rows.groupBy("g", "b").agg(F.sort_array(F.collect_list(F.struct("c_custkey", "line"))).alias("rows"))
    header = (
        F.when(F.col("g") == 1, "email,name,company")
        .when(F.col("g") == 2, "name,email")
        .when(F.col("g") == 3, 'company,name,email,"extra\ncell"')
        .otherwise("name,email,company")
    )
    stem = (
        F.when(F.col("g") == 3, _text("20240405-legacy_", _s("b")))
        .when(F.col("g") == 4, _text("undated_", _s("b")))
        .otherwise(_text("2024-0", (F.col("g") + 1).cast("string"), "-05-event_", _s("b")))
    )
    files = grouped.select(
        "g", "b", stem.alias("stem"), F.concat_ws("\n", header, F.array_join("rows.line", "\n")).alias("value")
    )
    url = F.when(F.col("g") == 4, "").otherwise(_text("https://ev.example/", _s("g"), "/", _s("b")))
    sidecars = files.where(~((F.col("g") == 3) & (F.col("b") % 2 == 1))).select(
        _text(F.col("stem"), ".json").alias("file_name"), F.to_json(F.struct(url.alias("event_url"))).alias("value")
    )
    return files.select(_text(F.col("stem"), ".csv").alias("file_name"), "value").union(sidecars).union(unread_files(spark))


def mention_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mention exports of at most 100 documents with whole texts, in two layouts; some rows have a cell too many."""
    doc = F.regexp_extract("source_id", "[0-9]+", 0).cast("bigint")
    rows = mentions(spark, sf_dir).withColumn("doc", doc)
    names = [c for c in rows.columns if c != "doc"]
    spelled = {"url": "URL", "title": "Title", "source_id": "Source ID", "author": "Author", "relevance_score": "Relevance Score"}
    cells = {c: F.when(F.col(c).isNull(), "").otherwise(_cell(_s(c))) for c in names}
    odd = F.floor(F.col("doc") / 100) % 2 == 1
    line = F.when(odd, F.concat_ws(",", *[cells[c] for c in reversed(names)])).otherwise(F.concat_ws(",", *cells.values()))
    line = F.when(F.col("doc") % 13 == 4, F.concat(line, F.lit(","))).otherwise(line)
    listed = rows.groupBy(F.floor(F.col("doc") / 100).alias("b")).agg(F.sort_array(F.collect_list(F.struct("doc", line.alias("line")))).alias("rows"))
    header = [spelled.get(c, c) for c in names]
    value = F.concat_ws("\n", F.when(F.col("b") % 2 == 1, ",".join(reversed(header))).otherwise(",".join(header)), F.array_join("rows.line", "\n"))
    named = _text("mentions-", F.lpad(_s("b"), 8, "0"), ".csv")
    return listed.select(named.alias("file_name"), value.alias("value")).union(unread_files(spark))


EXPORTS_SQL = """ex AS (
  SELECT item_id, text, 'Sync - ' || (item_id % 9) AS title,
    make_timestamp(CASE WHEN make_date(2026, item_id % 12 + 1, item_id % 28 + 1) > DATE '2026-08-02' THEN 2026 ELSE 2025 END,
      item_id % 12 + 1, item_id % 28 + 1, 0, 0, 0) AS date,
    CASE WHEN item_id % 6 = 5 THEN 0.0 ELSE CAST(item_id % 90 AS DOUBLE) END AS minutes,
    CASE WHEN item_id % 7 = 6 THEN NULL ELSE 'https://rec.example/calls/' || item_id END AS url
  FROM benchmark)"""

EXPORT_AS_OF = "2026-02-03"


def export_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text exports: (file_name, value); some have no recording line, some no readable duration."""
    item = F.col("item_id")
    day = F.make_date(F.lit(2025), item.cast("int") % 12 + 1, item.cast("int") % 28 + 1)
    first = _text("Sync - ", (item % 9).cast("string"), " - ", F.date_format(day, "MMMM d"))
    minutes = F.when(item % 6 == 5, "invalid").otherwise((item % 90).cast("string"))
    marker = F.when(item % 7 == 6, "no link here").otherwise(
        _text("VIEW RECORDING - ", minutes, " mins (No highlights): https://rec.example/calls/", _s("item_id"))
    )
    return table(spark, sf_dir, "benchmark").select(
        _text("call-", _s("item_id"), ".srt").alias("file_name"),
        F.concat_ws("\n", first, marker, F.lit(""), F.lit("---"), F.lit(""), F.lit("  "), F.col("text")).alias("value"),
    )


CONTACTS_SQL = """ct AS (
  SELECT c_custkey, 'First' || c_custkey AS first_name, c_name AS last_name,
    CASE WHEN c_nationkey = 7 THEN 'ftp://people.example/' || c_custkey ELSE 'https://people.example/in/' || c_custkey END AS url,
    CASE WHEN c_nationkey = 8 THEN 'nobody' || c_custkey WHEN c_nationkey = 9 THEN 'a..b@x.com' WHEN c_nationkey = 10 THEN 'u@host.local'
         ELSE 'user' || c_custkey || '+tag@mail.example.com' END AS email_address,
    c_mktsegment AS company, 'P' || c_nationkey AS position,
    CASE WHEN c_nationkey = 11 THEN '2024-01-15' WHEN c_nationkey = 12 THEN '29 Feb 2023'
         ELSE CAST(c_custkey % 28 + 1 AS VARCHAR) || ' ' || strftime(make_timestamp(2024, CAST(c_custkey % 12 + 1 AS INTEGER), 1, 0, 0, 0), '%b') || ' ' || (2000 + c_custkey % 24) END AS connected_on,
    CASE WHEN c_nationkey IN (11, 12) THEN NULL ELSE make_timestamp(CAST(2000 + c_custkey % 24 AS INTEGER), CAST(c_custkey % 12 + 1 AS INTEGER), CAST(c_custkey % 28 + 1 AS INTEGER), 0, 0, 0) END AS connected_at
  FROM customer)"""


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    month = F.date_format(F.make_date(F.lit(2024), key.cast("int") % 12 + 1, F.lit(1)), "MMM")
    good = F.concat_ws(" ", (key % 28 + 1).cast("string"), month, (key % 24 + 2000).cast("string"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        _text("First", _s("c_custkey")).alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.when(nation == 7, _text("ftp://people.example/", _s("c_custkey")))
        .otherwise(_text("https://people.example/in/", _s("c_custkey")))
        .alias("url"),
        F.when(nation == 8, _text("nobody", _s("c_custkey")))
        .when(nation == 9, "a..b@x.com")
        .when(nation == 10, "u@host.local")
        .otherwise(_text("user", _s("c_custkey"), "+tag@mail.example.com"))
        .alias("email_address"),
        F.col("c_mktsegment").alias("company"),
        _text("P", _s("c_nationkey")).alias("position"),
        F.when(nation == 11, "2024-01-15").when(nation == 12, "29 Feb 2023").otherwise(good).alias("connected_on"),
        F.lit("2024-06-01").cast("timestamp").alias("timestamp"),
    )


DESCRIPTIONS_SQL = """pd AS (
  SELECT CASE WHEN lang = 'es' THEN ' ' ELSE source END AS title,
    CASE WHEN n_chars % 23 = 0 THEN '' ELSE 'd' || doc_id END AS id, lang AS product_category_id, doc_id AS hid,
    n_chars % 5 AS product_category_hid, CASE WHEN lang = 'fr' THEN chr(10) ELSE text END AS description, doc_id
  FROM documents)"""


def descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.when(F.col("lang") == "es", " ").otherwise(F.col("source")).alias("title"),
        F.when(F.col("n_chars") % 23 == 0, "").otherwise(_text("d", _s("doc_id"))).alias("id"),
        F.col("lang").alias("product_category_id"), F.col("doc_id").alias("hid"),
        (F.col("n_chars") % 5).alias("product_category_hid"),
        F.when(F.col("lang") == "fr", "\n").otherwise(F.col("text")).alias("description"), "doc_id",
    )


PRODUCTS_SQL = "pr AS (SELECT p_partkey AS id, CASE WHEN p_size < 3 THEN ' ' ELSE p_name END AS title FROM part)"


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_size") < 3, " ").otherwise(F.col("p_name")).alias("title")
    )


USERS_SQL = """us AS (
  SELECT c_custkey AS id, c_name AS name, DATE '1950-01-01' + CAST(c_custkey * 37 % 20000 AS INTEGER) AS dob FROM customer)"""


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    born = F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") * 37 % 20000).cast("int"))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.date_format(born, "yyyy-MM-dd").alias("dob")
    )
