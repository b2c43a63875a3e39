"""Writers: each query writes through the sink and returns what reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchpoint.catalog import roles
from touchpoint.catalog.registry import query, staged
from touchpoint.catalog.roles import table, ts_text
from touchpoint.catalog.scalars import MENTION_NAME_SQL
from touchpoint.functions.dates import event_timestamp
from touchpoint.functions.names import mention_name
from touchpoint.operators.project import align_schema, mention_defaults, warehouse_rows
from touchpoint.operators.validate import REASON, required_rules, with_reason
from touchpoint.plans.mentions import typed
from touchpoint.plans.records import profiles
from touchpoint.schemas import ATTENDEE, MENTION_TABLE
from touchpoint.session import scratch_path
from touchpoint.sinks import files, tables
from touchpoint.sources.files import POSITION, read_csv_folder


@query(
    "k01_keyed_jsonl_sink",
    f"""WITH {roles.MENTIONS_SQL}, named AS (SELECT *, {MENTION_NAME_SQL} AS file_name FROM (
        SELECT * REPLACE (TIMESTAMP '2024-01-01' + to_days(CAST(length(body) % 20 AS INTEGER)) AS ts) FROM mv WHERE doc_id % 13 <> 4))
    SELECT file_name, source, source_id, body FROM (
      SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY doc_id DESC) AS r FROM named) WHERE r = 1""",
)
def k01(spark, sf):
    """Records with equal names: the later row of the later file is kept, whatever its content."""
    at = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(days=F.length("body") % 20)
    folder = staged(spark, sf, "mention-exports", lambda path: files.export_objects(roles.mention_files(spark, sf), path))
    mentions = typed(read_csv_folder(spark, folder)).valid
    name = mention_name(F.col("source"), F.col("keyword"), at, F.col("author"))
    path = scratch_path(spark, "k01")
    named = mentions.select("source", "source_id", "body", name.alias("file_name"), POSITION)
    files.write_keyed_json(files.newest_objects(named, [F.desc(POSITION)]).drop(POSITION), path, ["source"])
    return spark.read.schema("file_name string, source string, source_id string, body string").json(path)


@query("k02_raw_sink", "SELECT DISTINCT sha256(props) AS object_key, props AS payload FROM events")
def k02(spark, sf):
    path = scratch_path(spark, "k02")
    events = table(spark, sf, "events")
    files.append_raw(events.where(F.col("event_type") != "error"), path, "props")
    files.append_raw(events, path, "props")
    return spark.read.parquet(path)


@query(
    "k03_destination_router",
    """SELECT source AS bucket, 'gs://' || source AS cloud_url, true AS cloud, '/out/' || source AS local_tail, count(*) AS n
    FROM documents GROUP BY source""",
)
def k03(spark, sf):
    cloud, local = files.Destination.parse("gcs"), files.Destination.parse("local")
    tail = local.url("").removeprefix(local.url("").rsplit("/out/", 1)[0])
    counted = table(spark, sf, "documents").groupBy(F.col("source").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        "bucket", F.concat(F.lit(cloud.url("")), "bucket").alias("cloud_url"), F.lit(files.is_cloud(cloud.url(""))).alias("cloud"),
        F.concat(F.lit(tail), "bucket").alias("local_tail"), "n",
    )


@query(
    "k04_aggregate_csv",
    """SELECT c_name || ', "' || c_mktsegment || '"' AS name, CAST(NULL AS VARCHAR) AS email, c_mktsegment AS company,
      'n' || c_nationkey AS source, 'https://ev.example' AS event_url FROM customer""",
)
def k04(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("name"), F.col("c_mktsegment").alias("company"),
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("source"), F.lit("https://ev.example").alias("event_url"),
    )
    path = scratch_path(spark, "k04")
    files.write_csv(align_schema(rows, ATTENDEE), path)
    return spark.read.options(header="true", escape='"').csv(path).drop("created_at")


@query(
    "k05_upsert",
    """SELECT coalesce(o.o_custkey, s.s_suppkey) AS id, coalesce(o.label, s.s_name) AS label FROM supplier s FULL JOIN (
      SELECT o_custkey, 'order ' || o_orderkey AS label, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r
      FROM orders) o ON o.o_custkey = s.s_suppkey WHERE coalesce(r, 1) = 1""",
)
def k05(spark, sf):
    path = scratch_path(spark, "k05")
    first = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("label"))
    label = F.concat(F.lit("order "), F.col("o_orderkey").cast("string"))
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), label.alias("label"), "o_orderdate", "o_orderkey")
    nothing = {c: F.lit(None).cast(orders.schema[c].dataType) for c in ("o_orderdate", "o_orderkey")}
    tables.upsert_rows(first.withColumns(nothing), path, "id", [F.col("label")], 4)
    for _ in range(2):
        tables.upsert_rows(orders, path, "id", [F.desc("o_orderdate"), F.desc("o_orderkey")], 4)
    return tables.read_upserted(spark, path).select("id", "label")


@query(
    "k06_sql_append",
    f"""WITH {roles.TRANSACTIONS_SQL} SELECT id, amount, strftime("at", '%Y-%m-%d %H:%M:%S') AS "at", description FROM tx""",
)
def k06(spark, sf):
    path = scratch_path(spark, "k06")
    rows = roles.transactions(spark, sf)
    for part in (F.col("description") == "purchase", F.col("description") != "purchase"):
        tables.append_rows(rows.where(part), path)
    return spark.read.parquet(path).select("id", "amount", ts_text(F.col("at")).alias("at"), "description")


@query(
    "k07_sql_replace",
    f"""WITH {roles.USERS_SQL} SELECT id, 'Hi, I''m ' || name || '. I enjoy exploring new experiences and connecting with others.' AS bio FROM us""",
)
def k07(spark, sf):
    path = scratch_path(spark, "k07")
    made = profiles(roles.users(spark, sf), "2024-02-28")
    tables.replace_table(made.where(F.length("bio") > 60), path)
    tables.replace_table(made, path)
    return spark.read.parquet(path)


@query(
    "k08_ledger_merge",
    """SELECT DISTINCT id FROM (SELECT CAST(doc_id AS VARCHAR) AS id FROM labels UNION ALL SELECT CAST(conv_id AS VARCHAR) FROM conversations)""",
)
def k08(spark, sf):
    ledger = tables.Ledger(spark, scratch_path(spark, "k08"), "id")
    ledger.add(table(spark, sf, "labels").select(F.col("doc_id").alias("id")))
    for _ in range(2):
        ledger.add(table(spark, sf, "conversations").select(F.col("conv_id").alias("id")))
    return ledger.export()


@query(
    "k09_dimension_publish",
    f"""WITH {roles.SPEAKERS_SQL} SELECT idx, name, email, CAST(coalesce(len(aliases), 0) AS BIGINT) AS n_aliases FROM sp""",
)
def k09(spark, sf):
    path = scratch_path(spark, "k09")
    tables.publish_speakers(roles.speakers(spark, sf), path)
    return spark.read.parquet(path).select(
        "idx", "name", "email", F.coalesce(F.size("aliases"), F.lit(0)).cast("bigint").alias("n_aliases")
    )


@query(
    "k10_warehouse_cast",
    f"""WITH {roles.MENTIONS_SQL} SELECT source_id, strftime(CASE WHEN doc_id % 11 <> 0 THEN ts END, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp",
      coalesce(bookmarked, false) AS bookmarked, title,
      nullif(concat_ws(', ', CASE WHEN doc_id % 11 = 0 THEN 'timestamp' END, CASE WHEN relevance_comment IS NULL THEN 'relevance_comment' END), '') AS reject_reason
    FROM mn""",
)
def k10(spark, sf):
    rows = mention_defaults(roles.mentions(spark, sf)).withColumn("timestamp", event_timestamp(F.col("timestamp")))
    flagged = with_reason(warehouse_rows(rows, MENTION_TABLE), required_rules(MENTION_TABLE))
    shown = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ssXXX")
    return flagged.select("source_id", shown.alias("timestamp"), "bookmarked", "title", REASON)
