"""File and table sources. Files are staged once per session from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchpoint.catalog import roles
from touchpoint.catalog.registry import query, staged
from touchpoint.catalog.roles import table
from touchpoint.functions.calls import transcript_body
from touchpoint.operators.joins import stack_frames
from touchpoint.operators.validate import REASON
from touchpoint.session import scratch_path
from touchpoint.sinks.files import export_objects
from touchpoint.sources import files, tables
from touchpoint.streaming import landing

ACCOUNT = "id bigint, name string, balance double"


def _string(column: str):
    return F.col(column).cast("string")


def _account_docs(spark, sf):
    """One JSON file per supplier (some broken, some with two documents) and a text file beside each."""
    def write(path: str) -> None:
        nation = F.col("s_nationkey")
        good = F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")))
        wrong_type = F.concat(F.lit('{"id": '), _string("s_suppkey"), F.lit(', "name": "n", "balance": "not_a_number"}'))
        no_name = F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")))
        value = (
            F.when(nation == 3, wrong_type)
            .when(nation == 4, no_name)
            .when(nation == 5, F.concat(good, F.lit("\n"), good))
            .when(nation == 6, F.concat(F.lit('{"id": '), _string("s_suppkey"), F.lit(', "name": 5, "balance": 1.5}')))
            .otherwise(good)
        )
        suppliers = table(spark, sf, "supplier")
        docs = suppliers.select(F.concat(F.lit("acc-"), _string("s_suppkey"), F.lit(".json")).alias("file_name"), value.alias("value"))
        notes = suppliers.select(F.concat(F.lit("acc-"), _string("s_suppkey"), F.lit(".txt")).alias("file_name"), F.col("s_name").alias("value"))
        deep = docs.select(F.concat(F.lit("deep/"), "file_name").alias("file_name"), "value")
        export_objects(docs.union(notes).union(deep), path)

    return staged(spark, sf, "account-docs", write)


@query(
    "s01_folder_scan",
    """SELECT 'acc-' || s_suppkey || '.txt' AS name, CAST(length(s_name) AS BIGINT) AS length FROM supplier""",
)
def s01(spark, sf):
    return files.list_folder(spark, _account_docs(spark, sf), [".txt", ".md"]).select("name", "length")


def _attendees(spark, sf):
    return staged(spark, sf, "attendees", lambda path: export_objects(roles.attendee_files(spark, sf), path))


@query(
    "s02_csv_folder_scan",
    f"""WITH {roles.ATTENDEES_SQL} SELECT stem || '.csv' AS _file, CASE WHEN NOT ragged THEN name END AS name, CASE WHEN NOT ragged THEN email END AS email,
      CASE WHEN NOT ragged THEN company END AS company, CASE WHEN g = 3 AND NOT ragged THEN 'x' END AS extra, CASE WHEN ragged THEN row_no END AS row_no,
      CASE WHEN ragged THEN reason END AS reject_reason FROM att""",
)
def s02(spark, sf):
    read = files.read_csv_rows(spark, _attendees(spark, sf))
    nothing = F.lit(None).cast("string")
    valid = read.valid.select("_file", "name", "email", "company", F.col("`extra\ncell`").alias("extra"), F.lit(None).cast("bigint").alias("row_no"), nothing.alias(REASON))
    return valid.union(read.rejects.select("_file", nothing, nothing, nothing, nothing, "row_no", REASON))


@query(
    "s03_csv_sidecar_join",
    f"""WITH {roles.ATTENDEES_SQL} SELECT stem || '.csv' AS _file, name, CASE WHEN no_url IS NULL THEN event_url END AS event_url,
      no_url AS reject_reason FROM att WHERE NOT ragged""",
)
def s03(spark, sf):
    folder = _attendees(spark, sf)
    checked = files.attach_sidecars(files.read_csv_folder(spark, folder), spark, folder)
    rejected = checked.rejects.select("_file", "name", F.lit(None).cast("string").alias("event_url"), REASON)
    return checked.valid.select("_file", "name", "event_url", F.lit(None).cast("string").alias(REASON)).union(rejected)


@query(
    "s04_json_doc_scan",
    """SELECT 'acc-' || s_suppkey || '.json' AS name, CASE WHEN s_nationkey NOT IN (3, 4, 5, 6) THEN s_acctbal END AS balance,
      CASE s_nationkey WHEN 3 THEN 'not a document of this schema' WHEN 4 THEN 'missing name' WHEN 6 THEN 'name is not a string'
        WHEN 5 THEN 'more than one JSON document in a file; read it as JSON Lines' END AS reject_reason FROM supplier""",
)
def s04(spark, sf):
    checked = files.read_json_docs(spark, _account_docs(spark, sf), ACCOUNT, [".json"], ("id", "name"))
    name = F.substring_index("_file", "/", -1).alias("name")
    valid = checked.valid.select(name, "balance", F.lit(None).cast("string").alias(REASON))
    return valid.union(checked.rejects.select(name, F.lit(None).cast("double"), REASON))


def _event_lines(spark, sf):
    """JSON Lines of all events; errors have no kind, some lines are broken or blank."""
    def write(path: str) -> None:
        good = F.to_json(F.struct(F.col("event_id").alias("id"), F.nullif("event_type", F.lit("error")).alias("kind"), "value", "props"))
        broken = F.concat(F.lit('{"id": '), _string("event_id"), F.lit(', "kind": '))
        line = F.when(F.col("user_id") == 7, broken).when(F.col("user_id") == 8, F.concat(good, F.lit("\n   "))).otherwise(good)
        table(spark, sf, "events").select(line.alias("value")).write.text(path)

    return staged(spark, sf, "event-lines", write)


@query(
    "s05_jsonl_scan",
    """SELECT event_id AS id, event_type AS kind, value, CAST(NULL AS VARCHAR) AS reject_reason, CAST(1 AS BIGINT) AS n FROM events
      WHERE user_id <> 7 AND event_type <> 'error'
    UNION ALL SELECT NULL, NULL, NULL, CASE WHEN user_id = 7 THEN 'not a document of this schema' ELSE 'missing kind' END AS r, count(*)
      FROM events WHERE user_id = 7 OR event_type = 'error' GROUP BY r""",
)
def s05(spark, sf):
    checked = files.read_json_lines(spark, _event_lines(spark, sf), "id bigint, kind string, value double", ("kind",))
    valid = checked.valid.select("id", "kind", "value", F.lit(None).cast("string").alias(REASON), F.lit(1).cast("bigint").alias("n"))
    counts = checked.rejects.groupBy(REASON).agg(F.count(F.lit(1)).alias("n"))
    nothing = F.lit(None)
    return valid.union(counts.select(nothing.cast("bigint"), nothing.cast("string"), nothing.cast("double"), REASON, "n"))


@query(
    "s06_json_text_scan",
    """SELECT event_id, CASE WHEN event_type NOT IN ('view', 'click') THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
      CASE event_type WHEN 'view' THEN 'empty document' WHEN 'click' THEN 'not a document of this schema' END
        AS reject_reason FROM events""",
)
def s06(spark, sf):
    payload = F.when(F.col("event_type") == "view", "").when(F.col("event_type") == "click", "{oops").otherwise(F.col("props"))
    rows = table(spark, sf, "events").select("event_id", payload.alias("payload"))
    checked = files.parse_json(rows, "payload", "k bigint", ("k",))
    valid = checked.valid.select("event_id", "k", F.lit(None).cast("string").alias(REASON))
    return valid.union(checked.rejects.select("event_id", F.lit(None).cast("bigint"), REASON))


@query(
    "s07_raw_compact_scan",
    """SELECT '{"page_id": ' || page_id || ',"url": "' || url || '","html": "' || replace(html, chr(10), '') || '"}' AS payload FROM pages""",
)
def s07(spark, sf):
    def write(path: str) -> None:
        pretty = F.concat(
            F.lit('{\n  "page_id": '), _string("page_id"), F.lit(',\r\n\t"url": "'), "url", F.lit('",\n   "html": "'),
            F.replace("html", F.lit("\n"), F.lit(" \n\t")), F.lit('"\n}\n'),
        )
        rows = table(spark, sf, "pages").select(F.concat(F.lit("p-"), _string("page_id"), F.lit(".json")).alias("file_name"), pretty.alias("value"))
        export_objects(rows, path)

    return files.read_compact_text(spark, staged(spark, sf, "pretty-pages", write), [".json"]).select("payload")


@query(
    "s08_csv_slice_scan",
    """SELECT CASE WHEN extra THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS id, CASE WHEN NOT extra THEN c_name END AS name,
      CASE WHEN NOT extra THEN c_mktsegment END AS segment, CASE WHEN extra THEN 2 * r + 2 END AS line_no, CASE WHEN extra THEN '4 cells under 3 columns' END AS reject_reason
    FROM (SELECT *, c_custkey % 31 = 6 AS extra, row_number() OVER (PARTITION BY c_custkey // 1000 ORDER BY c_custkey) AS r FROM customer) WHERE r <= 600""",
)
def s08(spark, sf):
    def write(path: str) -> None:
        more = F.when(F.col("c_custkey") % 31 == 6, ',"a, ""b"""').otherwise("")
        line = F.concat(F.concat_ws(",", _string("c_custkey"), F.concat(F.lit('"'), "c_name", F.lit('"')), "c_mktsegment"), more)
        rows = table(spark, sf, "customer").groupBy(F.floor(F.col("c_custkey") / 1000).alias("b")).agg(
            F.sort_array(F.collect_list(F.struct("c_custkey", line.alias("line")))).alias("rows")
        )
        value = F.concat(F.lit("exported by hand\n\nid,name,segment\n"), F.array_join("rows.line", "\n\n"))
        export_objects(rows.select(F.concat(F.lit("part-"), _string("b"), F.lit(".csv")).alias("file_name"), value.alias("value")), path)

    read = files.read_csv_slice(spark, staged(spark, sf, "sliced-csv", write), skip_rows=2, n_rows=600)
    nothing = F.lit(None).cast("string")
    valid = read.valid.select("id", "name", "segment", F.lit(None).cast("bigint").alias("line_no"), nothing.alias(REASON))
    return valid.union(read.rejects.select(nothing, nothing, nothing, "line_no", REASON))


def _user_csv(spark, sf):
    return staged(
        spark, sf, "users-csv",
        lambda path: roles.users(spark, sf).withColumn("code", F.lpad(_string("id"), 8, "0")).write.option("header", "true").csv(path),
    )


@query("s09_csv_strict_scan", f"WITH {roles.USERS_SQL} SELECT id, name, CAST(dob AS VARCHAR) AS dob FROM us")
def s09(spark, sf):
    rows = files.read_csv_strict(spark, _user_csv(spark, sf), "id bigint, name string, dob date, code string")
    return rows.select("id", "name", _string("dob").alias("dob"))


@query("s10_csv_typed_scan", "SELECT c_custkey AS id, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS code FROM customer")
def s10(spark, sf):
    return files.read_csv_columns(spark, _user_csv(spark, sf), "id bigint, name string, dob string, code string").select("id", "code")


@query(
    "s11_srt_scan",
    f"""WITH {roles.EXPORTS_SQL} SELECT 'call-' || item_id || '.srt' AS name, length(text) AS body_chars FROM ex""",
)
def s11(spark, sf):
    folder = staged(spark, sf, "exports", lambda path: export_objects(roles.export_files(spark, sf), path))
    exported = files.read_exports(spark, folder)
    return exported.select(
        F.substring_index("path", "/", -1).alias("name"), F.length(transcript_body(F.col("value"))).cast("bigint").alias("body_chars")
    )


@query(
    "s12_sql_table_scan",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderstatus = 'F'""",
)
def s12(spark, sf):
    recent = (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp")) & (F.col("o_orderstatus") == "F")
    return tables.read_table(spark, f"{sf}/orders.parquet", recent).select("o_orderkey", "o_custkey", "o_totalprice")


@query("s13_key_scan", "SELECT DISTINCT l_partkey FROM lineitem")
def s13(spark, sf):
    stored = tables.read_keys(spark, f"{sf}/lineitem.parquet", "l_partkey", "bigint")
    absent = tables.read_keys(spark, f"{sf}/no-such-table.parquet", "l_partkey", "bigint")
    return stack_frames([stored, absent])


@query(
    "s14_event_stream",
    """SELECT event_id AS id, value, props, CAST(NULL AS VARCHAR) AS refused_text FROM events WHERE user_id <> 7
    UNION ALL SELECT NULL, NULL, NULL, '{"id": ' || event_id || ', "kind": ' FROM events WHERE user_id = 7""",
)
def s14(spark, sf):
    out, checkpoint = scratch_path(spark, "s14-out"), scratch_path(spark, "s14-state")
    events = landing.event_stream(spark, _event_lines(spark, sf), "id bigint, kind string, value double, props string", text="refused_text")
    events.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()
    landed = spark.read.schema(events.schema).parquet(out)
    fields = [F.when(F.col("refused_text").isNull(), F.col(c)).alias(c) for c in ("id", "value", "props")]
    return landed.select(*fields, "refused_text")
