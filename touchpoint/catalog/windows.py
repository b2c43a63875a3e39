"""Running numbers and newest rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchpoint.catalog import roles
from touchpoint.catalog.registry import query
from touchpoint.catalog.roles import table
from touchpoint.catalog.scalars import LIST_ROWS_SQL
from touchpoint.functions.dates import same_weekday
from touchpoint.operators import keys
from touchpoint.operators.transcripts import number_messages
from touchpoint.plans.calls import flat_rows


@query("w01_line_sessionize", f"WITH {roles.LINES_SQL} SELECT conv_id, turn, pos - 1 AS pos, line, message_id FROM wl")
def w01(spark, sf):
    lines = roles.conversation_lines(spark, sf)
    numbered = number_messages(lines, "conv_id", ["turn", "pos"])
    return numbered.select("conv_id", "turn", F.col("pos").cast("bigint").alias("pos"), "line", "message_id")


@query(
    "w02_exploded_row_id",
    f"""{LIST_ROWS_SQL} SELECT id || '-' || lpad(CAST(n AS VARCHAR), 5, '0') AS id, CAST(id AS VARCHAR) AS recording_id
    FROM e WHERE url LIKE '%/calls/%'""",
)
def w02(spark, sf):
    return flat_rows(roles.list_calls(spark, sf)).valid.select("id", "recording_id")


@query(
    "w03_last_wins",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)
      AS r FROM orders) WHERE r = 1""",
)
def w03(spark, sf):
    newest = keys.latest_per_key(table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return newest.select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "w04_id_allocate",
    f"""WITH {roles.TRANSACTIONS_SQL} SELECT id AS old_id, (SELECT max(event_id) FROM events) + row_number() OVER (ORDER BY d, id) AS id
    FROM (SELECT id, md5('seed' || id) AS d FROM tx WHERE dayofweek("at") = dayofweek(DATE '2024-03-04') ORDER BY d, id LIMIT 7)""",
)
def w04(spark, sf):
    history = roles.transactions(spark, sf)
    matching = history.where(same_weekday(F.col("at"), F.lit("2024-03-04").cast("date")))
    drawn = keys.sample_rows(matching, "id", "seed", 7).select(F.col("id").alias("old_id"))
    digest = F.md5(F.concat(F.lit("seed"), F.col("old_id").cast("string")))
    return keys.allocate_ids(drawn, history, "id", [digest, F.col("old_id")])


@query(
    "w05_batch_number",
    """SELECT doc_id, source, CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 35 AS BIGINT) AS batch FROM documents""",
)
def w05(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "source")
    return keys.batch_numbers(rows, "source", ["doc_id"], 35)
