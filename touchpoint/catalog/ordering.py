"""Sorted outputs, samples and pages. The limits are what these operators are for."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchpoint.catalog import roles
from touchpoint.catalog.registry import query
from touchpoint.catalog.roles import table
from touchpoint.functions.dates import same_weekday
from touchpoint.operators import keys


@query("l01_sorted_inputs", "SELECT source, doc_id FROM documents ORDER BY source, doc_id")
def l01(spark, sf):
    return table(spark, sf, "documents").select("source", "doc_id").orderBy("source", "doc_id")


@query(
    "l02_sample_k",
    f"""WITH {roles.TRANSACTIONS_SQL} SELECT id, amount FROM tx WHERE dayofweek("at") = dayofweek(DATE '2024-03-04')
    ORDER BY md5('draw' || id), id LIMIT 7""",
)
def l02(spark, sf):
    matching = roles.transactions(spark, sf).where(same_weekday(F.col("at"), F.lit("2024-03-04").cast("date")))
    return keys.sample_rows(matching, "id", "draw", 7).select("id", "amount")


@query("l03_limit_offset", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 200")
def l03(spark, sf):
    return keys.page(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), [F.col("o_orderkey")], 200, 100)


@query("l04_head_rows", "SELECT event_id, event_type FROM events ORDER BY ts, event_id LIMIT 50")
def l04(spark, sf):
    return keys.page(table(spark, sf, "events"), [F.col("ts"), F.col("event_id")], 0, 50).select("event_id", "event_type")
