"""Lookups, anti joins, alignment and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchpoint.catalog import roles
from touchpoint.catalog.registry import query
from touchpoint.catalog.roles import table
from touchpoint.operators import joins, keys
from touchpoint.operators.project import receipts_of

SAID_SQL = """(SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN upper('Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0'))
    WHEN 1 THEN 'sup ' || l_suppkey WHEN 2 THEN ' Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') || ' '
    ELSE 'Guest ' || l_suppkey END AS said FROM lineitem)"""


@query(
    "j01_alias_lookup",
    f"""WITH {roles.SPEAKERS_SQL} SELECT l_orderkey, l_linenumber, said, coalesce(email, said) AS speaker
    FROM {SAID_SQL} LEFT JOIN lk ON lookup_name = lower(said)""",
)
def j01(spark, sf):
    name = F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))
    key = F.col("l_suppkey").cast("string")
    case = F.col("l_linenumber") % 4
    said = (
        F.when(case == 0, F.upper(name))
        .when(case == 1, F.concat(F.lit("sup "), key))
        .when(case == 2, F.concat(F.lit(" "), name, F.lit(" ")))
        .otherwise(F.concat(F.lit("Guest "), key))
    )
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", said.alias("said"))
    return joins.resolve_names(rows, "said", roles.speakers(spark, sf), "idx", "speaker")


@query(
    "j02_new_keys_only",
    """SELECT doc_id, lang FROM documents WHERE doc_id <> 0 AND doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def j02(spark, sf):
    rows = table(spark, sf, "documents").select(F.nullif(F.col("doc_id"), F.lit(0)).alias("doc_id"), "lang")
    return keys.new_keys_only(rows, table(spark, sf, "labels"), "doc_id")


@query(
    "j03_resume_filter",
    """SELECT conv_id AS doc_id, turn FROM conversations WHERE conv_id NOT IN (SELECT doc_id FROM labels)""",
)
def j03(spark, sf):
    rows = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), "turn")
    return keys.resume(rows, table(spark, sf, "labels"), "doc_id")


@query(
    "j04_align_concat",
    """SELECT coalesce(d.doc_id, l.doc_id, p.page_id) AS doc_id, coalesce(d.lang, CAST(l.toxic AS VARCHAR)) AS lang, quality, url
    FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id
    FULL JOIN (SELECT page_id * 5 AS page_id, url FROM pages) p ON coalesce(d.doc_id, l.doc_id) = p.page_id""",
)
def j04(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang")
    labels = table(spark, sf, "labels").select("doc_id", "quality", F.col("toxic").cast("string").alias("lang"))
    pages = table(spark, sf, "pages").select((F.col("page_id") * 5).alias("doc_id"), "url")
    return joins.align_frames([documents, labels, pages]).select("doc_id", "lang", "quality", "url")


@query(
    "j06_receipt_join",
    f"""WITH {roles.TRANSACTIONS_SQL} SELECT id, 'Transaction: ' || description AS body, amount, description, user_id FROM tx""",
)
def j06(spark, sf):
    transactions = roles.transactions(spark, sf)
    return joins.pair_receipts(receipts_of(transactions).valid, transactions)


@query(
    "u01_union_frames",
    """SELECT doc_id, text, lang, CAST(NULL AS VARCHAR) AS url FROM documents
    UNION ALL SELECT item_id, text, NULL, NULL FROM benchmark UNION ALL SELECT page_id, html, NULL, url FROM pages""",
)
def u01(spark, sf):
    return joins.stack_frames(
        [
            table(spark, sf, "documents").select("doc_id", "text", "lang"),
            table(spark, sf, "benchmark").select("text", F.col("item_id").alias("doc_id")),
            table(spark, sf, "pages").select("url", F.col("page_id").alias("doc_id"), F.col("html").alias("text")),
        ]
    )


@query(
    "u02_key_difference",
    """SELECT user_id FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)""",
)
def u02(spark, sf):
    done = table(spark, sf, "supplier").where(F.col("s_acctbal") > 5000).select(F.col("s_suppkey").alias("user_id"))
    return keys.key_difference(table(spark, sf, "events").select("user_id"), done, "user_id")


@query("u03_ledger_union", "SELECT doc_id FROM labels UNION SELECT conv_id FROM conversations")
def u03(spark, sf):
    new = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"))
    return keys.key_union(table(spark, sf, "labels"), new, "doc_id")
