"""Validators: every row with the reason it is refused for, or null."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchpoint.catalog import roles
from touchpoint.catalog.registry import query
from touchpoint.catalog.roles import table, ts_text
from touchpoint.functions.dates import same_weekday
from touchpoint.functions.text import is_email, is_web_url
from touchpoint.operators import validate
from touchpoint.operators.validate import REASON, with_reason
from touchpoint.plans.attendees import REQUIRED


@query(
    "f01_valid_mention",
    """SELECT event_id, CASE WHEN event_type <> 'click' THEN 'Invalid webhook: ' || CASE event_type WHEN 'view' THEN '' ELSE 'mention_' || event_type END
      END AS reject_reason FROM events""",
)
def f01(spark, sf):
    kind = F.col("event_type")
    action = F.when(kind == "click", "mention_created").when(kind == "view", "").otherwise(F.concat(F.lit("mention_"), kind))
    events = table(spark, sf, "events").select("event_id", action.alias("action"))
    return validate.flag_mentions(events).select("event_id", REASON)


@query(
    "f02_valid_receipt",
    f"""WITH {roles.RECEIPTS_SQL} SELECT id, CASE WHEN r <> '' THEN 'Invalid webhook: ' || r END AS reject_reason FROM (
      SELECT id, concat_ws(', ', CASE WHEN id <= 0 THEN 'Invalid transaction ID' END, CASE WHEN user_id <= 0 THEN 'Invalid user ID' END,
        CASE WHEN trim(body) = '' THEN 'Empty receipt body' END) AS r FROM rc)""",
)
def f02(spark, sf):
    return with_reason(roles.receipts(spark, sf), validate.receipt_rules(), validate.INVALID).select("id", REASON)


@query(
    "f03_valid_product",
    f"""WITH {roles.PRODUCTS_SQL} SELECT id, CASE WHEN r <> '' THEN 'Invalid webhook: ' || r END AS reject_reason FROM (
      SELECT id, concat_ws(', ', CASE WHEN id <= 0 THEN 'Invalid product ID' END, CASE WHEN trim(title) = '' THEN 'Empty product title' END) AS r FROM pr)""",
)
def f03(spark, sf):
    return with_reason(roles.products(spark, sf), validate.product_rules(), validate.INVALID).select("id", REASON)


@query(
    "f04_valid_description",
    f"""WITH {roles.DESCRIPTIONS_SQL} SELECT doc_id, CASE WHEN r <> '' THEN 'Invalid webhook: ' || r END AS reject_reason FROM (
      SELECT doc_id, concat_ws(', ', CASE WHEN trim(id) = '' THEN 'Empty product ID' END, CASE WHEN trim(title) = '' THEN 'Empty product title' END,
        CASE WHEN trim(description, chr(10) || ' ') = '' THEN 'Empty product description' END, CASE WHEN hid <= 0 THEN 'Invalid hid' END,
        CASE WHEN product_category_hid <= 0 THEN 'Invalid product_category_hid' END) AS r FROM pd)""",
)
def f04(spark, sf):
    return with_reason(roles.descriptions(spark, sf), validate.description_rules(), validate.INVALID).select("doc_id", REASON)


@query(
    "f05_required_fields",
    """SELECT c_custkey, nullif(concat_ws(', ', CASE WHEN c_nationkey = 1 THEN 'source' END, CASE WHEN c_nationkey IN (2, 3) THEN 'event_url' END,
      CASE WHEN c_nationkey IN (3, 4) THEN 'created_at' END), '') AS reject_reason FROM customer""",
)
def f05(spark, sf):
    nation = F.col("c_nationkey")
    rows = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(nation == 5, "").when(nation != 1, F.col("c_mktsegment")).alias("source"),
        F.when(nation == 2, "").when(nation != 3, "https://ev.example").alias("event_url"),
        F.when(nation == 4, "yesterday").when(nation != 3, "2024-05-01T10:00:00Z").alias("created_at"),
    )
    return with_reason(rows, validate.required_rules(REQUIRED, ("event_url",))).select("c_custkey", REASON)


@query(
    "f06_text_present",
    """SELECT doc_id, CASE lang WHEN 'es' THEN 'empty text, length 3' WHEN 'de' THEN 'empty text, length 0' END AS reject_reason FROM documents""",
)
def f06(spark, sf):
    body = F.when(F.col("lang") == "es", " \t ").when(F.col("lang") != "de", F.col("text"))
    rows = table(spark, sf, "documents").select("doc_id", body.alias("body"))
    return with_reason(rows, validate.text_rules("body")).select("doc_id", REASON)


@query(
    "f07_email_url_valid",
    f"""WITH {roles.CONTACTS_SQL} SELECT email_address AS value, email_address LIKE 'user%+tag@mail.example.com' AS ok FROM ct
    UNION ALL SELECT url, url LIKE 'https://%' FROM ct UNION ALL SELECT url, true FROM pages""",
)
def f07(spark, sf):
    contacts = roles.contacts(spark, sf)
    mails = contacts.select(F.col("email_address").alias("value"), is_email(F.col("email_address")).alias("ok"))
    urls = contacts.select("url").union(table(spark, sf, "pages").select("url"))
    return mails.union(urls.select("url", is_web_url(F.col("url"))))


@query(
    "f08_speaker_valid",
    """SELECT s_suppkey AS idx, nullif(concat_ws(', ', CASE WHEN s_nationkey = 3 THEN 'name' END, CASE WHEN s_nationkey IN (3, 4) THEN 'email' END), '')
      AS reject_reason FROM supplier""",
)
def f08(spark, sf):
    rows = roles.speakers(spark, sf).join(
        table(spark, sf, "supplier").select(F.col("s_suppkey").alias("idx"), "s_nationkey"), "idx"
    )
    broken = rows.withColumns(
        {
            "name": F.when(F.col("s_nationkey") == 3, "  ").otherwise(F.col("name")),
            "email": F.when(F.col("s_nationkey").isin(3, 4), F.replace("email", F.lit("@"), F.lit(" at "))).otherwise(F.col("email")),
        }
    )
    return with_reason(broken, validate.speaker_rules()).select("idx", REASON)


@query(
    "f09_status_split",
    """SELECT event_id, CASE event_type WHEN 'error' THEN 'failed' ELSE 'successful' END AS outcome FROM events""",
)
def f09(spark, sf):
    status = F.when(F.col("event_type") != "error", 200)
    return table(spark, sf, "events").select("event_id", validate.status_split(status).alias("outcome"))


@query(
    "f10_weekday_match",
    f"""WITH {roles.TRANSACTIONS_SQL} SELECT id, amount, strftime("at", '%Y-%m-%d %H:%M:%S') AS "at" FROM tx
    WHERE dayofweek("at") = dayofweek(DATE '2024-03-04')""",
)
def f10(spark, sf):
    rows = roles.transactions(spark, sf).where(same_weekday(F.col("at"), F.lit("2024-03-04").cast("date")))
    return rows.select("id", "amount", ts_text(F.col("at")).alias("at"))
