from datetime import datetime

import pytest

from touchpoint import schemas
from touchpoint.datasets import DESCRIPTIONS, PRODUCTS, RECEIPTS
from touchpoint.operators import project, validate
from touchpoint.operators.validate import REASON
from touchpoint.plans.mentions import typed
from touchpoint.plans.records import contacts


def reasons(flagged):
    return [r[REASON] for r in flagged.collect()]


def test_mentions_by_action(spark):
    df = spark.createDataFrame([("mention_created",), ("mention_deleted",), ("",), (None,)], "action string")
    assert reasons(validate.flag_mentions(df)) == [
        None, "Invalid webhook: mention_deleted", "Invalid webhook: ", "Invalid webhook: ",
    ]


def test_record_rules(spark):
    at = datetime(2024, 1, 1)
    receipts = spark.createDataFrame([(1, at, 1, "x"), (0, at, -1, " \n"), (None, at, 1, None)], schemas.RECEIPT)
    assert reasons(RECEIPTS.flagged(receipts)) == [
        None, "Invalid webhook: Invalid transaction ID, Invalid user ID, Empty receipt body",
        "Invalid webhook: Invalid transaction ID, Empty receipt body",
    ]
    products = spark.createDataFrame([("t", 1), ("", 0)], schemas.PRODUCT)
    assert reasons(PRODUCTS.flagged(products)) == [None, "Invalid webhook: Invalid product ID, Empty product title"]
    descriptions = spark.createDataFrame(
        [("t", "i", "c", 1, 1, "d"), (" ", "", "c", 0, -2, "\t")], schemas.PRODUCT_DESCRIPTION
    )
    assert reasons(DESCRIPTIONS.flagged(descriptions)) == [
        None,
        "Invalid webhook: Empty product ID, Empty product title, Empty product description, Invalid hid, Invalid product_category_hid",
    ]


def test_good_rows_survive_bad_ones(spark):
    df = spark.createDataFrame([(1, "a"), (2, " "), (3, None)], "id int, body string")
    checked = validate.check(df, validate.text_rules("body"))
    assert [r.id for r in checked.valid.collect()] == [1]
    assert [(r.row_key, r[REASON]) for r in checked.rejects.orderBy("id").collect()] == [
        ("id=2", "empty text, length 1"), ("id=3", "empty text, length 0"),
    ]
    with pytest.raises(ValueError, match="id="):
        validate.strict(checked)
    assert validate.strict(validate.check(df.where("id = 1"), validate.text_rules("body"))).count() == 1


def test_speakers(spark):
    df = spark.createDataFrame(
        [("Al", "a@x.com", []), ("  ", "a@x.com", None), ("Al", "nope", []), (None, None, [])], schemas.SPEAKER
    )
    assert reasons(validate.with_reason(df, validate.speaker_rules())) == [None, "name", "email", "name, email"]


GOOD_CONTACT = ("John", "Doe", "https://p.example/in/j", "john@x.com", "Tech Corp", "Dev", "15 Jan 2024", datetime(2024, 1, 1))
CONTACT = schemas.CONTACT.replace("connected_on timestamp", "connected_on string")


@pytest.mark.parametrize(
    ("place", "value", "reason"),
    [(0, "", None), (0, None, "first_name"), (2, "not-a-url", "url"), (3, "not-an-email", "email_address"),
     (6, "29 Feb 2023", "connected_on"), (7, None, "timestamp")],
)
def test_contacts(spark, place, value, reason):
    row = list(GOOD_CONTACT)
    row[place] = value
    checked = contacts(spark.createDataFrame([row], CONTACT))
    assert [r[REASON] for r in checked.rejects.collect()] == ([reason] if reason else [])
    assert checked.valid.count() == (0 if reason else 1)


MENTION = {
    "URL": "https://s.example/1", "Title": "T", "body": "b", "Timestamp": "Mon Jan 15 2024 10:30:00 GMT+0000", "Source": "twitter",
    "sourceId": "t1", "author": "a", "relevance_score": "high", "relevanceComment": "c", "Language": "en", "keyword": "k",
}


def mentions(spark, **changes):
    row = {**MENTION, **changes}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"`{k}` string" for k in row))


def test_mention_spellings_and_defaults(spark):
    row = typed(mentions(spark)).valid.first()
    assert (row.url, row.source_id, row.timestamp, row.bookmarked, row.image_url) == (
        "https://s.example/1", "t1", datetime(2024, 1, 15, 10, 30), False, None,
    )


def test_first_spelling_present_wins(spark):
    both = project.resolve_spellings(mentions(spark, source_id="preferred", **{"Source ID": "second"}))
    assert both.first().source_id == "preferred"


@pytest.mark.parametrize("field", ["body", "Timestamp", "author", "keyword"])
def test_mention_requires_fields(spark, field):
    checked = typed(mentions(spark, **{field: None}))
    assert (checked.valid.count(), [r[REASON] for r in checked.rejects.collect()]) == (0, [field.lower()])
    assert typed(mentions(spark, author="")).valid.count() == 1


def test_unreadable_flag_is_refused(spark):
    checked = typed(mentions(spark, bookmarked="maybe"))
    assert [r[REASON] for r in checked.rejects.collect()] == ["bookmarked"]
    assert typed(mentions(spark, bookmarked="true")).valid.first().bookmarked is True
    assert "_readable" not in checked.rejects.columns


def test_wrapped_event_json(spark):
    wrapped = project.wrap_event(typed(mentions(spark)).valid.select("url", "title", "image_url", "timestamp", "bookmarked"))
    line = wrapped.select(project.json_line(wrapped).alias("v")).first().v
    assert line == (
        '{"action":"mention_created","data":{"url":"https://s.example/1","title":"T","image_url":null,'
        '"timestamp":"2024-01-15T10:30:00Z","bookmarked":false}}'
    )
    assert project.unwrap_event(wrapped).columns[0] == "url"


def test_json_spellings(spark):
    df = spark.createDataFrame([(1, '{"URL": "u", "Source ID": "s", "sourceId": "t", "Body": "b \\"q\\""}')], "n int, payload string")
    row = project.spelled_fields(df, "payload").first()
    assert (row.n, row.url, row.source_id, row.body, row.title) == (1, "u", "s", 'b "q"', None)


def test_event_defaults(spark):
    df = spark.createDataFrame([(None,), ("x",)], "action string")
    assert [r.action for r in project.event_defaults(df).collect()] == ["mention_created", "x"]
    assert project.event_defaults(spark.range(1)).first().action == "mention_created"


def test_constants_must_be_fields(spark):
    from pyspark.sql import functions as F

    with pytest.raises(ValueError, match="colour"):
        project.with_constants(spark.range(1), schemas.ATTENDEE, {"colour": F.lit(1)})


def test_warehouse_rows(spark):
    df = spark.createDataFrame([("1", "2.5", "x")], "message_id string, timestamp string, id string")
    rows = project.warehouse_rows(df, schemas.MESSAGE_TABLE)
    assert rows.columns == list(schemas.MESSAGE_TABLE)
    flagged = validate.with_reason(rows, validate.required_rules(schemas.MESSAGE_TABLE)).first()
    assert flagged.message_id == 1 and flagged[REASON] == "recording_id, url, title, date, timestamp, speaker, message"


def test_dropped_fields(spark):
    from pyspark.sql import functions as F

    from touchpoint.catalog.projections import LARGE_FIELDS
    from touchpoint.operators.flatten import drop_json_keys, drop_large

    df = spark.createDataFrame([(1, 2, 3)], f"id int, `{LARGE_FIELDS[0]}` int, `{LARGE_FIELDS[5]}` int")
    kept, count = drop_large(df, LARGE_FIELDS)
    assert (kept.columns, count) == (["id"], 2)
    assert drop_large(kept, LARGE_FIELDS)[1] == 0
    everything = "{" + ", ".join(f'"{f}": {{"a": 1}}' for f in LARGE_FIELDS) + ', "id": "7"}'
    payload, removed = drop_json_keys(F.col("v"), LARGE_FIELDS)
    row = spark.createDataFrame([(everything,)], "v string").select(payload.alias("p"), removed.alias("n")).first()
    assert (row.p, row.n) == ('{"id":"7"}', 6)


def test_vector_dimension(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],), (None,)], "v array<double>")
    from pyspark.sql import functions as F

    assert [r[0] for r in df.select(schemas.has_dimension(F.col("v"), 2)).collect()] == [True, False, True]
    assert schemas.with_embedding(schemas.PRODUCT).fieldNames() == ["title", "id", "embedding"]
