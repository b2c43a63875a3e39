from datetime import datetime

import pytest
from pyspark.sql import functions as F

from touchpoint.functions import names, text

SANITIZED = {
    "My Document (Final).txt": "My·Document·Finaltxt",
    "Windows\\Path/Mixed\\Separators": "Windows_Path_Mixed_Separators",
    "User's Guide: Version 2.0!": "Users·Guide·Version·20",
    " /\\()[]{}<>|:,.!?'": "·__",
    "hello  world": "hello··world",
    "test+file": "test+file",
    "Ünïcode – 名前": "Ünïcode·–·名前",
    "": "",
}


def test_sanitize(evaluate):
    assert evaluate(text.sanitize, SANITIZED) == list(SANITIZED.values())


def test_sanitize_long_text(evaluate):
    assert evaluate(text.sanitize, ["a b." * 2500]) == ["a·b" * 2500]


def test_clean_string(evaluate):
    cases = {"Hello World!": "hello·world", "  Test File (1).txt  ": "test·file·1txt", "": "", "  X\t\n": "x"}
    assert evaluate(text.clean_string, cases) == list(cases.values())


def test_every_blank_is_stripped(evaluate):
    blanks = [c for c in map(chr, range(0x3001)) if c.isspace()]
    assert evaluate(text.strip, [f"{c}x{c}" for c in blanks]) == ["x"] * len(blanks)
    assert sorted(blanks) == sorted(text.BLANKS)


@pytest.mark.parametrize(
    ("value", "valid"),
    [
        ("john.doe@example.com", True), ("user+tag@sub.domain.com", True), ("a@b", False), ("no-at.example.com", False),
        ("a..b@x.com", False), (".a@x.com", False), ("a@-x.com", False), ("a@x.local", False), ("a b@x.com", False),
        ("", False), (None, False), ("a@x.c0m", True), ("x" * 65 + "@x.com", False),
    ],
)
def test_email(evaluate, value, valid):
    assert evaluate(text.is_email, [value]) == [valid]


@pytest.mark.parametrize(
    ("value", "valid"),
    [
        ("https://www.example.com/in/jane", True), ("http://x", True), ("HTTP://x.com:8080/?q#f", True), ("ftp://x.com", False),
        ("not-a-url", False), ("https://", False), (None, False),
    ],
)
def test_web_url(evaluate, value, valid):
    assert evaluate(text.is_web_url, [value]) == [valid]


def test_organization(evaluate):
    assert evaluate(text.organization, ["jane@example.com", "Jane", ""]) == ["example.com", None, None]


def test_bucket_names(evaluate):
    assert evaluate(text.bucket_table_name, ["my-bucket-name"]) == ["my_bucket_name"]
    assert evaluate(text.bucket_url, ["my-bucket-name"]) == ["gs://my-bucket-name"]
    assert evaluate(text.bucket_from_url, ["gs://my-bucket-name", "a-b"]) == ["my_bucket_name", "a_b"]


def test_row_identifier(spark):
    def label(row, schema):
        df = spark.createDataFrame([row], schema)
        return df.select(text.row_identifier(df.columns).alias("x")).first()["x"]

    assert label(("a", 7), "name string, id int") == "id=7"
    assert label(("a", None), "name string, id int") == "id=None"
    assert label((None, "u1"), "name string, uuid string") == "uuid=u1"
    assert label((None, "y" * 60), "title string, note string") == "note=" + "y" * 50 + "..."
    assert label((None, None), "title string, note string") == "unknown_model"


ATTENDEES = [
    ("conference_2024", datetime(2024, 3, 15), "john.doe@example.com", "John", "conference_2024-20240315-johndoe·examplecom.jsonl"),
    ("webinar_2024", datetime(2024, 3, 15), None, "Jane Smith", "webinar_2024-20240315-jane·smith.jsonl"),
    ("webinar_2024", datetime(2024, 3, 15), "", "Jane Smith", "webinar_2024-20240315-jane·smith.jsonl"),
    ("anonymous_event", datetime(2024, 3, 15), None, None, "anonymous_event-20240315.jsonl"),
    ("anonymous_event", datetime(2024, 3, 15), "", "", "anonymous_event-20240315.jsonl"),
    ("special_event", datetime(2024, 3, 15), "user+tag@sub.domain.com", None, "special_event-20240315-user+tag·subdomaincom.jsonl"),
    ("test/source", datetime(2024, 3, 15), "a@b.co", None, "test/source-20240315-a·bco.jsonl"),
]


def test_attendee_names(spark):
    df = spark.createDataFrame([a[:4] for a in ATTENDEES], "source string, at timestamp, email string, name string")
    name = names.attendee_name(F.col("source"), F.col("at"), F.col("email"), F.col("name"))
    assert [r[0] for r in df.select(name).collect()] == [a[4] for a in ATTENDEES]


def test_other_names(spark):
    df = spark.createDataFrame(
        [("Twitter", "Data Tools", datetime(2024, 1, 15, 10, 30), "@some one!", "123", 5, 9)],
        "source string, keyword string, at timestamp, author string, rec string, id int, user int",
    )
    row = df.select(
        names.mention_name(F.col("source"), F.col("keyword"), F.col("at"), F.col("author")).alias("mention"),
        names.call_name(F.col("at"), F.col("rec"), F.lit("")).alias("call"),
        names.transaction_name(F.col("at"), F.col("id"), F.col("user")).alias("txn"),
        names.product_name(F.col("id")).alias("product"),
    ).first()
    assert row.mention == "twitter-data·tools-2024_01_15_10_30_00-@some·one.jsonl"
    assert row.call == "2024_01_15_10_30_00-123-.jsonl"
    assert row.txn == "20240115-103000-txn-5-user-9.jsonl"
    assert row["product"] == "product-5.jsonl"
