import json
from datetime import datetime

import pytest

from touchpoint.datasets import PRODUCTS
from touchpoint.plans import calls, mentions, records
from touchpoint.sinks.files import export_objects, line_objects

MENTION = {
    "url": "https://s.example/1", "title": "T", "body": "b", "timestamp": "Mon Jan 15 2024 10:30:00 GMT+0000", "source": "Twitter",
    "sourceId": "t1", "author": "@jane doe", "relevanceScore": "high", "Relevance Comment": "c", "language": "en", "keyword": "data tools",
}


def payloads(spark, *events):
    return spark.createDataFrame([(e if isinstance(e, str) else json.dumps(e),) for e in events], "payload string")


def test_posted_mentions(spark):
    later = {**MENTION, "body": "later", "bookmarked": True}
    built = mentions.from_payloads(
        payloads(
            spark, {"data": MENTION}, {"action": "mention_created", "data": later}, {"action": "mention_deleted", "data": MENTION},
            {"data": {**MENTION, "timestamp": 5}}, {"data": {k: v for k, v in MENTION.items() if k != "body"}}, "{oops", {"action": "x"},
        ),
        "payload",
    )
    row = built.valid.first()
    assert built.valid.count() == 1 and row.file_name == "twitter-data·tools-2024_01_15_10_30_00-@jane·doe.jsonl"
    assert json.loads(row.value) == {
        "url": "https://s.example/1", "title": "T", "body": "later", "timestamp": "2024-01-15T10:30:00Z", "image_url": None,
        "source": "Twitter", "source_id": "t1", "author": "@jane doe", "author_avatar_url": None, "author_profile_link": None,
        "relevance_score": "high", "relevance_comment": "c", "language": "en", "keyword": "data tools", "bookmarked": True,
    }
    assert sorted(r.reject_reason for r in built.rejects.collect()) == [
        "Invalid webhook: mention_deleted", "body", "missing data", "not a document of this schema", "timestamp",
    ]


CALL = {
    "id": 5, "recording": {"url": "https://rec.example/calls/77?x=1", "duration_in_minutes": 12.5},
    "meeting": {
        "scheduled_start_time": "2024-03-05T08:07:09Z", "join_url": "j", "title": "Weekly: Sync!",
        "external_domains": [{"domain_name": "a.com"}, {"domain_name": "b.com"}],
        "invitees": [{"name": "Ann", "email": "ann@a.com", "is_external": True}, {"name": "Bo", "email": "bo@b.com", "is_external": False}],
    },
    "fathom_user": {"name": "h", "email": "h@x.com", "team": "t"},
    "transcript": {"plaintext": "00:01 - Ann\nhello\n00:05 - Bo (B Inc)\nhi\nACTION ITEM: call back"},
}


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(0, "Ann", "ann@a.com", [])], "idx int, name string, email string, aliases array<string>")


def test_posted_calls(spark, people, tmp_path):
    read = calls.read_events(payloads(spark, CALL, CALL, {k: v for k, v in CALL.items() if k != "meeting"}), "payload")
    assert [r.reject_reason for r in read.rejects.collect()] == ["missing meeting"]
    flat = calls.flat_rows(read.valid.limit(1)).valid.orderBy("id").collect()
    assert [(r.id, r.meeting_external_domains_domain_name, r.meeting_invitees_email) for r in flat] == [
        ("77-00001", "a.com", "ann@a.com"), ("77-00002", "a.com", "bo@b.com"), ("77-00003", "b.com", "ann@a.com"),
        ("77-00004", "b.com", "bo@b.com"),
    ]
    named = calls.named_messages(calls.messages(read.valid, people, "idx").valid)
    export_objects(line_objects(named), str(tmp_path))
    (path,) = tmp_path.iterdir()
    assert path.name == "2024_03_05_08_07_09-77-weekly·sync.jsonl"
    lines = [json.loads(line) for line in path.read_text().split("\n")]
    assert [(m["id"], m["timestamp"], m["speaker"], m["organization"], m["message"], m["action_item"]) for m in lines] == [
        ("77-00001", 1, "ann@a.com", "a.com", "hello", None), ("77-00002", 5, "Bo", None, "hi", "call back"),
    ]
    calls.run_messages(read.valid, people, "idx", str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out/messages")).where("file_name like '%-77-%'").count() == 4
    calls.run_flat(read.valid, str(tmp_path / "flat"))
    assert spark.read.json(str(tmp_path / "flat/calls")).count() == 8


def test_mention_exports(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    columns = ["URL", "Title", "body", "timestamp", "source", "Source ID", "author", "relevance_score", "relevance_comment", "language", "keyword"]

    def line(url, day, key):
        return f'{url},"a, ""b""",text,2024-01-{day}T00:00:00Z,reddit,{key},me,low,c,en,spark'

    (folder / "a.csv").write_text("\n".join([",".join(columns), line("u1", "02", "k2"), line("u1", "03", "k3"), line("u2", "01", "k1")]))
    (folder / "b.csv").write_text("\n".join([",".join(columns), line("u1", "03", "k0"), line("u2", "01", "k1"), line("u3", "99", "k9")]))
    mentions.run(spark, str(folder), str(tmp_path / "out"))
    rows = spark.read.json(str(tmp_path / "out/objects")).select("file_name", "data.*").orderBy("url").collect()
    assert [(r.url, r.source_id, r.title) for r in rows] == [("u1", "k0", 'a, "b"'), ("u2", "k1", 'a, "b"')]
    assert rows[0].file_name == "reddit-spark-2024_01_03_00_00_00-me.jsonl"
    assert [r.reject_reason for r in spark.read.json(str(tmp_path / "out/rejects")).collect()] == ["timestamp"]


def test_event_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, doc in {"a.json": {"id": 1, "title": "x"}, "b.json": {"id": 0, "title": "y"}, "c.json": {"title": "z"}}.items():
        (folder / name).write_text(json.dumps(doc, indent=2))
    records.run_events(spark, PRODUCTS, str(folder), str(tmp_path / "out"))
    assert [(r.file_name, r.id) for r in spark.read.json(str(tmp_path / "out/objects")).collect()] == [("product-1.jsonl", 1)]
    (folder / "_z.json").write_text("{}")
    records.run_events(spark, PRODUCTS, str(folder), str(tmp_path / "out"))
    assert sorted(r.reject_reason for r in spark.read.json(str(tmp_path / "out/rejects")).collect()) == [
        "Invalid webhook: Invalid product ID", "file names that start with _ or . are not read", "missing id",
    ]


def test_event_lines_are_read_once_with_numbers_and_counts(spark, tmp_path):
    lines = ['{"id": 1, "title": "x"}', "", '{"id": 2, "title": "old"}', "{oops", "   ", '{"id": 2, "title": "new"}', '{"id": 0, "title": "y"}']
    (tmp_path / "in.jsonl").write_text("\n".join(lines) + "\n")
    counts = records.run_event_lines(spark, PRODUCTS, str(tmp_path / "in.jsonl"), str(tmp_path / "out"))
    assert counts == {"valid": 3, "rejected": 2, "blank": 2}
    assert sorted((r.id, r.title) for r in spark.read.json(str(tmp_path / "out/objects")).collect()) == [(1, "x"), (2, "new")]
    rejects = spark.read.json(str(tmp_path / "out/rejects")).orderBy("line_no").collect()
    assert [(r.line_no, r.text if "text" in r else None, r.reject_reason) for r in rejects] == [
        (4, "{oops", "not a document of this schema"), (7, None, "Invalid webhook: Invalid product ID"),
    ]
    assert spark.read.json(str(tmp_path / "out/report")).first().asDict() == counts


def test_replay_appends_pairs(spark, tmp_path):
    history = spark.createDataFrame(
        [(i, i, datetime(2024, 1, 1, 5, i), f"d{i}", 1, 2, 3) for i in range(9)],
        "id long, amount long, at timestamp, description string, user_id long, payer_id long, payee_id long",
    )
    for _ in range(2):
        records.run_replay(history, "2024-03-04", 1, "s", 3, str(tmp_path / "t"), str(tmp_path / "r"))
    receipts = {(r.id, r.body) for r in spark.read.parquet(str(tmp_path / "r")).collect()}
    assert receipts == {(r.id, f"Transaction: {r.description}") for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert {i for i, _ in receipts} == {9, 10, 11}


def test_profiles_replace_the_table(spark, tmp_path):
    users = spark.createDataFrame([(1, "Ann", "2000-02-29"), (2, "Bo", "1990-01-01"), (3, "Cy", None)], "id int, name string, dob string")

    def client(row):
        return f" {row['name']}, {row['age']} " if row["id"] == 1 else ""

    for _ in range(2):
        records.run_profiles(users, "2023-02-28", str(tmp_path / "p"), client)
    rows = {r.id: r.bio for r in spark.read.parquet(str(tmp_path / "p")).collect()}
    assert rows == {1: "Ann, 22", 2: "Hi, I'm Bo. I enjoy exploring new experiences and connecting with others.", 3: None}
