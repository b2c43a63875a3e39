from datetime import datetime

import pytest
from pyspark.sql import functions as F

from touchpoint.functions import calls
from touchpoint.operators import exports, transcripts
from touchpoint.operators.flatten import explode_lists, flatten_structs, iso_datetimes, keyed_rows
from touchpoint.operators.validate import REASON
from touchpoint.plans.calls import flat_rows


def test_recording_id(evaluate):
    cases = {
        "https://rec.example/calls/123456": "123456",
        "https://rec.example/calls/123456?tab=1#x": "123456",
        "https://rec.example/share/AbC123_-xyz": "AbC123_-xyz",
        "https://rec.example/calls/12345678901234567890": "12345678901234567890",
        "https://rec.example/calls/12ab": "12",
        "https://rec.example/calls/abc123": None,
        "https://rec.example/invalid/path": None,
        "https://rec.example/x/calls/1": None,
        "https://rec.example/": None,
        "": None,
    }
    assert evaluate(calls.recording_id, cases) == list(cases.values())


def test_offset_seconds(evaluate):
    cases = {"05:30": 330, "1:05:30": 3930, "1:05:30.5": 3930, "5": None, "1:2:3:4": None, "a:b": None, "00:00": 0}
    assert evaluate(calls.offset_seconds, cases) == list(cases.values())


def test_header(evaluate):
    line = ["05:30 - John Doe (Acme Corp)", "1:05:30 - Jane", "5:30 Jane", "05:30 - A (b) c", "said 05:30 - x"]
    assert evaluate(calls.is_header, line) == [True, True, False, True, False]
    assert evaluate(calls.header_speaker, line) == ["John Doe", "Jane", None, "A (b) c", None]
    assert evaluate(calls.header_group, line) == ["Acme Corp", None, None, None, None]


WATCH = {
    "- WATCH: https://e.com/w This is text": ("https://e.com/w", "This is text", False),
    "- WATCH: https://e.com/w   ": ("https://e.com/w", None, False),
    "- WATCH:https://e.com/w": ("https://e.com/w", None, False),
    "- WATCH: text only": (None, None, True),
    "- WATCH: ftp://e.com": (None, None, True),
    "- watch: https://e.com": (None, None, False),
    "WATCH: https://e.com": (None, None, False),
}


def test_watch_lines(evaluate):
    assert evaluate(calls.watch_link, WATCH) == [w[0] for w in WATCH.values()]
    assert evaluate(calls.watch_text, WATCH) == [w[1] for w in WATCH.values()]
    assert evaluate(calls.is_bad_watch, WATCH) == [w[2] for w in WATCH.values()]


def test_action_item(evaluate):
    assert evaluate(calls.action_item, ["ACTION ITEM:  Do it ", "ACTION ITEM:", "action item: x"]) == ["Do it", "", None]


def test_transcript_body(evaluate):
    cases = {
        "head\n---\n\n  \n  first\n\nlast\n": "  first\n\nlast\n",
        "head\n a --- b\nbody": "body",
        "no mark\nat all": "no mark\nat all",
        "head\n---": "",
        "head\n---\n\n": "",
    }
    assert evaluate(calls.transcript_body, cases) == list(cases.values())


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [
            (0, "John Doe", "old@example.com", ["JD"]),
            (1, "Jane Smith", "jane@example.com", ["J. Smith", "jd"]),
            (2, "john doe", "john@example.com", None),
        ],
        "idx int, name string, email string, aliases array<string>",
    )


def parse(spark, people, *texts, url="https://rec.example/calls/77"):
    rows = [(url, "T", datetime(2024, 1, 1), t) for t in texts]
    df = spark.createDataFrame(rows, "url string, title string, date timestamp, plaintext string")
    return transcripts.transcript_messages(df, people, "idx")


def test_messages(spark, people):
    text = "\n".join(
        [
            "", "05:30 - John Doe (Acme Corp)", "First message", "  ", "second line ", "10:45 - Jane Smith", "Second message",
            "ACTION ITEM: old", "ACTION ITEM: Do something", "- WATCH: https://e.com/1 see this", "- WATCH: https://e.com/2",
            "1:00:00 - Nobody",
        ]
    )
    rows = parse(spark, people, text).valid.orderBy("message_id").collect()
    assert [(r.id, r.timestamp, r.speaker, r.organization) for r in rows] == [
        ("77-00001", 330, "john@example.com", "example.com"), ("77-00002", 645, "jane@example.com", "example.com"),
        ("77-00003", 3600, "Nobody", None),
    ]
    assert [r.message for r in rows] == ["First message second line", "Second message see this", ""]
    assert (rows[1].action_item, rows[1].watch_link) == ("Do something", "https://e.com/2")


def test_refused_transcripts_keep_the_good_ones(spark, people):
    built = parse(spark, people, "text before\n05:30 - John Doe\nx", "05:30 - A\n- WATCH: nothing", "05:30 - A\nfine", "")
    assert [r.message for r in built.valid.collect()] == ["fine"]
    assert sorted(r[REASON] for r in built.rejects.collect()) == [transcripts.NO_SPEAKER, transcripts.BAD_WATCH]
    refused = parse(spark, people, "05:30 - A\nfine", url="https://rec.example/none")
    assert [r[REASON] for r in refused.rejects.collect()] == [transcripts.BAD_URL]
    assert refused.valid.count() == 0


def test_same_call_twice_does_not_interleave(spark, people):
    rows = parse(spark, people, "05:30 - A\none\n05:40 - B\ntwo", "05:30 - A\none\n05:40 - B\ntwo").valid.collect()
    assert sorted((r.id, r.message) for r in rows) == [("77-00001", "one")] * 2 + [("77-00002", "two")] * 2


def test_empty_speakers_are_an_error(spark, people):
    with pytest.raises(ValueError, match="empty"):
        parse(spark, people.where("false"), "05:30 - A\nx").valid.count()


def test_line_table_equals_in_row_parsing(spark):
    text = [f"{i // 60:02d}:{i % 60:02d} - S{i}\nline {i}\nACTION ITEM: a{i}\nmore {i}" for i in range(50)]
    whole = spark.createDataFrame([("k", "https://rec.example/calls/1", "\n".join(text))], "call string, url string, plaintext string")
    in_row = transcripts.explode_messages(transcripts.flag_transcripts(transcripts.with_lines(whole)))
    expected = {r.message_id: (r.header, r.m) for r in in_row.select("*", transcripts.message_fields(F.col("content"))["message"].alias("m")).collect()}
    lines = whole.select("call", F.posexplode(F.split("plaintext", "\n")).alias("pos", "line"))
    numbered = transcripts.number_messages(lines, "call", ["pos"])
    rows = transcripts.assemble_messages(numbered, "call", ["pos"]).collect()
    assert {r.message_id: (r.header, r.message) for r in rows} == expected
    assert {r.message_id: r.action_item for r in rows} == {i + 1: f"a{i}" for i in range(50)}


EXPORT = "Team Meeting - January 15\nVIEW RECORDING - 25 mins (No highlights): https://rec.example/calls/209771231\n---\n\nbody"


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        (EXPORT, ("Team Meeting", 25.0, "https://rec.example/calls/209771231", "body", None)),
        (EXPORT.replace("https:", ""), ("Team Meeting", 25.0, "https://rec.example/calls/209771231", "body", None)),
        (EXPORT.replace("25", "45.5"), ("Team Meeting", 45.5, "https://rec.example/calls/209771231", "body", None)),
        (EXPORT.replace("25", "invalid"), ("Team Meeting", 0.0, "https://rec.example/calls/209771231", "body", None)),
        (EXPORT.replace("Team", "A - B"), ("A - B Meeting", 25.0, "https://rec.example/calls/209771231", "body", None)),
        (EXPORT.replace("January 15", "someday"), (None, None, None, None, "Date is None")),
        (EXPORT.replace("Team Meeting - January 15", "Team"), (None, None, None, None, "Date is None, Title is None")),
        (EXPORT.replace("VIEW", "SEE"), (None, None, None, None, "URL is None")),
        (EXPORT.replace(" - January 15\n", " - January 15\n1\n2\n3\n4\n5\n"), (None, None, None, None, "URL is None")),
    ],
)
def test_export_headers(spark, value, expected):
    parsed = exports.parse_exports(spark.createDataFrame([("p", value)], "path string, value string"), "2026-02-03")
    valid = [(r.title, r.duration_minutes, r.url, r.full_text, None) for r in parsed.valid.collect()]
    refused = [(None, None, None, None, r[REASON]) for r in parsed.rejects.collect()]
    assert valid + refused == [expected]


def test_export_content_and_ids(spark):
    rows = [(f"p{i}", EXPORT.replace("---\n", "") if i % 2 else EXPORT) for i in range(100)]
    parsed = exports.parse_exports(spark.createDataFrame([*rows, ("empty", "")], "path string, value string"), "2026-02-03")
    sizes = {r.path: len(r.content) for r in parsed.valid.collect()}
    assert (sizes["p0"], sizes["p1"], len(sizes)) == (2, 4, 100)
    events = exports.export_events(parsed.valid, "backfill", "b@example.com", "devx")
    assert sorted(r.id for r in events.select("id").collect()) == list(range(100))
    assert events.first().meeting.join_url == "backfill"


def test_flatten_and_explode(spark):
    df = spark.createDataFrame(
        [(1, (2, (3,)), [("a",), ("b",)], [("x", 1), ("y", 2)]), (2, (4, (5,)), None, [])],
        "id int, s struct<p: int, q: struct<r: int>>, l array<struct<n: string>>, m array<struct<u: string, v: int>>",
    )
    flat = flatten_structs(df)
    assert flat.columns == ["id", "s_p", "s_q_r", "l", "m"]
    rows = flatten_structs(explode_lists(flat, ["l", "m"], "n")).orderBy("id", "n").collect()
    assert [(r.id, r.n, r.l_n, r.m_u, r.m_v) for r in rows] == [
        (1, 1, "a", "x", 1), (1, 2, "a", "y", 2), (1, 3, "b", "x", 1), (1, 4, "b", "y", 2), (2, 1, None, None, None),
    ]


def test_row_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "n int")
    ids = [r.id for r in keyed_rows(df, F.lit("rec_123456"), "n").orderBy("n").collect()]
    assert ids == ["rec_123456-00001", "rec_123456-00002", "rec_123456-00003"]
    kept = keyed_rows(df.withColumn("recording_id", F.lit("given")), F.lit("rec"), "n").first()
    assert (kept.recording_id, kept.id[:4]) == ("given", "rec-")


def test_call_without_lists_gives_one_row(spark):
    event = spark.createDataFrame(
        [(1, ("https://rec.example/calls/9", 1.5), ("t", None, None))],
        "id long, recording struct<url: string, duration_in_minutes: double>, meeting struct<title: string, "
        "external_domains: array<struct<domain_name: string>>, invitees: array<struct<name: string, email: string, is_external: boolean>>>",
    )
    built = flat_rows(event)
    row = built.valid.first()
    assert (row.id, row.recording_id, row.meeting_title, row.meeting_invitees, row.meeting_invitees_name) == ("9-00001", "9", "t", None, None)
    assert built.valid.count() == 1 and built.rejects.count() == 0


def test_iso_datetimes_at_any_depth(spark):
    at = datetime(2024, 1, 15, 10, 30, 45)
    df = spark.createDataFrame(
        [(at, (at, "x"), [at], [(at, 1)], 5)],
        "a timestamp, b struct<t: timestamp, s: string>, c array<timestamp>, d array<struct<t: timestamp, n: int>>, e int",
    )
    row, text = iso_datetimes(df).first(), "2024-01-15T10:30:45+00:00"
    assert (row.a, row.b.t, row.b.s, row.c, row.d[0].t, row.d[0].n, row.e) == (text, text, "x", [text], text, 1, 5)
