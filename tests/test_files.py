import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from touchpoint.operators.validate import REASON
from touchpoint.plans import attendees
from touchpoint.sinks import files as sinks
from touchpoint.sinks import outcomes
from touchpoint.sinks import tables
from touchpoint.sources import files as sources
from touchpoint.sources import tables as stored

DOC = "name string, value int"


@pytest.fixture
def folder(tmp_path):
    def write(contents: dict[str, str]) -> str:
        for name, text in contents.items():
            path = tmp_path / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(text)
        return str(tmp_path)

    return write


def test_list_folder(spark, folder):
    path = folder({"a.json": "{}", "b.JSON": "x", "c.txt": "x", "d.jsonl": "x", "sub/e.json": "x", "noext": "x", "zero.json": ""})
    assert sorted(r.name for r in sources.list_folder(spark, path, [".json", ".jsonl"]).collect()) == ["a.json", "d.jsonl", "zero.json"]
    assert sources.list_folder(spark, path).count() == 6
    with pytest.raises(FileNotFoundError):
        sources.list_folder(spark, f"{path}/none")
    with pytest.raises(FileNotFoundError):
        sources.list_folder(spark, f"{path}/a.json")


def test_csv_headers_are_matched_by_name(spark, folder):
    path = folder(
        {
            "b.csv": "email,name\nb@x.com,Bea\n",
            "a.csv": 'name,email,company\n"Al, Jr",a@x.com,0042\n"two\nlines",t@x.com,\n',
            "c d+%.csv": "name,email\r\nCy,\r\n",
            "note.txt": "x",
        }
    )
    rows = sources.read_csv_folder(spark, path).collect()
    assert {(r._file, r.name, r.email, r.company) for r in rows} == {
        ("a.csv", "Al, Jr", "a@x.com", "0042"), ("a.csv", "two\nlines", "t@x.com", None), ("b.csv", "Bea", "b@x.com", None),
        ("c d+%.csv", "Cy", None, None),
    }


def test_csv_folder_loses_nothing(spark, folder):
    path = folder(
        {
            "a.csv": 'name,email\nBo,b@x.com,EXTRA\nCy,c@x.com\nDi\n"E, F",e@x.com\n"G, H",g@x.com,\n',
            "b.csv": "name,email,company\nIo,i@x.com,co\nJo,j@x.com,co,more,cells\n",
            "_hidden.csv": "name,email\nKa,k@x.com\n", "zero.csv": "", ".dot.csv": "name\nx\n",
        }
    )
    read = sources.read_csv_rows(spark, path)
    assert sorted(r.name for r in read.valid.collect()) == ["Cy", "Di", "E, F", "Io"]
    assert sorted((r.row_key, r.reject_reason) for r in read.rejects.collect()) == [
        ("a.csv", "3 cells under 2 columns"), ("a.csv", "3 cells under 2 columns"), ("b.csv", "5 cells under 3 columns"),
    ]
    assert sorted(r.row_key for r in sources.unread_files(spark, path, [".csv"]).collect()) == [".dot.csv", "_hidden.csv", "zero.csv"]
    assert sorted(r.name for r in sources.list_folder(spark, path).collect()) == [".dot.csv", "_hidden.csv", "a.csv", "b.csv", "zero.csv"]


def test_quoted_commas_in_a_sliced_header(spark, folder):
    path = folder({"q.csv": 'note\n"a,b",c\n1,2\n"3,4",5\n'})
    rows = sources.read_csv_slice(spark, f"{path}/q.csv", 1).valid
    assert rows.columns == ["line_no", "a,b", "c"]
    assert sorted(tuple(r)[1:] for r in rows.collect()) == [("1", "2"), ("3,4", "5")]


def test_strings_must_be_strings(spark):
    rows = spark.createDataFrame([('{"s":5}',), ('{"s":{"a":1}}',), ('{"s":[1]}',), ('{"s":true}',), ('{"s":"5"}',), ('{"s":null}',), ("{}",)], "v string")
    read = sources.parse_json(rows, "v", "s string")
    assert sorted((r.s or "") for r in read.valid.collect()) == ["", "", "5"]
    assert [r.reject_reason for r in read.rejects.collect()] == ["s is not a string"] * 4


def test_csv_folder_errors(spark, folder):
    with pytest.raises(ValueError, match="no CSV"):
        sources.read_csv_folder(spark, folder({"x.txt": ""}))
    assert sources.read_csv_folder(spark, folder({"q.csv": "name\nname\n"})).first().name == "name"
    with pytest.raises(FileNotFoundError):
        sources.read_csv_folder(spark, "/no/such/folder")


ATTENDEES = {
    "20240101-event1.csv": "name,email,company\nJohn Doe,john@example.com,Acme Corp\nJohn Doe,john@example.com,Acme Corp\n",
    "20240101-event1.json": '{"event_url": "https://example.com/event1"}',
    "2024-02-03-my-event.csv": "email,name\n,Jane Smith\n",
    "2024-02-03-my-event.json": '{"event_url": "https://example.com/event2"}',
    "lost.csv": "name\nx\n",
    "empty.csv": "name\nx\n",
    "empty.json": '{"event_url": ""}',
    "bad.csv": "name\nx\n",
    "bad.json": "{oops",
}


def test_attendee_job(spark, folder, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("attendees"))
    attendees.run(spark, folder(ATTENDEES), out, "2030-01-01")
    objects = spark.read.json(f"{out}/objects").collect()
    assert {r.file_name for r in objects} == {
        "20240101-event1-20240101-john·examplecom.jsonl", "2024-02-03-my-event-20240203-jane·smith.jsonl",
    }
    assert len(objects) == 2
    aggregate = spark.read.csv(f"{out}/aggregate", header=True)
    assert aggregate.columns == ["name", "email", "company", "source", "event_url", "created_at"]
    assert aggregate.count() == 3
    rejects = {r.row_key: r.reject_reason for r in spark.read.json(f"{out}/rejects").collect()}
    assert rejects == {
        "lost.csv": "required metadata file not found", "empty.csv": "event_url missing or empty in metadata file",
        "bad.csv": "malformed metadata file",
    }


def test_json_documents(spark, folder):
    path = folder(
        {
            "good.json": '{\n "name": "test",\n "value": 42, "extra": [1]}\n',
            "type.json": '{"name": "n", "value": "not_a_number"}',
            "missing.json": '{"value": 1}',
            "two.jsonl": '{"name": "a", "value": 1}\n{"name": "b", "value": 2}\n',
            "broken.json": '{"name":',
            "blank.json": " \n",
            "list.json": "[1]",
            "skip.txt": "{}",
        }
    )
    checked = sources.read_json_docs(spark, path, DOC, [".json", ".jsonl"], ("name", "value"))
    assert [(r.name, r.value) for r in checked.valid.collect()] == [("test", 42)]
    found = {r._file.rsplit("/", 1)[1]: r[REASON] for r in checked.rejects.collect()}
    assert found == {
        "type.json": "not a document of this schema", "missing.json": "missing name", "two.jsonl": sources.MANY_DOCUMENTS,
        "broken.json": "not a document of this schema", "blank.json": "empty document", "list.json": "not a document of this schema",
    }


def test_json_lines_number_their_rejects(spark, folder):
    path = folder({"x.jsonl": '{"name": "a", "value": 1}\n\n  \n{"name": 5}\n{"name": "b", "value": "x"}\n{"name": "c", "value": 3} {}\n'})
    checked = sources.read_json_lines(spark, f"{path}/x.jsonl", DOC, ("name", "value"))
    assert [(r.name, r.value) for r in checked.valid.collect()] == [("a", 1)]
    assert [(r.line_no, r[REASON]) for r in checked.rejects.orderBy("line_no").collect()] == [
        (4, "missing value, name is not a string"), (5, "not a document of this schema"), (6, sources.TRAILING),
    ]
    with pytest.raises(ValueError, match=".jsonl"):
        sources.require_suffix("a.json", ".jsonl")


def test_speaker_file(spark, folder):
    document = {"speakers_internal": [{"name": "Alice Johnson", "email": "a@x.com", "aliases": ["Alice J.", "AJ"]}, {"name": "Bo", "email": "b@x.com"}]}
    path = folder({"storage.json": json.dumps(document, indent=2), "bad.json": "{oops", "none.json": '{"speakers_internal": []}'})
    rows = sources.read_speakers(spark, f"{path}/storage.json").orderBy("idx").collect()
    assert [tuple(r) for r in rows] == [(0, "Alice Johnson", "a@x.com", ["Alice J.", "AJ"]), (1, "Bo", "b@x.com", [])]
    assert sources.read_speakers(spark, f"{path}/none.json").count() == 0
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ"):
        sources.read_speakers(spark, f"{path}/bad.json").collect()


def test_line_numbers_of_split_files(spark, folder):
    path = folder({"long.txt": "\n".join(f"line {i}" for i in range(1, 5001)) + "\n", "short.txt": "line 1\n"})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = sources.numbered_lines(spark, path)
        assert spark.read.text(path).rdd.getNumPartitions() > 1
        assert lines.where(F.concat(F.lit("line "), F.col("line_no").cast("string")) == F.col("line")).count() == 5001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_compact_text(spark, folder):
    path = folder({"a.json": '{\n  "a": 1,\r\n\t"b": [ 2 ]\n}\n', "b.xml": "<a>\n <b/>\n</a>", "c.md": " \n"})
    assert {r.payload for r in sources.read_compact_text(spark, path).collect()} == {'{"a": 1,"b": [ 2 ]}', "<a><b/></a>", ""}


def test_csv_slice(spark, folder):
    path = folder({"t.csv": "made by\nhand, twice\nid,name\n1,a\n\n2,\"b, c\"\n3,d\n"})
    rows = sources.read_csv_slice(spark, f"{path}/t.csv", 2, 2).valid.orderBy("line_no").collect()
    assert [(r.id, r.name) for r in rows] == [("1", "a"), ("2", "b, c")]
    assert sources.read_csv_slice(spark, f"{path}/t.csv", 2).valid.count() == 3
    with pytest.raises(ValueError, match="no header"):
        sources.read_csv_slice(spark, f"{path}/t.csv", 50)


def test_sliced_rows_with_more_cells_are_rejects(spark, folder):
    path = folder({"t.csv": 'x\nid,name\n1,a\n2,b,EXTRA,MORE\n3,"c, ""d"", e"\n4\n'})
    read = sources.read_csv_slice(spark, f"{path}/t.csv", 1)
    assert sorted((r.id, r.name) for r in read.valid.collect()) == [("1", "a"), ("3", 'c, "d", e'), ("4", None)]
    (refused,) = read.rejects.collect()
    assert (refused.line_no, refused.line, refused.reject_reason) == (4, "2,b,EXTRA,MORE", "4 cells under 2 columns")
    assert refused.row_key.endswith("t.csv:4")


@pytest.mark.parametrize(
    "record",
    [
        "", "a", "a,b", ",", ",,", '""', '"",""', '"a,b"', '"a,b",c', 'a,"b,c",d', '"a""b,c",d', '"a"",""b",c', '""""",x"', 'a"b,c', '5" pipe,b', 'a""b,c', '"a\nb,c",d',
        'x,"",y', 'x,"""",y', '"a",', ',"a"', '"' + "x" * 200_000 + '",b', '"' + 'y"",' * 50_000 + '",b', "a," * 1000,
    ],
)
def test_cells_are_counted_as_the_csv_module_does(spark, record):
    import csv
    import io

    csv.field_size_limit(10_000_000)
    expected = len(next(csv.reader(io.StringIO(record, newline="")), [""])) or 1
    got = spark.createDataFrame([(record,)], "r string").select(sources.csv_cells(F.col("r")).alias("n")).first().n
    assert got == expected


def test_long_cells_and_broken_headers(spark, folder):
    long = "word, " * 200_000
    path = folder(
        {
            "a.csv": f'name,email\n"{long}",a@x.com\n"{long}",b@x.com,more\nCy,c@x.com\n',
            "b.csv": '"first\nname",name,email,company\nX,"B ""Q"", C",b@x.com,"c\n\nd"\n,Di,d@x.com,,\n',
        }
    )
    read = sources.read_csv_rows(spark, path)
    rows = {r.email: r for r in read.valid.collect()}
    assert set(rows) == {"a@x.com", "b@x.com", "c@x.com"} and rows["a@x.com"].name == long
    assert (rows["b@x.com"]["first\nname"], rows["b@x.com"].name, rows["b@x.com"].company) == ("X", 'B "Q", C', "c\n\nd")
    assert sorted((r.row_key, r.row_no, r.reject_reason) for r in read.rejects.collect()) == [
        ("a.csv", 2, "3 cells under 2 columns"), ("b.csv", 2, "5 cells under 4 columns"),
    ]


def test_rows_of_split_files_have_numbers(spark, folder):
    lines = [f"{i},n{i}" + (",x" if i % 900 == 0 else "") for i in range(1, 5001)]
    path = folder({"long.csv": "id,name\n" + "\n".join(lines) + "\n", "short.csv": "id,name\n1,a\n2,b,c\n"})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        read = sources.read_csv_rows(spark, path, multi_line=False)
        assert sorted((r.row_key, r.row_no) for r in read.rejects.collect()) == [*(("long.csv", n) for n in range(900, 5001, 900)), ("short.csv", 2)]
        valid = sources.row_numbers(read.valid, sources.flag_csv_rows(spark, path, False).select(sources.POSITION), "n")
        assert valid.where("_file = 'long.csv' AND CAST(id AS INT) <> n").count() == 0
        later = valid.where("_file = 'long.csv'").orderBy(sources.POSITION).select(F.col("id").cast("int").alias("id")).collect()
        assert [r.id for r in later] == sorted(r.id for r in later)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_the_later_record_wins(spark, folder, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("later"))
    rows = ["Zed,same@x.com,OLD", "Bo,bo@x.com,first"] + [f"N{i},n{i}@x.com,c" for i in range(20)] + ["Amy,same@x.com,NEW", "Al,bo@x.com,last"]
    path = folder({"2024-01-01-e.csv": "name,email,company\n" + "\n".join(rows) + "\n", "2024-01-01-e.json": '{"event_url": "u"}'})
    assert attendees.run(spark, path, out, "2030-01-01") == {"valid": 24, "rejected": 0}
    stored = {r.email: (r.name, r.company) for r in spark.read.json(f"{out}/objects").collect()}
    assert len(stored) == 22 and stored["same@x.com"] == ("Amy", "NEW") and stored["bo@x.com"] == ("Al", "last")


def test_attendee_folder_is_parsed_once(spark, folder, monkeypatch):
    path = folder(ATTENDEES)
    seen = []
    settle = attendees.settle_flagged

    def watch(flagged, name):
        seen.append(flagged._jdf.queryExecution().executedPlan().toString().count("FileScan csv"))
        return settle(flagged, name)

    monkeypatch.setattr(attendees, "settle_flagged", watch)
    built = attendees.plan(spark, path, "2030-01-01")
    assert seen == [1]
    for frame in (built.aligned, built.objects, built.counts, built.rejects):
        assert "FileScan csv" not in frame._jdf.queryExecution().executedPlan().toString()
    assert built.report == {"valid": 3, "rejected": 3}


def test_settled_rows_are_counted_once(spark, tmp_path):
    rows = spark.range(1000).withColumn("s", F.when(F.col("id") % 10 == 0, "a").otherwise("b"))
    settled = outcomes.settle(rows, ("a", "b", "c"), F.col("s"), "t", ["s"])
    assert settled.counts == {"a": 100, "b": 900, "c": 0} and settled.rows.columns == ["id", "_status"]
    assert settled.of("a").count() == 100 and settled.of("c").count() == 0 and settled.of("a", "b").count() == 1000
    with pytest.raises(Exception, match="unknown status b"):
        outcomes.settle(rows, ("a",), F.col("s"), "t")


def test_typed_and_strict_csv(spark, folder):
    path = folder({"ids.csv": "recording_id,n\n007,1\n8,x\n"})
    typed = sources.read_csv_columns(spark, f"{path}/ids.csv", "recording_id string, n string")
    assert [r.recording_id for r in typed.collect()] == ["007", "8"]
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ|parse"):
        sources.read_csv_strict(spark, f"{path}/ids.csv", "recording_id string, n int").collect()


def test_destinations(monkeypatch, tmp_path):
    monkeypatch.chdir(tmp_path)
    assert sinks.Destination.parse("local").url("b-1") == f"{tmp_path}/out/b-1"
    assert sinks.Destination.parse("gcs").url("b-1") == "gs://b-1"
    with pytest.raises(ValueError, match="Invalid destination type: 's3'. Valid values are: local, gcs"):
        sinks.Destination.parse("s3")
    assert sinks.is_cloud("gs://x") and not sinks.is_cloud("/x")
    with pytest.raises(ValueError, match="Invalid bucket url: None"):
        sinks.is_cloud(None)


def test_exported_objects(spark, tmp_path):
    rows = [("a.jsonl", '{"x": "ü"}'), ("sub/dir/b.md", ""), ("big.txt", "y" * 1_100_000)]
    df = spark.createDataFrame(rows, "file_name string, value string")
    for _ in range(2):
        sinks.export_objects(df, str(tmp_path))
    assert json.loads((tmp_path / "a.jsonl").read_text()) == {"x": "ü"}
    assert (tmp_path / "sub/dir/b.md").read_text() == "" and (tmp_path / "big.txt").stat().st_size == 1_100_000
    bad = spark.createDataFrame([("../x", "1"), ("/x", "1"), ("a/../../x", "1"), ("a..b", "1")], "file_name string, value string")
    assert [r.file_name for r in sinks.safe_names(bad).collect()] == ["a..b"]
    with pytest.raises(Exception, match="leaves its folder"):
        sinks.export_objects(bad, str(tmp_path))


def test_raw_is_stored_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    for payloads in (["a", "b", "a"], ["b", "c"]):
        sinks.append_raw(spark.createDataFrame([(p,) for p in payloads], "payload string"), path)
    assert sorted(r.payload for r in spark.read.parquet(path).collect()) == ["a", "b", "c"]


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "id int, v string, t int"
    first = spark.createDataFrame([(1, "a", 0), (2, "old", 0), (2, "b", 1), (None, "x", 0)], schema)
    second = spark.createDataFrame([(2, "B", 0), (3, "c", 0), (3, "c0", -1)], schema)
    tables.upsert_rows(first, path, "id", [F.desc("t")])
    for _ in range(2):
        tables.upsert_rows(second, path, "id", [F.desc("t")])
        assert sorted((r.id, r.v) for r in tables.read_upserted(spark, path).collect()) == [(1, "a"), (2, "B"), (3, "c")]
    tables.upsert_rows(spark.range(500).select(F.col("id").cast("int").alias("id"), F.lit("n").alias("v"), F.lit(0).alias("t")), path, "id", [F.col("v")])
    tables.upsert_rows(first.where("false"), path, "id", [F.col("v")])
    assert {r.v for r in tables.read_upserted(spark, path).collect()} == {"n"} and tables.read_upserted(spark, path).count() == 500


def test_upsert_leaves_other_partitions_alone(spark, tmp_path):
    path = tmp_path / "t"
    rows = spark.range(200).select(F.col("id").cast("int").alias("id"), F.lit("old").alias("v"))
    tables.upsert_rows(rows, str(path), "id", [F.col("v")], 8)
    before = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    tables.upsert_rows(rows.where("id = 7").withColumn("v", F.lit("new")), str(path), "id", [F.col("v")], 8)
    kept = [f for f in before if f.exists() and f.stat().st_mtime_ns == before[f]]
    assert len({f.parent for f in kept}) == 7
    assert {r.v: r["count"] for r in tables.read_upserted(spark, str(path)).groupBy("v").count().collect()} == {"old": 199, "new": 1}


def test_ledger(spark, tmp_path):
    ledger = tables.Ledger(spark, str(tmp_path / "l"), "id")
    assert ledger.read().count() == 0
    for ids in (["b", "a", "b", None], ["a", "c"]):
        ledger.add(spark.createDataFrame([(i,) for i in ids], "id string"))
    assert [r.id for r in ledger.export().collect()] == ["a", "b", "c"] and ledger.read().count() == 3


def test_append_replace_publish(spark, tmp_path):
    rows = spark.createDataFrame([(1,)], "id int")
    for _ in range(2):
        tables.append_rows(rows, str(tmp_path / "a"))
        tables.replace_table(rows, str(tmp_path / "r"))
    assert (spark.read.parquet(str(tmp_path / "a")).count(), spark.read.parquet(str(tmp_path / "r")).count()) == (2, 1)
    speakers = spark.createDataFrame([("Al", "al@x.com", []), ("", "x", [])], "name string, email string, aliases array<string>")
    tables.publish_speakers(speakers.where("name = 'Al'"), str(tmp_path / "s"))
    with pytest.raises(ValueError, match="email"):
        tables.publish_speakers(speakers, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 1


def test_stored_keys(spark, tmp_path):
    assert stored.read_keys(spark, str(tmp_path / "none"), "id", "int").count() == 0
    spark.createDataFrame([(1,), (1,)], "id int").write.parquet(str(tmp_path / "t"))
    assert stored.read_keys(spark, str(tmp_path / "t"), "id", "int").count() == 1
    (tmp_path / "broken").mkdir()
    with pytest.raises(AnalysisException):
        stored.read_keys(spark, str(tmp_path / "broken"), "id", "int").count()


REFUSALS = {
    '{"a":"x","n":1}': None,
    '{"a":"x"}\n\n': None,
    '{"a":"x","r":{"b":[1, 2]}}': None,
    '{"a":"x","z":{"q":1,"q":2}}': None,
    '{"a":2,"a":"x"}': None,
    '{"a":"x","a":2}': "a is not a string",
    '{"a":1}': "a is not a string",
    '{"a":[]}': "a is not a string",
    '{"a":null}': "missing a",
    '{"n":1}': "missing a",
    '{"A":"x"}': "missing a",
    '{"a":"x","n":1}{"a":"y"}': sources.TRAILING,
    '{"a":"x"},{"a":"y"}': sources.TRAILING,
    '{"a":"x"} tail': sources.TRAILING,
    '{"a":"x"} // c': sources.TRAILING,
    '[{"a":"x"}]': "not a document of this schema",
    '{"a":"x"}]': "not a document of this schema",
    '{"a":{"k":1,"k":2}}': "not a document of this schema",
    '{"a":"x","n":"1"}': "not a document of this schema",
    '{"a":"x","n":12345678901234567890}': "not a document of this schema",
    '{"a":"x","l":"p"}': "not a document of this schema",
    '{"a":"x"': "not a document of this schema",
    "nope": "not a document of this schema",
    "null": "not a document of this schema",
    "": "empty document",
    " \n": "empty document",
    None: "empty document",
}
JSON_SCHEMA = "a string, n bigint, r string, l array<string>"


def test_json_refusals(spark):
    df = spark.createDataFrame(list(enumerate(REFUSALS)), "i int, v string")
    rows = {r["i"]: r for r in sources.flag_json(df, "v", JSON_SCHEMA, ("a",), raw=("r",)).collect()}
    for i, (text, reason) in enumerate(REFUSALS.items()):
        assert rows[i]["reject_reason"] == reason, text
        assert rows[i]["_refused"] == (None if reason is None else text)
        assert reason is not None or rows[i]["a"] == "x"
    assert rows[2]["r"] == '{"b":[1,2]}'


def test_accepted_json_is_parsed_once(spark, tmp_path):
    """The parse is below the filter; above it only refused texts are parsed, behind a condition."""
    (tmp_path / "t.jsonl").write_text('{"a":"x"}\n')
    df = spark.read.text(str(tmp_path / "t.jsonl"))
    plan = sources.parse_json(df, "value", JSON_SCHEMA, ("a",))
    nodes = [line for line in plan.valid._jdf.queryExecution().executedPlan().toString().split("+- ") if "from_json" in line]
    assert len(nodes) == 2 and nodes[0].startswith("Filter") and nodes[1].startswith("Generate explode")
    assert nodes[1].count("from_json") == 1
    assert all("THEN false ELSE" in piece for piece in nodes[0].split("from_json")[:1])
