"""The plans that matter at scale: what is pushed down, what is shuffled, what is broadcast."""

import os
import random

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from touchpoint.functions import calls
from touchpoint.operators import joins, transcripts

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


@tables
def test_table_scan_is_pruned_and_pushed_down(spark):
    text = plan(queries()["s12_sql_table_scan"](spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate" in text and "EqualTo(o_orderstatus,F)" in text
    assert "o_orderpriority" not in text


@tables
def test_key_scan_reads_one_column(spark):
    assert "ReadSchema: struct<l_partkey:bigint>" in plan(queries()["s13_key_scan"](spark, SF_DIR))


@tables
def test_lookup_does_not_shuffle_the_facts(spark):
    text = plan(queries()["j01_alias_lookup"](spark, SF_DIR))
    assert text.index("BroadcastHashJoin") < text.index("FileScan") < text.index("BroadcastExchange")


def test_transcripts_are_cut_without_a_shuffle_and_once(spark, tmp_path):
    rows = [("https://rec.example/calls/1", "00:01 - A\nx")]
    spark.createDataFrame(rows, "url string, plaintext string").write.parquet(str(tmp_path / "t"))
    lined = transcripts.with_lines(spark.read.parquet(str(tmp_path / "t")))
    people = spark.createDataFrame([(0, "A", "a@x.com", [])], "idx int, name string, email string, aliases array<string>")
    rows = spark.read.parquet(str(tmp_path / "t")).selectExpr("url", "url AS title", "url AS date", "plaintext")
    built = transcripts.transcript_messages(rows, people, "idx")
    for text in (plan(transcripts.explode_messages(transcripts.flag_transcripts(lined))), plan(built.rejects)):
        assert "Exchange" not in text
        assert text.count("split(plaintext") == 1
    assert plan(built.valid).count("split(plaintext") == 1


def test_alignment_shuffles_all_frames_once(spark, monkeypatch):
    frames = [spark.range(3 + i).withColumn(f"x{i}", F.lit(i)) for i in range(5)]
    plans = []
    save = type(frames[0].write).parquet

    def watch(writer, path, *args, **kwargs):
        plans.append(plan(writer._df))
        return save(writer, path, *args, **kwargs)

    monkeypatch.setattr(type(frames[0].write), "parquet", watch)
    text = plan(joins.align_frames(frames))
    assert len(plans) == 1 and plans[0].count("Exchange hashpartitioning") == 1 and plans[0].count("Range (") == 5
    assert "Join" not in plans[0] and "Join" not in text and "Exchange" not in text


@tables
@pytest.mark.parametrize("name", sorted(n for n in queries() if not n.startswith(("g0", "job_", "k0", "s0"))))
def test_no_cross_joins(spark, name):
    """Queries that read and write files are left out here; their joins are those of the other queries."""
    text = plan(queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def brute_force(text, speakers):
    """The messages of a transcript, line by line; None when it is refused."""
    import re

    found = []
    for line in (part.strip() for part in text.split("\n")):
        head = re.match(r"([0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?)\s+-\s+(.+?)(?:\s+\(([^)]+)\))?$", line)
        if not line:
            continue
        if head:
            found.append({"speaker": speakers.get(head[2].lower(), head[2]), "parts": [], "action": None, "link": None})
        elif not found:
            return None
        elif line.startswith("ACTION ITEM:"):
            found[-1]["action"] = line.removeprefix("ACTION ITEM:").strip()
        elif line.startswith("- WATCH:"):
            link = re.match(r"- WATCH:\s*(https?://\S+)(?:\s+(.*))?", line)
            if not link:
                return None
            found[-1]["link"] = link[1]
            found[-1]["parts"] += [link[2]] if link[2] else []
        else:
            found[-1]["parts"].append(line)
    return [(m["speaker"], " ".join(m["parts"]), m["action"], m["link"]) for m in found]


def test_random_transcripts_equal_brute_force(spark):
    rng = random.Random(11)
    pieces = [
        "00:01 - Ann", "1:02:03 - Bo Li (B Inc)", "59:59 -  ann  (x)", "hello there", "  padded\t", "", "  ", "ACTION ITEM: call",
        "ACTION ITEM:", "- WATCH: https://e.com/1 see", "- WATCH: https://e.com/2", "- watch: no", "5:5 - not a header", "12:30 - C (d) e",
    ]
    texts = []
    for n in range(400):
        lines = rng.choices(pieces, k=rng.randint(0, 12))
        texts.append("\n".join(["00:01 - Ann"] * (rng.random() < 0.8) + lines + ["- WATCH: bad"] * (rng.random() < 0.1)))
    people = spark.createDataFrame([(0, "ANN", "ann@x.com", ["bo li"])], "idx int, name string, email string, aliases array<string>")
    rows = [(f"https://rec.example/calls/{n}", "t", t) for n, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "url string, title string, plaintext string").withColumn("date", F.current_timestamp())
    built = transcripts.transcript_messages(df, people, "idx")
    found = {}
    for r in built.valid.orderBy("message_id").collect():
        found.setdefault(int(r.recording_id), []).append((r.speaker, r.message, r.action_item, r.watch_link))
    refused = {r.url.rsplit("/", 1)[1] for r in built.rejects.collect()}
    speakers = {"ann": "ann@x.com", "bo li": "ann@x.com"}
    for n, text in enumerate(texts):
        expected = brute_force(text, speakers)
        assert (str(n) in refused) == (expected is None)
        assert found.get(n, []) == (expected or []), text
    assert calls.ACTION_PREFIX == "ACTION ITEM:"
