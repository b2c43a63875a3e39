"""One key holds a third of the rows: joins split it, and results stay whole."""

import pytest
from pyspark.sql import functions as F

from touchpoint.catalog import streams
from touchpoint.operators import joins, keys
from touchpoint.sinks.files import write_keyed_json

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
}


@pytest.fixture
def skewed(spark):
    """60,000 rows in 12 partitions, a third of them with the same key."""
    for key, value in CONF.items():
        spark.conf.set(key, value)
    key = F.when(F.col("n") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("n") % 5000).cast("string")))
    payload = F.sha2(F.col("n").cast("string"), 512)
    yield spark.range(0, 60_000, 1, 12).withColumnRenamed("id", "n").select("n", key.alias("id"), payload.alias("payload"))
    for key in CONF:
        spark.conf.unset(key)


def final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def test_resume_splits_a_hot_key(spark, skewed):
    done = spark.createDataFrame([(f"k{i}",) for i in range(0, 5000, 2)], "id string").repartition(4)
    rows, text = final_plan(keys.resume(skewed, done, "id"))
    expected = {n for n in range(60_000) if n % 3 == 0 or n % 5000 % 2}
    assert {r.n for r in rows} == expected and len(rows) == len(expected)
    assert "skew=true" in text


def test_large_lookup_salts_the_hot_name_alone(spark, skewed, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    speakers = [(i, f"K{i}", f"k{i}@x.com", ["HOT"] if i == 7 else []) for i in range(3000)]
    people = spark.createDataFrame(speakers, "idx int, name string, email string, aliases array<string>")
    resolved = joins.resolve_names(skewed, "id", people, "idx", "speaker")
    rows = resolved.collect()
    assert len(rows) == 60_000
    for r in rows:
        number = None if r.id == "hot" else int(r.id[1:])
        assert r.speaker == ("k7@x.com" if number is None else f"k{number}@x.com" if number < 3000 else r.id)
    (hot,) = joins.hot_keys(skewed, "id")
    assert hot == spark.sql("SELECT xxhash64('hot') AS h").first().h
    dimension = spark.createDataFrame([(k, 1) for k in ["hot", *[f"k{i}" for i in range(3000)]]], "id string, x int")
    joined = joins.lookup_join(skewed, dimension, "id")
    copies = [p for p in joined._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Generate explode(CASE WHEN" in p]
    assert len(copies) == 1 and str(hot) in copies[0]
    assert joined.count() == 60_000 and joined.where("x = 1").count() == 20_000 + sum(1 for n in range(60_000) if n % 3 and n % 5000 < 3000)
    salted = skewed.where("id = 'hot'").select(F.pmod(F.spark_partition_id(), F.lit(joins.SALTS)).alias("s"))
    assert max(r["count"] for r in salted.groupBy("s").count().collect()) <= 20_000 / 12 + 1


def test_blocks_of_a_hot_key_are_even(spark, skewed, monkeypatch):
    monkeypatch.setattr(keys, "MIN_BLOCK_ROWS", 2_000)
    blocked = keys.range_blocks(skewed, ["id"], ["n"], F.lit(1))
    sizes = sorted(r["count"] for r in blocked.groupBy("_part").count().collect())
    assert len(sizes) == 30 and sizes[-1] < 2 * sizes[len(sizes) // 2]
    assert blocked.where("id = 'hot'").select("_part").distinct().count() >= 8
    total = keys.running_total(skewed, ["id"], ["n"], F.lit(1), "place")
    hot = total.where("id = 'hot'").select("n", "place").collect()
    assert len(hot) == 20_000 and all(r.place == r.n // 3 + 1 for r in hot)
    assert total.count() == 60_000


def test_alignment_splits_a_hot_key_on_its_left(spark, skewed):
    extra = spark.createDataFrame([("hot", 1), ("k1", 2), ("new", 3)], "id string, x int")
    rows, text = final_plan(joins.align_frames([skewed, extra]))
    assert len(rows) == 60_001 and sum(r.x == 1 for r in rows) == 20_000
    assert "skew=true" in text


def test_newest_row_of_a_hot_key_shuffles_one_row_per_task(spark, skewed):
    newest = keys.latest_per_key(skewed, ["id"], [F.desc("n")])
    newest.collect()
    assert {r.id: r.n for r in newest.where("id = 'hot'").collect()} == {"hot": 59_997}
    assert newest.count() == skewed.select("id").distinct().count()


def test_keyed_folders_do_not_multiply_by_tasks(spark, tmp_path):
    rows = spark.range(0, 4000, numPartitions=8).select(F.concat(F.lit("s"), F.col("id") % 40).alias("source"), F.col("id").cast("string").alias("file_name"))
    write_keyed_json(rows, str(tmp_path / "out"), ["source"])
    assert spark.read.json(str(tmp_path / "out")).count() == 4000
    assert len(list((tmp_path / "out").glob("source=*/part-*"))) <= 2 * 40


def test_landed_files_grow_in_number_not_in_size(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(streams, "LANDED_ROWS", 100)
    streams._cut(spark.range(2350)).write.json(str(tmp_path / "landed"))
    files = list((tmp_path / "landed").glob("part-*"))
    assert len(files) == 24 and max(len(f.read_text().splitlines()) for f in files) < 200
    assert streams._half(spark, str(tmp_path / "landed")) == 12
