"""Each pipeline stage against brute force on its own input, and odd rows through all of them."""

import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tests.llm.fixtures import ODD, documents, shingle_set, words
from tests.llm.test_jaccard import brute as components_of
from tests.llm.test_suffixes import brute as cut_of
from touchpoint.llm import decontaminate, quality
from touchpoint.llm.queries import ORACLES, QUERIES

SF, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def rows_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_quality_stage(spark):
    """On the middle tables: the smallest have too few labels to learn from."""
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    kept = set(rows_of(pipeline.keep_good(spark, docs, MIDDLE)))
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    right = [(i in kept) == bool(q) for i, q in labels.items()]
    assert sum(right) >= 0.95 * len(right)
    trees = quality.train(docs, spark.read.parquet(f"{MIDDLE}/labels.parquet").where(~quality.held_out()))
    assert kept == {r["doc_id"] for r in quality.score(docs, trees).where("score >= 0.3").collect()}


def test_distinct_stage(spark, docs):
    texts = sorted(rows_of(docs).items())
    expected = {i for i, _, component in components_of(texts, 80, 5) if i == component}
    assert set(rows_of(pipeline.keep_distinct(spark, docs, SF))) == expected


def test_repeats_stage(spark, docs):
    expected = {i: digest for i, _, _, _, digest in cut_of(sorted(rows_of(docs).items()), 200)}
    cut = pipeline.cut_repeats(spark, docs, SF)
    assert cut.columns == docs.columns
    same = [hashlib.sha256(t.encode()).hexdigest() == expected[i] for i, t in rows_of(cut).items()]
    assert sum(same) >= 0.9 * len(same) and len(same) == len(expected)
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())


def test_leaks_stage(spark, docs):
    items = [decontaminate.word_shingles(r["text"].lower().encode(), 5) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = set()
    for i, text in rows_of(docs).items():
        own = decontaminate.word_shingles(text.lower().encode(), 5)
        leaked |= {i} if any(100 * len(s & own) >= 80 * len(s) for s in items) else set()
    assert leaked and set(rows_of(pipeline.drop_leaks(spark, docs, SF))) == set(rows_of(docs)) - leaked


def test_all_stages_on_odd_rows(spark):
    odd = documents(spark, [(i, t) for i, t in enumerate(ODD)] + [(None, None), (None, "x"), (40, " ".join(words(90, 1))), (40, " ".join(words(90, 1)))])
    odd = odd.withColumn("_score", F.lit("mine")).withColumn("component_id", F.lit(1)).withColumn("kept", F.lit(2))
    for _, stage in pipeline.STAGES[:-1]:
        odd_out = stage(spark, odd, SF)
        assert odd_out.columns == odd.columns
        odd_out.count()
        assert stage(spark, odd.where("false"), SF).count() == 0
    distinct = pipeline.keep_distinct(spark, odd, SF)
    assert sorted(r["doc_id"] for r in distinct.where("doc_id is not null").collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 40]
    assert pipeline.pack(spark, odd, SF).select("doc_id").distinct().count() == 12


def test_run_and_registration(spark):
    assert pipeline.run(spark, SF).count() > 0
    assert {name.split("_")[0] for name in QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
    assert set(ORACLES) <= set(QUERIES)
    assert shingle_set("a b", 5) == {("a", "b")}


def test_clashing_columns_keep_their_values(spark):
    """Columns with the names that the operators use themselves come back as they were."""
    passage = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"start {i} {passage} end {i}" if i < 2 else f"other {i}", "en", "s", 10) for i in range(4)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    names = ["kept", "spans", "row_key", "n_bytes", "n_removed", "kept_text", "kept_sha256", "others", "score", "_score"]
    wide = docs.withColumns({n: F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")) for n in names})
    cut = pipeline.cut_repeats(spark, wide, SF)
    assert cut.columns == wide.columns and cut.dtypes == wide.dtypes
    rows = {r["doc_id"]: r for r in cut.collect()}
    assert len(rows) == 4 and all(r[n] == f"{n} {i}" for i, r in rows.items() for n in names)
    assert all(passage not in rows[i]["text"] and rows[i]["n_chars"] == len(rows[i]["text"]) for i in (0, 1))
    assert [rows[i]["text"] for i in (2, 3)] == ["other 2", "other 3"]
    table = spark.read.parquet(f"{SF}/documents.parquet").withColumns({n: F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")) for n in names})
    kept = pipeline.keep_good(spark, table, SF)
    assert kept.dtypes == table.dtypes
    assert all(r[n] == f"{n} {r['doc_id']}" for r in kept.collect() for n in names)


def test_tasks_get_batches_of_bounded_bytes(spark):
    """Ten thousand long texts in one batch filled an executor, in the JVM and again in Python."""
    pipeline.keep_distinct(spark, documents(spark, ["a b c d e f"]), SF)
    long_texts = spark.range(0, 3_000, 1, 1).select(F.repeat(F.lit("words "), 2_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    found = [r["size"] for r in long_texts.mapInArrow(sizes, "size bigint").collect()]
    assert sum(found) > 30 << 20 and max(found) < 8 << 20
