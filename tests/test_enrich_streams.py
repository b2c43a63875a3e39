import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from touchpoint import schemas
from touchpoint.datasets import PRODUCTS
from touchpoint.operators import enrich, similarity
from touchpoint.operators.enrich import HashingEmbedder, RefusedText
from touchpoint.operators.similarity import cosine_topk
from touchpoint.plans import records
from touchpoint.sinks.tables import Ledger
from touchpoint.streaming import landing


def test_batches_are_full_but_the_last():
    batches = [pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64())], ["x"]) for n in (1, 0, 7, 3, 12)]
    sizes = [c.num_rows for c in enrich._chunks(iter(batches), 5)]
    assert sizes == [5, 5, 5, 5, 3]
    assert [x for c in enrich._chunks(iter(batches), 5) for x in c.column(0).to_pylist()] == [0, *range(7), *range(3), *range(12)]
    assert list(enrich._chunks(iter([]), 5)) == []


def test_large_integers_beside_nulls_pass_unchanged(spark):
    rows = spark.createDataFrame([(9007199254740993, "a b"), (None, "c")], "id bigint, body string")
    assert {r.id for r in enrich.embed_rows(rows, "body", enrich.HashingEmbedder(8)).collect()} == {9007199254740993, None}
    made = enrich.generate_text(rows, lambda row: None, "no {id}", "text").collect()
    assert sorted(r.text for r in made) == ["no 9007199254740993", "no None"]
    asked = enrich.lookup_status(rows, "id", lambda key: 1).collect()
    assert {r.id for r in asked} == {"9007199254740993", None}


def test_refused_batch_is_retried_text_by_text():
    calls = []

    def service(texts):
        calls.append(len(texts))
        if len(texts) > 1:
            raise RefusedText("The input token count exceeds the limit")
        if not texts[0]:
            raise RefusedText("text content is EMPTY")
        return [[1.0]]

    assert enrich._embed_batch(["a", "", "b"], service) == [[1.0], None, [1.0]]
    assert calls == [3, 1, 1, 1]

    def broken(texts):
        raise RefusedText("quota exceeded")

    with pytest.raises(RefusedText):
        enrich._embed_batch(["a"], broken)


def test_embed_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (2, " "), (3, "a b")], "id int, t string")
    rows = enrich.embed_rows(df, "t", HashingEmbedder(8), 300).orderBy("id").collect()
    assert rows[1].embedding is None and rows[0].embedding == rows[2].embedding
    assert abs(sum(v * v for v in rows[0].embedding) - 1) < 1e-6
    assert enrich.embedded_only(enrich.embed_rows(df, "t", HashingEmbedder(8))).count() == 2


def test_generated_and_template_text_agree(spark):
    df = spark.createDataFrame([(1, "Ann", 30), (2, "Bob", 40)], "id int, name string, age int")

    def down(row):
        raise OSError("no network")

    made = enrich.generate_text(df, down, enrich.PROFILE_FALLBACK, "bio", 2)
    plain = enrich.template_text(df, enrich.PROFILE_FALLBACK, "bio")
    text = "Hi, I'm Ann. I enjoy exploring new experiences and connecting with others."
    assert made.where("id = 1").first().bio == plain.where("id = 1").first().bio == text
    assert made.count() == 2


def test_lookup(spark):
    def service(key):
        if key == "3":
            raise KeyError(key)
        return None if key == "2" else 200

    rows = enrich.lookup_status(spark.createDataFrame([(1,), (2,), (3,)], "id int"), "id", service).collect()
    assert sorted((r.id, r.status, r.ok) for r in rows) == [("1", 200, True), ("2", None, False), ("3", None, False)]


@pytest.mark.parametrize("max_values", [10_000_000, 10])
def test_topk_equals_brute_force(spark, max_values):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(120, 6)).astype("float32")
    vectors[10] = vectors[11] = vectors[12]
    vectors[20] = 0
    ids = rng.permutation(1000)[:120]
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors, strict=True)]
    corpus = spark.createDataFrame(rows, "id bigint, vector array<float>").repartition(3)
    queries = corpus.where("id % 2 = 0")
    found = cosine_topk(corpus, queries, 4, 6, block_rows=17, max_values=max_values).collect()
    unit = vectors.astype("float64") / np.maximum(np.linalg.norm(vectors.astype("float64"), axis=1, keepdims=True), 1e-300)
    expected = set()
    for q in range(120):
        if ids[q] % 2 == 0:
            ranked = sorted((-round(float(unit[q] @ unit[c]), 6) + 0.0, int(ids[c])) for c in range(120) if c != q)[:4]
            expected |= {(int(ids[q]), n, -s + 0.0) for s, n in ranked}
    assert {(r.query_id, r.neighbor_id, round(r.score, 6) + 0.0) for r in found} == expected
    assert cosine_topk(corpus, queries.where("false"), 4, 6).count() == 0


def write_lines(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows) + "\n")


def test_embedding_stream_skips_known_keys_and_keeps_refused_events(spark, tmp_path):
    source, path, log = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "log")
    write_lines(source, "b.json", [{"id": 1, "title": "one"}, {"id": 2, "title": " "}, {"id": 0, "title": "zero"}])
    with (source / "b.json").open("a") as f:
        f.write('{"id": 9, \n')

    def drain():
        events = landing.event_stream(spark, str(source), schemas.PRODUCT, 1, text="refused_text")
        landing.land_embeddings(
            events, PRODUCTS, path, log, HashingEmbedder(4), str(tmp_path / "state"), drain=True, text="refused_text"
        ).awaitTermination()
        return sorted((r.id, r.title) for r in spark.read.parquet(path).collect())

    assert drain() == [(1, "one")]
    write_lines(source, "a.json", [{"id": 1, "title": "changed"}, {"id": 3, "title": "three"}, {"id": 3, "title": "drei"}])
    assert drain() == [(1, "one"), (3, "three")]
    assert drain() == [(1, "one"), (3, "three")]
    rejects = spark.read.parquet(f"{log}/rejects").collect()
    assert sorted((r.reject_reason, r.refused_text) for r in rejects) == [
        ("Invalid webhook: Empty product title", None), ("Invalid webhook: Invalid product ID", None), ("not a document of this schema", '{"id": 9, '),
    ]
    report = spark.read.parquet(f"{log}/report").drop("batch").groupBy().sum().first()
    assert [report[f"sum({n})"] for n in ("n_total", "n_invalid", "n_skipped", "n_repeated", "n_failed", "n_embedded")] == [7, 3, 1, 1, 0, 2]


def test_batch_that_is_done_is_not_done_again(spark, tmp_path):
    source, path, log = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "log")
    write_lines(source, "a.json", [{"id": 1, "title": "one"}])
    for state in ("s1", "s2"):
        # A new checkpoint numbers its batches from 0: the batch with the same number and log is the repeated one.
        events = landing.event_stream(spark, str(source), schemas.PRODUCT)
        landing.land_embeddings(events, PRODUCTS, path, log, HashingEmbedder(4), str(tmp_path / state), drain=True).awaitTermination()
    assert spark.read.parquet(f"{log}/report").select("n_embedded", "n_skipped").collect() == [(1, 0)]
    assert spark.read.parquet(path).count() == 1


class Picky:
    """Refuses the text ``no``."""

    def __call__(self, texts):
        if "no" in texts:
            raise RefusedText("The input token count exceeds the limit")
        return [[1.0]] * len(texts)


def test_embedding_run_reports_every_record(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("one", 1), ("eins", 1), ("no", 2), (" ", 3), ("x", 0), ("y", None), ("four", 4)], schemas.PRODUCT)
    run = records.embed_upsert(rows, PRODUCTS, path, Picky(), 2)
    assert run.report == {"n_total": 7, "n_invalid": 3, "n_skipped": 0, "n_repeated": 1, "n_failed": 1, "n_embedded": 2, "n_batches": 2}
    assert sorted(r.reject_reason for r in run.rejects.collect()) == ["Invalid webhook: Empty product title"] + ["Invalid webhook: Invalid product ID"] * 2
    assert [(r.id, r.title) for r in run.failed.collect()] == [(2, "no")]
    again = records.embed_upsert(rows, PRODUCTS, path, Picky(), 2)
    assert again.report == {"n_total": 7, "n_invalid": 3, "n_skipped": 3, "n_repeated": 0, "n_failed": 1, "n_embedded": 0, "n_batches": 1}
    assert sorted((r.id, r.title) for r in spark.read.parquet(path).collect()) == [(1, "one"), (4, "four")]


def test_raw_stream(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "a.json", [{"x": 1}, {"x": 2}])
    write_lines(source, "b.json", [{"x": 1}])
    out = str(tmp_path / "out")
    for _ in range(2):
        landing.land_raw(landing.payload_stream(spark, str(source), 1), out, f"{out}-state", drain=True).awaitTermination()
    write_lines(source, "c.json", [{"x": 2}, {"x": 3}])
    landing.land_raw(landing.payload_stream(spark, str(source), 1), out, f"{out}-state", drain=True).awaitTermination()
    stored = landing.read_raw(spark, out)
    assert sorted(r.payload for r in stored.collect()) == ['{"x": 1}', '{"x": 2}', '{"x": 3}']
    assert "Exchange" not in stored._jdf.queryExecution().executedPlan().toString()


def test_event_stream_keeps_rejects(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "a.json", [{"id": 1, "title": "t"}, {"id": 0, "title": ""}])
    out = str(tmp_path / "out")
    events = landing.event_stream(spark, str(source), schemas.PRODUCT)
    landing.land_events(events, PRODUCTS.flagged, PRODUCTS.named, out, f"{out}-state", drain=True).awaitTermination()
    assert [r.file_name for r in landing.read_landed(spark, out, "valid").collect()] == ["product-1.jsonl"]
    assert [r.reject_reason for r in landing.read_landed(spark, out, "rejected").collect()] == [
        "Invalid webhook: Invalid product ID, Empty product title"
    ]


def test_speakers_are_read_again_for_every_batch(spark, tmp_path):
    source, dimension, out = tmp_path / "in", str(tmp_path / "dim"), str(tmp_path / "out")

    def publish(email):
        rows = [(0, "Ann", email, ["A"])]
        spark.createDataFrame(rows, "idx int, name string, email string, aliases array<string>").write.mode("overwrite").parquet(dimension)

    def drain():
        events = landing.event_stream(spark, str(source), "said string")
        landing.land_resolved(
            events, "said", lambda session: session.read.parquet(dimension), "idx", out, f"{out}-state", drain=True
        ).awaitTermination()
        return sorted(r.speaker for r in spark.read.parquet(out).collect())

    publish("old@x.com")
    write_lines(source, "a.json", [{"said": "ann"}])
    assert drain() == ["old@x.com"]
    publish("new@x.com")
    write_lines(source, "b.json", [{"said": "A"}, {"said": "Bo"}])
    assert drain() == ["Bo", "new@x.com", "old@x.com"]


def test_backfill_asks_once_per_open_id(spark, tmp_path):
    log = tmp_path / "asked"

    def service(key):
        with log.open("a") as f:
            f.write(key + "\n")
        return None if key == "rec_3" else 200

    ids = spark.createDataFrame([("rec_1",), ("rec_2",), ("rec_3",)], "id string")
    good, bad = Ledger(spark, str(tmp_path / "good"), "id"), Ledger(spark, str(tmp_path / "bad"), "id")
    good.add(ids.where("id = 'rec_2'"))
    records.backfill(ids, "id", good, bad, service, str(tmp_path / "run1"))
    assert sorted(log.read_text().split()) == ["rec_1", "rec_3"]
    records.backfill(ids, "id", good, bad, service, str(tmp_path / "run2"))
    assert sorted(log.read_text().split()) == ["rec_1", "rec_3", "rec_3"]
    assert [r.id for r in good.export().collect()] == ["rec_1", "rec_2"]
    assert [r.id for r in bad.export().collect()] == ["rec_3"]


def test_scratch_path_needs_a_shared_folder(spark):
    from touchpoint.session import scratch_path

    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert spark.range(1).select(F.lit(1)).count() == 1


def test_nearest_rows_are_screened_without_loss():
    """Copies, zero vectors and own ids; the same rows as sorting all scores, in blocks of any order, without a score of every pair being sorted."""
    source = np.random.default_rng(5)
    vectors = source.normal(size=(6000, 8))
    vectors[100:900] = vectors[100]
    vectors[2000:2100] = 0
    ids = source.permutation(6000)
    asked = np.r_[0:40, 100:110, 2000:2003, 5990:6000]
    unit = similarity._unit(vectors)
    nearest = similarity._Nearest(ids[asked], unit[asked], 5, 50_000)
    for part in np.array_split(source.permutation(6000), 4):
        nearest.add(ids[part], vectors[part])
    scores = np.round(unit[asked] @ unit.T, 6)
    scores[ids[asked][:, None] == ids] = -np.inf
    true = {(q, ids[c], rank) for q, row in zip(ids[asked], scores, strict=True) for rank, c in enumerate(np.lexsort((ids, -row))[:5])}
    got = nearest.frame().sort_values(["query_id", "score", "neighbor_id"], ascending=[True, False, True])
    got["rank"] = got.groupby("query_id").cumcount()
    assert set(zip(got["query_id"], got["neighbor_id"], got["rank"], strict=True)) == true


def test_blocks_of_a_search_are_few(spark):
    """Every row is copied once for each block of the other side."""
    rows = spark.range(9000).select("id", F.array(F.sin("id"), F.cos("id")).cast("array<float>").alias("vector"))
    pairs = similarity._blocked(rows, rows, 1, 2, None).rdd.getNumPartitions()
    assert pairs <= (similarity.isqrt(similarity.PAIRS_A_SLOT * spark.sparkContext.defaultParallelism) + 1) ** 2
