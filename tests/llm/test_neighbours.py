"""Forest search: recall against brute force, ties, copies, odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchpoint.llm import neighbours

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute(rows, query, top):
    ids = [i for i, v in rows if i is not None and i != query]
    own = {i: np.array(v, np.float64) for i, v in rows}
    score = {i: own[i] @ own[query] / np.sqrt((own[i] @ own[i]) * (own[query] @ own[query])) for i in set(ids) if len(own[i]) == len(own[query])}
    return sorted(score.items(), key=lambda x: (-round(x[1], 12), x[0]))[:top]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def test_recall_on_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = neighbours.search(table.withColumn("score", F.lit("mine")).withColumn("uid", F.lit(1)), F.col("vec_id") % 50 == 0)
    vectors = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in table.collect()}
    assert neighbours.recall_against(got, vectors, 5) >= 0.9
    for r in got.collect():
        a, b = vectors[r["query_id"]], vectors[r["vec_id"]]
        assert abs(r["score"] - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_copies_ties_and_odd_vectors(spark):
    source = np.random.default_rng(1)
    base = source.standard_normal((3, 6)).astype(np.float32)
    rows = [(i, base[i % 3].tolist()) for i in range(60)] + [(100, (base[0] * 2).tolist()), (100, (base[0] * 2).tolist())]
    good = list(rows)
    rows += [(150, None), (200, []), (201, [0.0] * 6), (250, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (251, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0]), (252, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (None, base[0].tolist()), (300, [1.0, 2.0])]
    got = found(neighbours.search(frame(spark, rows), F.col("vec_id") % 50 == 0))
    assert set(got) == {0, 50, 100}
    for query in (0, 50, 100):
        expected = brute(good, query, 5)
        assert [i for i, _ in got[query]] == [i for i, _ in expected]
        assert np.allclose([s for _, s in got[query]], [s for _, s in expected])


def test_few_candidates_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])]
    assert [i for i, _ in found(neighbours.search(frame(spark, rows), F.col("vec_id") == 0))[0]] == [1, 2]
    assert neighbours.search(frame(spark, rows[:1]), F.col("vec_id") == 0).count() == 0
    assert neighbours.search(frame(spark, []), F.col("vec_id") == 0).count() == 0
    assert neighbours.search(frame(spark, rows), F.col("vec_id") == 9).count() == 0


def test_chunks_do_not_change_the_result(spark, monkeypatch):
    source = np.random.default_rng(2)
    rows = [(i, source.standard_normal(8).tolist()) for i in range(300)]
    whole = found(neighbours.search(frame(spark, rows), F.col("vec_id") % 50 == 0, recall=1.0))
    monkeypatch.setattr(neighbours, "CHUNK_ROWS", 20)
    assert found(neighbours.search(frame(spark, rows), F.col("vec_id") % 50 == 0, recall=1.0)) == whole


def test_queries_that_no_probe_resembles_see_every_candidate(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PROBES", 8)
    source = np.random.default_rng(4)
    centre = source.standard_normal(12)
    rows = [(i, (centre + 0.02 * source.standard_normal(12)).tolist()) for i in range(1_500)]
    rows += [(1_500 + i, source.standard_normal(12).tolist()) for i in range(40)] + [(3_000 + i, source.standard_normal(7).tolist()) for i in range(30)]
    odd = [1_500, 1_507, 1_515, 1_523, 1_539, 3_000, 3_011]
    got = found(neighbours.search(frame(spark, rows), (F.col("vec_id") < 500) | F.col("vec_id").isin(odd)))
    for query in odd:
        expected = brute([(i, np.float32(v)) for i, v in rows], query, 5)
        assert [i for i, _ in got[query]] == [i for i, _ in expected]
    assert all(len(x) == 5 for x in got.values()) and len(got) == 507


def test_common_bits():
    a = np.array([0, 1, 1 << 47, 0b1010, 5], np.int64)
    b = np.array([0, 0, 0, 0b1000, 5], np.int64)
    assert neighbours.common_bits(a, b).tolist() == [48, 47, 0, 46, 48]


@pytest.mark.parametrize("depth", [0, 1, 7, 48])
def test_bounds_are_prefix_ranges(depth):
    keys = np.sort(np.random.default_rng(3).integers(0, 1 << 48, 500))
    low, high = neighbours._bounds(keys, keys[:20], depth)
    for key, a, b in zip(keys[:20], low, high, strict=True):
        assert set(range(a, b)) == set(np.flatnonzero(neighbours.common_bits(keys, np.full(500, key)) >= depth))
