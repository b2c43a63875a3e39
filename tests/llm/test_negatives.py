"""Hard negatives against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchpoint.llm import negatives

VECTORS = "vec_id bigint, label bigint, embedding array<double>"


def plain(rows, anchors, n_positives=5, n_negatives=10, low=30, high=90, scale=256):
    kept = {}
    for i, label, vector in rows:
        if None in (i, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept[i] = min(kept.get(i, (label, vector)), (label, vector))
    whole = {i: [math.floor(scale * x) for x in v] for i, (_, v) in kept.items()}
    out = []
    for a in sorted(i for i in kept if anchors(i)):
        scores = [(-sum(x * y for x, y in zip(whole[a], whole[i], strict=True)), i) for i in kept if i != a and len(whole[i]) == len(whole[a])]
        scores = sorted((max(-negatives._LARGEST, min(negatives._LARGEST, s)), i) for s, i in scores)
        for p, positive in [x for x in scores if kept[x[1]][0] == kept[a][0]][:n_positives]:
            window = [x for x in scores if kept[x[1]][0] != kept[a][0] and low * -p <= 100 * -x[0] <= high * -p]
            out += [(a, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(window[:n_negatives], 1)]
    return sorted(out)


def found(spark, rows, **how):
    frame = spark.createDataFrame(rows, VECTORS).withColumn("slot", F.lit("x")).withColumn("row_block", F.lit(1)).withColumn("id", F.lit(None).cast("int"))
    return sorted(tuple(r) for r in negatives.mine(frame, F.col("id") % 10 == 0, **how).collect())


def clusters(n, labels, size, seed, scale=1.0):
    source = np.random.default_rng(seed)
    centres = source.standard_normal((labels, size))
    return [(i, i % labels, (scale * (centres[i % labels] + centres[(i + 1) % labels] * 0.6 + source.standard_normal(size) * 0.7)).tolist()) for i in range(n)]


@pytest.mark.parametrize("how", [{}, {"n_positives": 3, "n_negatives": 2, "low": 10, "high": 99}, {"n_positives": 1, "scale": 4}])
def test_equals_plain(spark, monkeypatch, how):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 70)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 9)
    monkeypatch.setattr(negatives, "SCORED_ANCHORS", 4)
    rows = clusters(400, 4, 8, 1)
    expected = plain(rows, lambda i: i % 10 == 0, **how)
    assert expected and found(spark, rows, **how) == expected


def test_copies_ties_and_odd_rows(spark):
    source = random.Random(2)
    rows = [(i, i % 3, [float(source.choice([0.25, 0.5, 1.0])) for _ in range(3)]) for i in range(150)]
    rows += [(i, 1, [1.0, 1.0, 1.0]) for i in range(200, 290)] + [(i, 2, [0.75, 0.75, 0.75]) for i in range(300, 390)]
    rows += [(None, 1, [1.0, 1.0, 1.0]), (400, None, [1.0, 1.0, 1.0]), (410, 1, None), (420, 1, [1.0, None, 1.0]), (430, 1, [float("nan"), 1.0, 1.0]), (440, 1, [float("inf"), 1.0, 1.0])]
    rows += [(450, 1, []), (451, 2, []), (460, 1, [1.0, 1.0]), (461, 2, [1.0, 0.5]), (470, 1, [1.0, 1.0]), (10, 1, [1.0, 1.0, 1.0]), (10, 1, [1.0, 1.0, 1.0]), (10, 0, [9.0, 0.0, 0.0]), (480, 1, [-1.0, -1.0, -1.0])]
    assert found(spark, rows) == plain(rows, lambda i: i % 10 == 0)


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(i, i % 2, [1e7 * (20 - i) + i, 3e6 + i]) for i in range(20)] + [(30, 0, [1e17, 1.0]), (31, 1, [1e17, 5.0]), (32, 0, [9e16, 1.0])]
    assert found(spark, rows) == plain(rows, lambda i: i % 10 == 0)


def test_few_rows(spark):
    assert found(spark, [(0, 1, [1.0]), (1, 1, [1.0])]) == []
    assert found(spark, [(0, 1, [1.0]), (1, 2, [0.5])]) == []
    assert found(spark, []) == []


def test_windows_overlap_and_share_limits():
    assert [negatives.limits(p, 30, 90) for p in (0, 1, 10, 101, -10)] == [(0, 0), (1, 0), (3, 9), (31, 90), (-3, -9)]
