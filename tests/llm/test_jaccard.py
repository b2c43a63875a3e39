"""Parity-sketch join against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import ODD, documents, shingle_set, words
from touchpoint.llm import jaccard
from touchpoint.llm.components import components


def brute(rows, percent, k):
    sets = [(i, shingle_set(t, k)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), None if i is None else find(i)) for i, s in sets if i is not None) + [(None, len(s), None) for i, s in sets if i is None]


def edited(base, n, seed):
    source, out = random.Random(seed), list(base)
    for _ in range(n):
        out[source.randrange(len(out))] = f"z{source.randrange(10**6)}"
    return " ".join(out)


def result(spark, docs, percent, k):
    rows, _ = jaccard.similar_classes(docs, percent, k)
    got = [tuple(r) for r in rows.select("doc_id", "n_shingles", "component_id").collect()]
    return sorted(r for r in got if r[0] is not None) + [r for r in got if r[0] is None]


@pytest.mark.parametrize(("percent", "k"), [(85, 4), (80, 5)])
def test_equals_all_pairs(spark, percent, k):
    texts = [(i, t) for i, t in enumerate(ODD)]
    for family in range(6):
        base = words([3, 8, 25, 60, 200, 600][family], family)
        texts += [(100 * family + 50 + i, edited(base, i % 9, 31 * family + i)) for i in range(24)]
    texts += [(None, "x"), (None, None), (7000, texts[30][1]), (7000, texts[30][1])]
    assert result(spark, documents(spark, texts), percent, k) == brute(texts, percent, k)


def test_chains_and_hidden_links(spark):
    """Neighbours in a chain of growing edits resemble each other, its ends do not; all have keys in common."""
    base, texts = words(120, 9), []
    for i in range(40):
        texts.append((1000 - i, " ".join(base)))
        base = list(base)
        base[(7 * i) % 120] = f"q{i}"
    assert result(spark, documents(spark, texts), 85, 4) == brute(texts, 85, 4)


def test_empty_table_and_extra_columns(spark):
    empty = documents(spark, []).withColumn("component_id", F.lit("mine")).withColumn("key", F.lit(1)).withColumn("rep", F.lit(2))
    assert result(spark, empty, 85, 4) == []
    one = documents(spark, ["a b c d e"]).withColumn("component_id", F.lit("mine")).withColumn("a", F.lit(1)).withColumn("local", F.lit(2))
    assert result(spark, one, 85, 4) == [(1, 2, 1)]


def test_sketches_bound_the_symmetric_difference():
    source = np.random.default_rng(1)
    for _ in range(50):
        a = np.unique(source.integers(0, 1 << 62, 300).astype(np.uint64))
        b = np.unique(np.concatenate((a[source.integers(0, 40):], source.integers(0, 1 << 62, source.integers(1, 40)).astype(np.uint64))))
        distance = sum(bin(int(x) & (2**64 - 1)).count("1") for x in jaccard.bit_sketch(a) ^ jaccard.bit_sketch(b))
        assert distance <= len(np.setxor1d(a, b))


def test_similar_sets_share_a_key():
    layouts, source = jaccard.Layouts(85), np.random.default_rng(2)
    for size in [*range(1, 60), 100, 500, 2000]:
        for _ in range(5):
            a = np.unique(source.integers(0, 1 << 62, size).astype(np.uint64))
            most = 15 * 2 * len(a) // 185
            gone = source.integers(0, most // 2 + 1)
            b = np.unique(np.concatenate((a[gone:], source.integers(0, 1 << 62, source.integers(0, most // 2 + 1)).astype(np.uint64))))
            shared = len(np.intersect1d(a, b))
            if len(b) and 100 * shared >= 85 * (len(a) + len(b) - shared):
                with np.errstate(over="ignore"):
                    assert np.intersect1d(layouts.keys(a), layouts.keys(b)).size


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 101), (200, 200), (None, 3)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100, 200: 200}
    assert components(links.where("false")).count() == 0
