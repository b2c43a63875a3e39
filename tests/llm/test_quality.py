"""Classifier: held-out accuracy, flattened trees against plain traversal, statistics against plain counting."""

import numpy as np
from pyspark.sql import functions as F

from tests.llm.fixtures import ODD, documents, words
from touchpoint.llm import quality

SF = "/root/testdata/sf0.01"


def slice_of(texts):
    data = [(t or "").encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    trees = quality.train(docs, labels.where(~quality.held_out()))
    rows = quality.score(docs.select("doc_id", "text"), trees).where(quality.held_out()).join(labels, "doc_id").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert good and bad
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_trees_equal_plain_traversal():
    source = np.random.default_rng(1)
    x = source.standard_normal((600, 5))
    y = (x[:, 1] + x[:, 3] ** 2 > 0.8).astype(float)
    trees = quality.fit(x, y, n_trees=15)
    assert np.mean((trees.score(x) > 0.5) == y) > 0.9
    for row, score in zip(x[:50], trees.score(x[:50]), strict=True):
        total = trees.base
        for t in range(len(trees.feature)):
            node = 0
            while trees.left[t][node] != node:
                node = trees.left[t][node] if row[trees.feature[t][node]] <= trees.threshold[t][node] else trees.right[t][node]
            total += trees.value[t][node]
        assert abs(1 / (1 + np.exp(-total)) - score) < 1e-12


def test_statistics_do_not_depend_on_neighbours():
    texts = [*ODD, "One two. ONE two!\nline\nline\nlast 12", "### ***"]
    together = quality.statistics(*slice_of(texts))
    alone = np.concatenate([quality.statistics(*slice_of([t])) for t in texts])
    assert np.allclose(together, alone)
    row = dict(zip(quality.STATISTICS, together[-2], strict=True))
    assert np.isclose(row["distinct_words"], 6 / 8) and np.isclose(row["repeated_line_bytes"], 4 / len(texts[-2]))
    assert np.isclose(row["share_upper"], 4 / len(texts[-2])) and np.isclose(row["top_word"], 2 / 8)


def test_odd_rows_get_a_score(spark):
    docs = documents(spark, ODD).withColumn("score", F.lit("mine")).withColumn("label", F.lit(0))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 11)] + [(None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    rows = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert rows[0]["score"] == rows[1]["score"]


def test_no_labels_one_class_empty_table(spark):
    docs = documents(spark, [" ".join(words(30, i)) for i in range(5)])
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in quality.score(docs, quality.train(docs, labels.where("false"))).collect()} == {0.5}
    assert min(r["score"] for r in quality.score(docs, quality.train(docs, labels)).collect()) > 0.99
    assert quality.score(docs.where("false"), quality.train(docs, labels)).count() == 0


def test_repeated_rows_and_labels_train_once(spark):
    """Neither rows that repeat an id nor labels that disagree raise the number of training rows above the bound."""
    texts = [(1, "one text here")] * 500 + [(2, "another text")] * 3 + [(2, "and yet another"), (3, "third"), (None, "no id")]
    docs = documents(spark, texts).repartition(4)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 1), (3, 1), (9, 1), (None, 0)], "doc_id bigint, quality int")
    rows = quality.training_rows(docs, labels).collect()
    assert sorted(r["label"] for r in rows) == [0, 1, 1]
    smallest = min(list(map(float, quality.statistics(*slice_of([t]))[0])) for t in ("another text", "and yet another"))
    assert smallest in [r["statistics"] for r in rows]
    assert quality.training_rows(docs, labels, max_rows=2).count() <= 2
