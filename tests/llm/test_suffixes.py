"""Removal of repeated strings against counting all windows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import ODD, documents, words
from touchpoint.llm import rolling, suffixes


def brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    count = {}
    for _, b in data:
        for at in range(len(b) - length + 1):
            count[b[at:at + length]] = count.get(b[at:at + length], 0) + 1
    out = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for at in range(len(b) - length + 1):
            if count[b[at:at + length]] > 1:
                gone[at:at + length] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        spans = int((gone[1:] < gone[:-1]).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(docs, length):
    cut = suffixes.remove_repeats(docs, length)
    return sorted((tuple(r) for r in cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)


def texts():
    source = random.Random(4)
    passages = [" ".join(words(source.randrange(20, 90), i)) for i in range(8)]
    out = []
    for i in range(60):
        parts = [" ".join(words(source.randrange(0, 40), 1000 + i))]
        for _ in range(source.randrange(0, 3)):
            parts += [source.choice(passages)[source.randrange(0, 30):], " ".join(words(source.randrange(0, 20), i))]
        out.append((i, " ".join(parts)))
    return out + [(100, "é" * 300), (101, "abc" * 200), (102, "a" * 400), (103, "a" * 199), (104, "é" * 120)]


@pytest.mark.parametrize("limit", [2_000, 1])
def test_equals_counting(spark, monkeypatch, limit):
    """With a limit of 1 every anchor is crowded, which must not change the result."""
    monkeypatch.setattr(suffixes, "GROUP_LIMIT", limit)
    rows = texts() + [(i + 200, t) for i, t in enumerate(ODD)] + [(300, texts()[3][1])] * 3 + [(None, texts()[5][1])]
    assert result(documents(spark, rows), 200) == brute(rows, 200)


def test_long_texts_are_cut_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 700)
    rows = [(1, " ".join(words(900, 1))), (2, "head " + " ".join(words(900, 1))[1500:4200] + " tail"), (3, " ".join(words(300, 3)))]
    assert result(documents(spark, rows), 200) == brute(rows, 200)


def test_empty_table_and_clashing_columns(spark):
    extra = lambda df: df.withColumn("n_removed", F.lit("x")).withColumn("spans", F.lit(1)).withColumn("row_key", F.lit(2)).withColumn("anchor", F.lit(3))
    assert result(extra(documents(spark, [])), 200) == []
    rows = [(1, "a" * 250), (2, "b" * 250 + "c")]
    got = suffixes.remove_repeats(extra(documents(spark, rows)), 200)
    assert got.where("anchor = 3").count() == 2
    assert result(extra(documents(spark, rows)), 200) == brute(rows, 200)


def test_kept_text_has_whole_characters_only(spark):
    rows = [(1, "x" + "é" * 150 + "à"), (2, "y" + "é" * 150 + "è")]
    for row in suffixes.remove_repeats(documents(spark, rows), 200).collect():
        assert row["kept_text"] == bytes(row["kept"]).decode(errors="ignore")


def test_merge_sort_orders_suffixes():
    source = np.random.default_rng(3)
    data = np.concatenate([source.integers(97, 99, 400), np.full(200, 97)]).astype(np.uint8)
    place = source.permutation(len(data) - 20)[:300]
    group = np.sort(source.integers(0, 4, 300))
    with np.errstate(over="ignore"):
        order = suffixes.Suffixes(data, 20).merge_sort(place, group)
    keys = [(int(group[i]), bytes(data[place[i]:place[i] + 20])) for i in order]
    assert keys == sorted(keys)


def test_hash_collisions_remove_nothing(monkeypatch):
    """With hashes that cannot tell spans apart, only equal bytes count as repeated."""
    monkeypatch.setattr(rolling, "span_hashes", lambda prefix, start, end: np.zeros(len(start), np.uint64))
    data = np.frombuffer(b"abcdefgh" + b"abcdefgX", np.uint8)
    assert suffixes.repeated_windows(data, np.array([0, 8]), np.array([0, 0]), 8).tolist() == [False, False]
    assert suffixes.repeated_windows(data, np.array([0, 8]), np.array([0, 0]), 7).tolist() == [True, True]
