"""Importance resampling against plain Python."""

import hashlib
import math
import zlib

import numpy as np
import pytest

from tests.llm.fixtures import DOCS, ODD, documents, lowered, words
from touchpoint.llm import importance

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def features(text, longest):
    found = lowered(text, PATTERN)
    return [" ".join(found[i:i + n]) for n in range(1, longest + 1) for i in range(len(found) - n + 1)], len(found)


def plain(docs, target, percent=10, longest=1, buckets=10_000, min_words=20, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f in features(text, longest)[0]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    rows = []
    for doc_id, text in docs:
        own, n_words = features(text, longest)
        weight = sum(gain[bucket(f)] for f in own)
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, n_words, len(own), weight, score, None])
    able = sorted((r for r in rows if r[1] >= min_words and r[0] is not None), key=lambda r: (-r[4], r[0]))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[5] = rank
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("how", [{}, {"longest": 3, "percent": 55, "buckets": 97, "min_words": 3}])
def test_equals_plain(spark, how):
    texts = [" ".join(words(5 + 7 * i % 60, i % 11)) for i in range(120)] + ODD + ["w" * 300 + " b", "A  b\nC--d é " * 9]
    docs = [(i % 100, t) for i, t in enumerate(texts)] + [(None, texts[3]), (7, texts[7]), (7, texts[7])]
    target = [" ".join(words(50, 3)), None, "", "x"]
    got = importance.resample(documents(spark, docs), spark.createDataFrame([(t,) for t in target], "text string"), **how)
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    assert rows == plain(docs, target, **how)


def test_clashing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c", 9, 9, "x", 3)], "doc_id bigint, text string, rank int, score int, bucket string, part int")
    target = spark.createDataFrame([], "item_id bigint, text string")
    assert importance.resample(docs, target, percent=100, min_words=1).collect()[0]["rank"] == 1
    assert importance.resample(spark.createDataFrame([], DOCS), target).collect() == []


def test_crc_of_any_length():
    source = np.random.default_rng(3)
    lengths = np.concatenate((source.integers(0, 20, 300), [importance.LONG_FEATURE, importance.LONG_FEATURE + 1, 5_000]))
    data = source.integers(0, 256, lengths.sum(), dtype=np.uint8)
    starts = np.cumsum(lengths) - lengths
    expected = [zlib.crc32(data[a:a + n].tobytes()) for a, n in zip(starts, lengths, strict=True)]
    assert importance.crc32_by_length(data, starts, lengths).tolist() == expected


def test_draw_prefers_the_target(spark):
    docs = [(i, " ".join(words(40, i) if i % 4 else ["proof", "lemma", "theorem", "axiom"] * 10)) for i in range(200)]
    target = spark.createDataFrame([("lemma theorem proof axiom " * 5000,)], "text string")
    drawn = [r["doc_id"] for r in importance.resample(documents(spark, docs), target).where("rank is not null").collect()]
    assert len(drawn) == 20 and all(i % 4 == 0 for i in drawn)
