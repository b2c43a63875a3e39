"""Language-model scores: base scores and counts against plain Python, the filter, shards, held-out texts."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import DOCS, ODD, documents, lowered, words
from touchpoint.llm import lm
from touchpoint.llm.rolling import U64

LEARN = "crc32(cast(doc_id as string)) % 7 <> 2"


def tokens(text):
    return [*lowered(text, r"[^\x20\x09-\x0D]+"), 0]


def learnt_from(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2


def level_middle(count, base=1.5):
    least = lm.thresholds(base)
    return lm.middles(least)[np.searchsorted(least, count, "right")]


def plain(docs, mu=200.0):
    """Counts and base scores; the model with exact membership instead of the filter."""
    train = [["<s>", *tokens(t)] for i, t in docs if learnt_from(i)]
    one, two = Counter(w for t in train for w in t), Counter(p for t in train for p in zip(t, t[1:], strict=False))
    n, v = sum(c for w, c in one.items() if w != "<s>"), len(set(one) - {"<s>"})
    out = []
    for doc_id, text in docs:
        own = ["<s>", *tokens(text)]
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in own[1:])
        score = 0.0
        for a, b in zip(own, own[1:], strict=False):
            p = (level_middle(one[b]) + 1) / (n + v + 1)
            context = level_middle(one[a])
            score += math.log10((min(level_middle(two[a, b]), context) + mu * p) / (context + mu))
        out.append((doc_id, len(own) - 1, sum(one[w] > 0 for w in own[1:]), n, base, score))
    return out


def prose(n, seed):
    source = random.Random(seed)
    start = words(40, 1)
    after = {w: source.sample(start, 4) for w in start}
    out = []
    for _ in range(n):
        text = [source.choice(start)]
        while len(text) < 60:
            text.append(source.choice(after[text[-1]]) if source.random() < 0.8 else source.choice(start))
        out.append(" ".join(text))
    return out


def check(rows, expected, exact_model):
    rows = sorted((tuple(r) for r in rows), key=lambda r: (str(r[0]), r[4]))
    expected = sorted(expected, key=lambda r: (str(r[0]), r[4]))
    assert [r[:4] for r in rows] == [r[:4] for r in expected]
    assert np.allclose([r[4] for r in rows], [r[4] for r in expected], rtol=1e-9)
    mine, theirs = np.array([r[5] for r in rows]), np.array([r[5] for r in expected])
    if exact_model:
        assert np.allclose(mine, theirs, rtol=1e-9)
    else:
        # Errors of the filter only raise levels; per token they matter little.
        assert abs(mine - theirs).sum() < 0.05 * sum(r[1] for r in rows)


@pytest.mark.parametrize("head", [lm.HEAD_TOKENS, 30, 0])
def test_equals_plain(spark, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD_TOKENS", head)
    monkeypatch.setattr(lm, "FLUSH_NGRAMS", 500)
    texts = [*prose(60, 3), *ODD, "A a\tB\x0bb", "rare word one", "rare word two"]
    docs = [*enumerate(texts), (3, texts[3]), (3, texts[3]), (None, "a b"), (None, None)]
    frame = documents(spark, docs).withColumn("row", F.lit("x")).withColumn("levels", F.lit(1)).withColumn("score", F.lit("y"))
    expected = plain(docs)
    # With 30 probes the filter makes no error on so few n-grams: the model is that of exact membership.
    check(lm.score_documents(frame, LEARN, probes=30).collect(), expected, True)
    check(lm.score_documents(frame, LEARN).collect(), expected, False)


def test_shards_do_not_change_the_scores(spark, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 1500)
    docs = documents(spark, [*enumerate([*prose(80, 5), *ODD])])
    for order in (1, 3):
        learnt = lm.learn(docs.where(LEARN), order)
        assert learnt.bucket_bits > 2
        total = learnt.bitmaps.agg(F.sum(F.octet_length("bits"))).first()[0]
        whole, parts = (sorted((tuple(r) for r in lm.score(docs, learnt, size).collect()), key=str) for size in (1 << 30, total // 3))
        assert len(list(learnt.shards(total // 3))) in (3, 4)
        assert whole == parts


def test_empty_and_nothing_to_learn_from(spark):
    assert lm.score_documents(spark.createDataFrame([], DOCS), LEARN).collect() == []
    rows = lm.score_documents(documents(spark, ["a b", None]), F.lit(False)).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]


def test_held_out_texts_are_likelier_than_shuffled_ones(spark):
    texts = prose(400, 7)
    source = random.Random(1)
    mixed = [" ".join(source.sample(t.split(), len(t.split()))) for t in texts[:60]]
    docs = documents(spark, [*enumerate(texts), *enumerate(mixed, 1000)])
    learnt = lm.learn(docs.where(LEARN).where("doc_id < 1000"))
    score = {r["doc_id"]: (r["score"], r["base_score"]) for r in lm.score(docs, learnt).collect()}
    held = [i for i in range(60) if not learnt_from(i)]
    assert held and all(score[i][0] > score[1000 + i][0] + 1 for i in held)
    assert all(score[i][0] > score[i][1] for i in held)


def test_filter_has_no_false_negatives_and_few_errors():
    source = np.random.default_rng(4)
    keys = np.unique(source.integers(0, 1 << 63, 60_000).astype(U64) * U64(2))
    counts = np.maximum(1, source.pareto(1.0, len(keys)).astype(np.int64))
    least = lm.thresholds(1.5)
    stored = lm.bitmap(keys, counts, least, 5)
    shard = lm.Shard(0, 0, np.array([0, len(stored)]), stored, 5)
    true, got = np.searchsorted(least, counts, "right"), shard.levels(keys)
    assert (got >= true).all() and (got > true).mean() < 0.05 and (got > true + 1).mean() < 0.004
    absent = np.setdiff1d(source.integers(0, 1 << 63, 60_000).astype(U64), keys)
    assert (shard.levels(absent) > 0).mean() < 0.05
    assert len(stored) * 8 < 7.3 * true.sum()


def test_levels_and_middles():
    least = lm.thresholds(1.5)
    assert least[:8].tolist() == [1, 2, 3, 4, 6, 8, 12, 18]
    middle = lm.middles(least)
    assert middle[0] == 0 and middle[1] == 1 and middle[3] == 3 and 4 <= middle[4] <= 5
