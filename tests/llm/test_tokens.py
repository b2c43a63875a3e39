"""Token counts against the tokenizer library with the same vocabulary."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import ODD, documents, words
from touchpoint.llm import tokens

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")


def library(pieces):
    from tokenizers import Tokenizer, models, pre_tokenizers

    tokenizer = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return tokenizer


def noise(n, alphabet, seed):
    source = random.Random(seed)
    return ["".join(source.choice(alphabet) for _ in range(source.randrange(1, 40))) for _ in range(n)]


def test_public_vocabulary():
    pieces = tokens.vocabulary(PATH)
    texts = [t or "" for t in ODD] + noise(1500, list("ab .,!'é𝄞日▁\ns<>/0xA") + ["<unk>", "²."], 1) + [" ".join(words(300, 2)), "  lead", "trail  "]
    counter = tokens.UnigramCounter(pieces)
    assert [counter.count(t) for t in texts] == [len(e.ids) for e in library(pieces).encode_batch(texts)]


@pytest.mark.parametrize("seed", range(6))
def test_small_vocabularies_with_ties(seed):
    source = random.Random(seed)
    scores = [-1.0, -2.0, -3.0] if seed % 2 else [-0.5, -1.25, -1.75, -2.1]
    made = {"".join(source.choice("ab▁,") for _ in range(source.randrange(1, 5))) for _ in range(25)}
    pieces = [("<unk>", 0.0), *((p, source.choice(scores)) for p in sorted(made)), *((f"<0x{b:02X}>", -9.0) for b in range(256))]
    texts = noise(300, list("ab ,\ncé") + ["<unk>"], seed)
    counter = tokens.UnigramCounter(pieces)
    assert [counter.count(t) for t in texts] == [len(e.ids) for e in library(pieces).encode_batch(texts)]


def test_memory_of_chunks_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_CHUNKS", 10)
    counter, text = tokens.UnigramCounter(tokens.vocabulary(PATH)), " ".join(words(200, 3))
    assert counter.count(text) == len(library(tokens.vocabulary(PATH)).encode(text).ids) and len(counter) <= 10


def test_tables(spark):
    docs = documents(spark, ODD + [(None, "x")]).withColumn("n_tokens", F.lit("mine"))
    got = tokens.count_tokens(docs, PATH).collect()
    assert len(got) == len(ODD) + 1 and [r["n_tokens"] for r in got if r["doc_id"] in (1, 2)] == [0, 0]
    assert tokens.count_tokens(documents(spark, []), PATH).count() == 0
