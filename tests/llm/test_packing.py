"""Packing: every token once, gapless sequences of power-of-two sizes, ids as the tokenizer gives them."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.fixtures import ODD, documents, words
from touchpoint.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 700), max_size=60))
def test_pack_covers_every_token_once(lengths):
    sequences = packing.pack(lengths, 128)
    covered = [np.zeros(n, int) for n in lengths]
    for sequence in sequences:
        size = sum(p[2] for p in sequence)
        assert 0 < size <= 128 and size & (size - 1) == 0
        for document, start, length in sequence:
            assert length > 0
            covered[document][start:start + length] += 1
    assert all((c == 1).all() for c in covered)


def test_whole_tails_are_preferred():
    sequences = packing.pack([1500, 500, 48, 900, 124], 2048)
    assert sum(len(s) for s in sequences) <= 7
    assert sorted(sum(p[2] for p in s) for s in sequences)[-1] == 2048


@pytest.mark.parametrize("block", [4_000_000, 3_000])
def test_pieces_are_the_tokenizers_ids(spark, monkeypatch, block):
    monkeypatch.setattr(packing, "BLOCK_TOKENS", block)
    from tokenizers import Tokenizer

    texts = [*ODD, "It's <|endoftext|> á b ́x\n\nNEXT", *(" ".join(words(n, n)) for n in (5, 300, 900, 2500))]
    docs = documents(spark, [(i, t) for i, t in enumerate(texts)] + [(None, "lost id"), (3, "x")])
    rows = packing.pack_documents(docs.withColumn("offset", F.lit("mine")).withColumn("start", F.lit(1)), PATH).collect()
    tokenizer = Tokenizer.from_file(PATH)
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    ids[None] = [*tokenizer.encode("lost id", add_special_tokens=False).ids, 1]
    covered = {i: 0 for i in ids}
    by_sequence = {}
    for r in rows:
        part = np.array(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4")
        assert (len(part), zlib.crc32(part.tobytes()), len(ids[r["doc_id"]])) == (r["length"], r["ids_crc32"], r["doc_tokens"])
        covered[r["doc_id"]] += r["length"]
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert covered == {i: len(x) * (2 if i == 3 else 1) for i, x in ids.items()}
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0


def test_steps_are_balanced(spark, monkeypatch):
    monkeypatch.setattr(packing, "STEP_TOKENS", 4096)
    docs = documents(spark, [" ".join(words(700, i)) for i in range(40)]).coalesce(1)
    packed = packing.pack_documents(docs, PATH)
    steps = packed.groupBy("step_id").agg(F.sum("length").alias("n"), F.count_distinct("context_size").alias("sizes"), F.max("context_size").alias("size")).collect()
    assert all(s["sizes"] == 1 and s["n"] <= 4096 for s in steps)
    assert sum(s["n"] == 4096 for s in steps) >= len(steps) // 2


def test_empty_table(spark):
    assert packing.pack_documents(documents(spark, []), PATH).count() == 0
