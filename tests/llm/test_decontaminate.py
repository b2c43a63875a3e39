"""Containment search against comparing every item with every document."""

import re

import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import ODD, documents, words
from touchpoint.llm import decontaminate

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(docs, items, k=5, percent=80, least_words=1):
    def length(text):
        n = len(re.findall(WORD, text.lower()))
        return n if least_words <= n < k else k

    sets = [(i, length(t), decontaminate.word_shingles(t.lower().encode(), length(t))) for i, t in items if i is not None and t is not None]
    out = []
    for d, text in docs:
        own = {n: decontaminate.word_shingles((text or "").lower().encode(), n) for n in {n for _, n, s in sets if s}}
        out += [(d, i, len(s & own[n]), len(s)) for i, n, s in sets if s and 100 * len(s & own[n]) >= percent * len(s)]
    return sorted(out, key=repr)


def data():
    items = [(i, " ".join(words(8 + 7 * i, 50 + i))) for i in range(12)] + [(20, "two words"), (21, ""), (22, None), (None, "no id here at all"), (23, "one two three four five"), (24, "one two three four five"), (25, "cc DD ee ff"), (26, "Zz"), (27, "cc dd, ee")]
    docs = [(i, t) for i, t in enumerate(ODD)] + [(100, "TWO, words!"), (101, "one Two three-four five"), (None, "one two three four five")]
    docs += [(110, "aa bb cc dd ee ff gg"), (111, "cc dd ee"), (112, " ".join([*words(400, 9), "Two", "words", "zz"])), (113, "dd cc ee ff")]
    for i, text in items[:12]:
        own = text.split()
        docs.append((200 + i, " ".join(words(300, i) + own + words(300, i + 1))))
        docs.append((300 + i, " ".join(words(30, i) + own[: len(own) * 17 // 20] + words(30, i))))
        docs.append((400 + i, " ".join(own[: len(own) // 2])))
        docs.append((500 + i, " ".join(own[:3] + ["changed"] + own[4:]).upper()))
    return docs + docs[-2:], items


@pytest.mark.parametrize("keys", [1_000_000, 8])
def test_equals_all_pairs(spark, monkeypatch, keys):
    """Eight keys a block force many passes."""
    monkeypatch.setattr(decontaminate, "LOCAL_KEYS", keys)
    docs, items = data()
    if keys == 8:
        items = items[:4] + items[12:]
    table = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit("mine"))
    got = decontaminate.contained_items(documents(spark, docs), table)
    assert sorted((tuple(r)[:4] for r in got.collect()), key=repr) == brute(docs, items)


def test_clean_documents_stay(spark):
    docs, items = data()
    table = spark.createDataFrame(items, "item_id bigint, text string")
    leaked = {d for d, *_ in brute(docs, items, least_words=5)}
    frame = documents(spark, docs).withColumn("item_id", F.lit("mine"))
    kept = decontaminate.clean_documents(frame, table)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((d for d, _ in docs if d not in leaked), key=repr)


def test_short_items_inside_long_documents(spark):
    """Items of one to four words are found by shingles of their own length, and clean documents only if asked to."""
    docs, items = data()
    table = spark.createDataFrame(items, "item_id bigint, text string")
    got = {tuple(r)[:2] for r in decontaminate.contained_items(documents(spark, docs), table).where("item_id in (20, 25, 26, 27)").collect()}
    assert got == {(100, 20), (112, 20), (110, 25), (112, 26), (110, 27), (111, 27)}
    kept = {r["doc_id"] for r in decontaminate.clean_documents(documents(spark, docs), table, least_words=3).collect()}
    assert {110, 111}.isdisjoint(kept) and {112, 113} <= kept


@pytest.mark.parametrize("keys", [1_000_000, 40])
def test_blocks_clean_alike(spark, monkeypatch, keys):
    monkeypatch.setattr(decontaminate, "LOCAL_KEYS", keys)
    docs, items = data()
    table = spark.createDataFrame(items[:4] + items[12:], "item_id bigint, text string")
    leaked = {d for d, *_ in brute(docs, items[:4] + items[12:], least_words=5)}
    kept = decontaminate.clean_documents(documents(spark, docs), table)
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((d for d, _ in docs if d not in leaked), key=repr)


def test_empty_tables(spark):
    docs, items = data()
    table = spark.createDataFrame(items, "item_id bigint, text string")
    assert decontaminate.contained_items(documents(spark, []), table).count() == 0
    assert decontaminate.contained_items(documents(spark, docs), table.where("false")).count() == 0
    assert decontaminate.clean_documents(documents(spark, docs), table.where("false")).count() == len(docs)
