"""Small tables for the operator tests."""

from __future__ import annotations

import random
import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, texts, start=1):
    """Documents with ids from ``start``; a text may come as ``(id, text)``."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts, start)]
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)


def words(n, seed):
    source = random.Random(seed)
    return [source.choice("abcdefghij") + str(source.randrange(5000)) for _ in range(n)]


def lowered(text, pattern):
    return re.findall(pattern, (text or "").translate(ASCII_LOWER))


def shingle_set(text, k, pattern=r"[^\x20\x09-\x0D]+"):
    found = lowered(text, pattern)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i:i + k]) for i in range(max(len(found) - k, 0) + 1))


#: Texts that every operator must take: null, empty, blank, one word, other scripts, controls, a long word, a long text.
ODD = [None, "", "  \n\t ", "x", "ÄÖ ß 日本語 𝄞", "\x00\x01 a b", "y" * 5000, " ".join(words(20_000, 5)), "x", "x"]
