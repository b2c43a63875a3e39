"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is contained in a document if at least ``percent`` of the item's distinct word shingles occur in it.
Documents are far larger than items, so the search is driven by the items:

* Items are partitioned by the size q of their shingle set. For a size, an item may miss at most
  m = q - ceil(percent * q / 100) shingles, so any m + 1 of its shingles include one that a containing
  document has. The partition's signature is the m + 1 smallest hashes of the set (its bottom MinHash
  values): containment search without false negatives, with about 0.2 * q keys for 80 %.
* Documents are partitioned by size as well: a document with fewer shingles than the item must have is no
  candidate for that item's partition.
* A candidate is verified by counting the item's shingles in the document, word by word and not by hash.

The signatures go to the tasks while there are at most ``LOCAL_KEYS`` of them (counted): a task looks up all
shingles of a slice of texts at once. Beyond that, the items are searched in blocks of that many keys, each
block a pass over the documents whose result is written before the next but one is built; this bounds memory at any number
of items, and loses none.

Words are runs of letters and digits (any byte outside ASCII counts as a letter), in lower case. An item with
fewer than k words has a size partition of its own: it is one shingle of all its words, and documents are
searched for shingles of that length, so it is found inside long documents. Items below ``least_words`` are left out of
that and match documents of just their words. A text without words, or null, contains nothing and is contained in nothing. Repeated rows are searched like others; rows whose item_id is null are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpoint.llm import rolling
from touchpoint.llm.rolling import U64
from touchpoint.llm.scratch import written

LOCAL_KEYS = 1_000_000
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def word_shingles(text: bytes, k: int) -> set[tuple[bytes, ...]]:
    """Distinct shingles of a lower-cased text, as words."""
    words = _WORD.findall(text)
    if not words:
        return set()
    return {tuple(words[i:i + k]) for i in range(max(len(words) - k, 0) + 1)}


def _hashed(texts: pa.RecordBatch, k: int) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Row, lower-cased bytes and sorted distinct shingle hashes of every text of a batch."""
    for row, stop, data, offsets in rolling.text_slices(texts, "text"):
        sets = rolling.sliced_shingle_sets(data, offsets, k, rolling.LETTERS_DIGITS)
        for i, hashes in zip(range(row, stop), sets, strict=True):
            yield i, data[offsets[i - row]:offsets[i - row + 1]], hashes


def _lower(batch: pa.RecordBatch, column: int) -> pa.RecordBatch:
    text = batch.column(column).cast(pa.large_string()).fill_null("")
    return pa.RecordBatch.from_arrays([pc.utf8_lower(text)], ["text"])


@dataclass
class Items:
    """A block of items: sorted signature hashes, the item of each, and the items' shingles."""

    k: int
    percent: int
    ids: list[int] = field(default_factory=list)
    sets: list[set] = field(default_factory=list)
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    owner: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    needed: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @classmethod
    def build(cls, rows: list[tuple[int, str]], k: int, percent: int) -> Items:
        out = cls(k, percent)
        keys, owner, needed = [], [], []
        batch = pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.string())], ["text"])
        for row, data, hashes in _hashed(_lower(batch, 0), k):
            shingles = word_shingles(data.tobytes(), k)
            if not shingles:
                continue
            enough = -(-percent * len(shingles) // 100)
            signature = hashes[: max(len(hashes) - enough + 1, 1)]
            keys.append(signature)
            owner.append(np.full(len(signature), len(out.ids)))
            needed.append(enough)
            out.ids.append(rows[row][0])
            out.sets.append(shingles)
        if keys:
            key, own = np.concatenate(keys), np.concatenate(owner)
            order = np.argsort(key, kind="stable")
            out.keys, out.owner, out.needed = key[order], own[order], np.array(needed)
        return out

    def search(self, batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int]]:
        """``(row, item_id, shared shingles, item's shingles)`` of every containment in a batch of lower-cased texts."""
        if not len(self.keys):
            return
        gate = np.zeros(1 << 20, bool)
        gate[self.keys >> U64(44)] = True
        for row, data, hashes in _hashed(batch, self.k):
            open_ = hashes[gate[hashes >> U64(44)]]
            low = np.searchsorted(self.keys, open_, "left")
            high = np.searchsorted(self.keys, open_, "right")
            hit = np.flatnonzero(high > low)
            if not hit.size:
                continue
            found = np.unique(np.concatenate([self.owner[low[i]:high[i]] for i in hit]))
            found = found[self.needed[found] <= len(hashes)]
            shingles = word_shingles(data.tobytes(), self.k) if found.size else set()
            for item in found.tolist():
                shared = len(self.sets[item] & shingles)
                if shared >= self.needed[item]:
                    yield row, self.ids[item], shared, len(self.sets[item])


def _partitions(rows: list[tuple[int, str]], k: int, percent: int, least_words: int) -> list[Items]:
    """Items by the length of their shingles: their number of words for those of ``least_words`` to k - 1 words, else k."""
    by_length: dict[int, list[tuple[int, str]]] = {}
    for item_id, text in rows:
        n = len(_WORD.findall(text.encode().lower()))
        by_length.setdefault(n if least_words <= n < k else k, []).append((item_id, text))
    return [Items.build(own, length, percent) for length, own in sorted(by_length.items()) if length]


def _blocks(items: DataFrame, k: int, percent: int, least_words: int) -> Iterator[list[Items]]:
    """Items in blocks of about ``LOCAL_KEYS`` signature hashes; at least one block."""
    held, size, made = [], 0, 0
    for item_id, text in items.select("item_id", "text").where("item_id is not null and text is not null").toLocalIterator():
        held.append((item_id, text))
        size += len(text) // 4 + 1
        if size >= LOCAL_KEYS:
            yield _partitions(held, k, percent, least_words)
            held, size, made = [], 0, made + 1
    if held or not made:
        yield _partitions(held, k, percent, least_words)


def _with_last(blocks: Iterator[list[Items]]) -> Iterator[tuple[list[Items], bool]]:
    """Every block and whether it is the last one."""
    block = next(blocks)
    for after in blocks:
        yield block, False
        block = after
    yield block, True


def contained_items(docs: DataFrame, items: DataFrame, k: int = 5, percent: int = 80, least_words: int = 1) -> DataFrame:
    """``(doc_id, item_id, shared, n_item, containment)`` for every item found in a document."""
    texts, found = docs.select("doc_id", "text"), None
    for block, last in _with_last(_blocks(items, k, percent, least_words)):

        def run(batches: Iterator[pa.RecordBatch], block: list[Items] = block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lowered = _lower(batch, 1)
                rows = [row for part in block for row in part.search(lowered)]
                at, item, shared, size = (np.array(c, np.int64) for c in (zip(*rows, strict=True) if rows else ([], [], [], [])))
                ids = batch.column(0).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([ids, pa.array(item), pa.array(shared), pa.array(size)], ["doc_id", "item_id", "shared", "n_item"])

        part = texts.mapInArrow(run, "doc_id bigint, item_id bigint, shared bigint, n_item bigint")
        if not last or found is not None:
            part = written(part, "contained")
        found = part if found is None else found.unionByName(part)
    return found.withColumn("containment", F.col("shared") / F.col("n_item"))


def clean_documents(docs: DataFrame, items: DataFrame, k: int = 5, percent: int = 80, least_words: int | None = None) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns, without a shuffle of texts.

    An item of fewer than ``least_words`` words, k unless told otherwise, removes only documents that have just its words: a
    phrase like "of the" inside a document is no leak.
    """
    place = docs.columns.index("text")
    for block, last in _with_last(_blocks(items, k, percent, k if least_words is None else least_words)):

        def run(batches: Iterator[pa.RecordBatch], block: list[Items] = block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lowered = _lower(batch, place)
                keep = np.ones(batch.num_rows, bool)
                for part in block:
                    keep[[row for row, *_ in part.search(lowered)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
        if not last:
            docs = written(docs, "clean")
    return docs
