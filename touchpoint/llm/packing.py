"""Hierarchical multi-length packing of tokenized documents.

Context sizes are powers of two: ``longest`` and the tiers below it down to 1/32 of it.

* **Route.** Full windows of the longest size are cut off a document and stand alone. The tail goes to the
  smallest tier that holds it.
* **Pack a tier**, from the longest: each tail opens a window of its tier.
* **Fill the gaps** of a window from the shorter tiers: the longest tail that fits goes in whole; when none fits,
  the shortest of the longest shorter tier is cut so that the window is full, and its rest is routed again.
* **Left over** at the end are less than two windows' worth of tokens of a block; they are cut into windows of
  power-of-two sizes, so they need no padding either.
* **Step groups.** Sequences get a step number such that a step has sequences of one size and the same number of
  tokens as every other full step.

A block is what a task has tokenized when it holds ``BLOCK_TOKENS``, so memory is bounded, nothing is shuffled,
and a block is packed alike at any size of the input. Tokens are cached by space-separated chunk: neither the
normalizer nor the splitter of the tokenizer looks across a space.

Null texts count as empty and consist of the end token alone. Repeated rows are packed as often as they come; a
null doc_id is kept. An empty table gives no rows.
"""

from __future__ import annotations

import gc
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK_TOKENS = 4_000_000
#: Chunks, and parts of chunks, whose ids a task remembers.
CACHE_CHUNKS = 250_000
CACHE_PARTS = 500_000
TIERS_BELOW = 5
STEP_TOKENS = 1 << 17

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "context_size bigint, step_id bigint"
)


#: Letters before this one have a lower case of one character and no other normal form.
_PLAIN_END = "\u0130"


class ChunkIds(dict):
    """Token ids of chunks, as little-endian unsigned 32-bit integers.

    A chunk of letters between ASCII marks is put together from its parts: the splitter separates letters from marks
    (but for apostrophes and special tokens, whose chunks stay whole). Parts of plain letters, which normalize to their
    lower case, skip the normalizer and splitter and are encoded many at a time; their ids are told apart by the
    end-of-word mark that every part's last token carries.
    """

    _PARTS = re.compile(r"([!-&(-/:-@\[-`{-~]*)([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.parts: dict[str, bytes] = {"": b""}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, parts: list[str]) -> list[bytes]:
        """Ids of parts of one word each, encoded as one text; one by one if a part is more than one word after all."""
        ids = np.array(self.plain.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(parts):
            return self._each(parts)
        raw = ids.tobytes()
        return [raw[4 * x:4 * y] for x, y in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)]

    def learn(self, chunks: set[str]) -> None:
        new = [c for c in chunks if c not in self]
        if len(self) + len(new) > CACHE_CHUNKS:
            self.clear()
            new = list(chunks)
        if len(self.parts) > CACHE_PARTS:
            self.parts = {"": b""}
        cut, whole, match, known = [], [], self._PARTS.fullmatch, self.parts
        for chunk in new:
            found = match(chunk)
            if found and "<|" not in chunk and (letters := found[2]).isalpha() and max(letters) < _PLAIN_END:
                cut.append((chunk, found[1], letters.lower(), found[3]))
            else:
                whole.append(chunk)
        unknown = list({part for row in cut for part in row[1:] if part not in known})
        for at in range(0, len(unknown), 1_000):
            part = unknown[at:at + 1_000]
            known.update(zip(part, self._together(part), strict=True))
        for chunk, before, letters, after in cut:
            self[chunk] = known[before] + known[letters] + known[after]
        self.update(zip(whole, self._each(whole), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts: chunks between spaces and line feeds are independent."""
        chunks = [text.replace("\n", " ").split(" ") for text in texts]
        self.learn(set().union(*chunks))
        return [b"".join(map(self.__getitem__, c)) for c in chunks]


_known: dict[str, ChunkIds] = {}


def chunk_ids(path: str) -> ChunkIds:
    """The ids this Python worker remembers; they serve all its tasks, and their number is bounded."""
    if path not in _known:
        _known[path] = ChunkIds(path)
    return _known[path]


def _groups(texts: list[str], size: int = 1 << 20) -> Iterator[list[str]]:
    """Texts in groups of about a million characters."""
    group, held = [], 0
    for text in texts:
        group.append(text)
        held += len(text)
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


def pack(lengths: list[int], longest: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces ``(document, start, length)`` for documents of the given token counts.

    Every token lies in one piece; a sequence's length is a power of two of at most ``longest``.
    """
    out: list[list[tuple[int, int, int]]] = []
    smallest = longest >> TIERS_BELOW
    tiers: dict[int, list[tuple[int, int, int]]] = {longest >> i: [] for i in range(TIERS_BELOW + 1)}

    def route(piece: tuple[int, int, int]) -> None:
        size = max(smallest, 1 << (piece[0] - 1).bit_length())
        insort(tiers[size], piece)

    for document, n in enumerate(lengths):
        for start in range(0, n - longest + 1, longest):
            out.append([(document, start, longest)])
        if rest := n % longest:
            route((rest, document, n - rest))
    for size in sorted(tiers, reverse=True):
        pool = tiers[size]
        lower = [s for s in sorted(tiers, reverse=True) if s < size] or [size]
        while pool and _enough(tiers, size):
            length, document, start = pool.pop()
            window, gap = [(document, start, length)], size - length
            while gap:
                piece = _fitting(tiers, lower, gap) or _to_cut(tiers, lower, pool)
                length, document, start = piece
                if length > gap:
                    route((length - gap, document, start + gap))
                    length = gap
                window.append((document, start, length))
                gap -= length
            out.append(window)
    rest = [p for size in sorted(tiers, reverse=True) for p in reversed(tiers[size])]
    total, window, gap = sum(p[0] for p in rest), [], 0
    for length, document, start in rest:
        while length:
            if not gap:
                gap = min(longest, 1 << (total.bit_length() - 1))
                total -= gap
                window = []
                out.append(window)
            take = min(gap, length)
            window.append((document, start, take))
            start, length, gap = start + take, length - take, gap - take
    return out


def _enough(tiers: dict[int, list], size: int) -> bool:
    """Whether tails of this tier and the shorter ones fill a window; stops counting when they do."""
    total = 0
    for tier in tiers:
        if tier <= size:
            for piece in reversed(tiers[tier]):
                total += piece[0]
                if total >= size:
                    return True
    return False


def _fitting(tiers: dict[int, list], lower: list[int], gap: int) -> tuple[int, int, int] | None:
    """The longest tail of a shorter tier that fits the gap."""
    for tier in lower:
        at = bisect_left(tiers[tier], (gap + 1,))
        if at:
            return tiers[tier].pop(at - 1)
    return None


def _to_cut(tiers: dict[int, list], lower: list[int], pool: list) -> tuple[int, int, int]:
    """The shortest tail of the longest shorter tier that has one, else of the window's own tier."""
    for tier in lower:
        if tiers[tier]:
            return tiers[tier].pop(0)
    return pool.pop(0)


def _numbers(task: int, block: int) -> int:
    """First sequence number of a block of a task: 2**24 sequences in a block, 2**14 blocks in a task."""
    return (task << 38) + (block << 24)


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, longest: int = 2048) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, context_size, step_id."""

    def emit(ids: list, tokens: list[bytes], task: int, block: int) -> Iterator[pa.RecordBatch]:
        lengths = [len(t) // 4 for t in tokens]
        sequences = sorted(pack(lengths, longest), key=lambda s: -sum(p[2] for p in s))
        rows, base, step, filled, current = [], _numbers(task, block), -1, 0, 0
        for number, sequence in enumerate(sequences):
            size, offset = sum(p[2] for p in sequence), 0
            if size != current or filled + size > STEP_TOKENS or step < 0:
                step, filled, current = step + 1, 0, size
            filled += size
            for document, start, length in sequence:
                crc = zlib.crc32(memoryview(tokens[document])[4 * start:4 * (start + length)])
                rows.append((ids[document], start, length, crc, lengths[document], base + number, offset, size, base + step))
                offset += length
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for at in range(0, len(rows), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[at:at + 20_000], strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # millions of strings and no cycles; the collector would walk them again and again
        try:
            yield from packed(batches)
        finally:
            gc.enable()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, cache, end = TaskContext.get().partitionId(), chunk_ids(tokenizer_path), np.array([end_id], "<u4").tobytes()
        ids, tokens, held, block = [], [], 0, 0
        for batch in batches:
            own = iter(batch.column(0).to_pylist())
            for group in _groups([t or "" for t in batch.column(1).to_pylist()]):
                for encoded in cache.encode(group):
                    ids.append(next(own))
                    tokens.append(encoded + end)
                    held += len(tokens[-1]) // 4
                    if held >= BLOCK_TOKENS:
                        yield from emit(ids, tokens, task, block)
                        ids, tokens, held, block = [], [], 0, block + 1
        if ids:
            yield from emit(ids, tokens, task, block)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
