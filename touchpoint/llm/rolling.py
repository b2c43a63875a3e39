"""Vectorised hashing of UTF-8 text with numpy: prefix polynomial hashes, words, word shingles.

Texts of an Arrow batch lie end to end in one byte buffer. Everything here works on slices of that
buffer that hold whole texts, so that Python runs once per slice and not once per word. Hashes are
64-bit, modulo 2**64, with a random value per byte and a finalizer; operators that must be exact
verify what the hashes propose or use digests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 1 << 20
#: For steps that keep tables of their own beside the slice; the arrays over a slice take some forty times as much.
SMALL_SLICE_BYTES = 1 << 18
_RATIO = 0x9E3779B97F4A7C15
_RATIO_INVERSE = pow(_RATIO, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finalizer of 64-bit values (splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def salts(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd random values."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * U64(_RATIO) + U64(seed * 1_000_003)) | U64(1)


BYTE_VALUES = salts(256, 17)


class Powers:
    """Powers of the ratio and of its inverse, grown on demand and kept per process."""

    up = np.ones(1, U64)
    down = np.ones(1, U64)

    @classmethod
    def need(cls, n: int) -> None:
        if len(cls.up) < n:
            n = 1 << int(n - 1).bit_length()
            cls.up = _powers(_RATIO, n)
            cls.down = _powers(_RATIO_INVERSE, n)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix sums of ``value(byte) * ratio ** position``; one more entry than bytes."""
    n = len(data)
    Powers.need(n + 1)
    out = np.empty(n + 1, U64)
    out[0] = 0
    np.cumsum(BYTE_VALUES[data] * Powers.up[:n], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte span, the same wherever the bytes stand. Not finalized."""
    return (prefix[end] - prefix[start]) * Powers.down[start]


# --- Arrow batches -------------------------------------------------------------------------------


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields ``(first row, last row + 1, bytes, offsets)`` with about ``limit`` bytes of whole texts each.

    Null texts count as empty. A text longer than the limit gets a slice of its own.
    """
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        stop = min(max(stop, row + 1), len(texts))
        yield row, stop, data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        row = stop


# --- words ---------------------------------------------------------------------------------------

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of the bytes outside the given inclusive ranges."""
    table = np.ones(256, bool)
    for first, last in ranges:
        table[first:last + 1] = False
    return table


#: [^\x20\x09-\x0D]+
NOT_SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, for text whose A-Z are lower-cased
LETTERS_DIGITS = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def word_bounds(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word; words never cross texts."""
    inside = table[data]
    first = inside.copy()
    last = inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[heads] = inside[heads]
        tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(lowered: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    prefix = prefix_hashes(lowered)
    return mix(span_hashes(prefix, starts, ends) + (ends - starts).astype(U64))


def shingles(words: np.ndarray, text_of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of ``k`` words inside a text.

    A text with fewer words, but at least one, gives its whole sequence as one shingle.
    """
    weights = salts(k, 29)
    if len(words) >= k:
        whole = text_of[: len(words) - k + 1] == text_of[k - 1:]
        total = np.zeros(len(words) - k + 1, U64)
        for j in range(k):
            total += words[j: len(words) - k + 1 + j] * weights[j]
        long_hash, long_text = mix(total[whole]), text_of[: len(words) - k + 1][whole]
    else:
        long_hash, long_text = np.zeros(0, U64), np.zeros(0, np.int64)
    if not len(words):
        return long_hash, long_text
    edges = np.flatnonzero(np.diff(text_of)) + 1
    begins, stops = np.concatenate(([0], edges)), np.concatenate((edges, [len(words)]))
    short = stops - begins < k
    short_hash = [
        mix(np.array([(words[a:b] * weights[: b - a]).sum() + U64(b - a) * U64(_RATIO)], U64))[0]
        for a, b in zip(begins[short], stops[short], strict=True)
    ]
    hashes = np.concatenate((long_hash, np.array(short_hash, U64)))
    owners = np.concatenate((long_text, text_of[begins[short]]))
    return hashes, owners


def distinct_per_text(hashes: np.ndarray, owners: np.ndarray, n_texts: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text, in text order."""
    order = np.argsort(owners, kind="stable")
    hashes = hashes[order]
    bounds = np.searchsorted(owners[order], np.arange(n_texts + 1))
    for i in range(n_texts):
        yield np.unique(hashes[bounds[i]:bounds[i + 1]])


def sliced_shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int, table: np.ndarray, seed: int = 0) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a slice, on A-Z lower-cased bytes."""
    with np.errstate(over="ignore"):
        lowered = LOWER[data]
        starts, ends, text_of = word_bounds(lowered, offsets, table)
        hashes, owners = shingles(word_hashes(lowered, starts, ends), text_of, k)
        if seed:
            hashes = mix(hashes + U64(seed))
    return distinct_per_text(hashes, owners, len(offsets) - 1)
