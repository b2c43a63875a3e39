"""Importance resampling of documents towards a target distribution, with hashed n-gram features.

A text's features are its runs of 1 to ``longest`` words, joined by one space, repeats counted. A feature's bucket is the
unsigned CRC-32 of its UTF-8 bytes modulo ``buckets``. With s of the S features of all documents and t of the T features
of all target texts in a bucket, its gain is ``floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets))))``. A
document's weight is the sum of its features' gains, and its score the weight plus Gumbel noise derived from its id: the
highest scores are a draw without replacement in proportion to the importance weights.

* **Length-bucketed CRC matrices.** A task finds the distinct features of about a megabyte of whole texts, gathers those
  of equal length into one two-dimensional byte array, advances all their CRCs column by column, and scatters the buckets
  back to the places of the features. The few features longer than ``LONG_FEATURE`` bytes, whose matrices would be one row
  and very many columns, go through the C function for the same CRC one by one.
* **Counts.** Each task sends one row per bucket; their sum has at most ``buckets`` rows, a parameter, whatever the input.
* **Ranks.** Scored documents (five numbers each) are sorted by range; a rank is the place in its range plus the rows of
  the ranges before it, so no task sees them all.

Words are runs of letters, digits and bytes outside ASCII, with A-Z lower-cased. Defined results: null and empty texts
have no features, weight 0 and are never drawn (they lack ``min_words``). Rows without a doc_id have weight, but neither
score nor rank. Repeated rows are rows of their own; ties go to the smaller doc_id. An empty target or an empty table
gives gains from the counts that are there. Whole texts are read; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpoint.llm import rolling
from touchpoint.llm.rolling import U64
from touchpoint.llm.scratch import shuffle_partitions, written

LONG_FEATURE = 256


def _crc_table() -> np.ndarray:
    """CRC-32 (reflected polynomial 0xEDB88320) of every byte."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0xEDB88320), crc >> 1)
    return crc


CRC_TABLE = _crc_table()


def crc32_by_length(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of every byte span, computed for all spans of one length at once."""
    out = np.zeros(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[order])) + 1
    for rows in np.split(order, edges):
        if not len(rows):
            continue
        length = int(lengths[rows[0]])
        if length > LONG_FEATURE:
            out[rows] = [zlib.crc32(data[s:s + length]) for s in starts[rows].tolist()]
            continue
        columns = data[starts[rows][None, :] + np.arange(length)[:, None]]
        crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for column in columns:
            crc = CRC_TABLE[(crc ^ column) & 0xFF] ^ (crc >> 8)
        out[rows] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def spaced_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words of the texts of a slice with one space after each: bytes, starts, ends and text of every word."""
    lowered = rolling.LOWER[data]
    starts, ends, text_of = rolling.word_bounds(lowered, offsets, rolling.LETTERS_DIGITS)
    lengths = ends - starts
    stops = np.cumsum(lengths + 1)
    begins = stops - lengths - 1
    source = np.repeat(starts - begins, lengths + 1) + np.arange(stops[-1] if len(stops) else 0)
    spaced = lowered[np.minimum(source, max(len(lowered) - 1, 0))] if len(lowered) else lowered
    if len(stops):
        spaced[stops - 1] = 32
    return spaced, begins, stops - 1, text_of


def feature_buckets(data: np.ndarray, offsets: np.ndarray, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2 ... ``longest`` words: the bucket and the text of every feature of a slice, in text order."""
    with np.errstate(over="ignore"):
        spaced, begins, ends, text_of = spaced_words(data, offsets)
        prefix = rolling.prefix_hashes(spaced)
        for n in range(1, longest + 1):
            whole = np.flatnonzero(text_of[:len(text_of) - n + 1] == text_of[n - 1:]) if len(text_of) >= n else np.zeros(0, np.int64)
            first, last = begins[whole], ends[whole + n - 1]
            lengths = last - first
            hashes = rolling.mix(rolling.span_hashes(prefix, first, last) + lengths.astype(U64))
            _, where, back = np.unique(hashes, return_index=True, return_inverse=True)
            crc = crc32_by_length(spaced, first[where], lengths[where])
            yield (crc % np.uint32(buckets)).astype(np.int64)[back], text_of[whole]


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Features of all texts of a table in every bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in rolling.text_slices(batch, "text"):
                for found, _ in feature_buckets(data, offsets, longest, buckets):
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    sums = texts.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in sums.collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log importance ratio of every bucket, rounded down, with one feature added to each bucket."""
    buckets, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    ratios = ((t + 1) * (all_source + buckets) / ((s + 1) * (all_target + buckets)) for s, t in zip(map(float, source), map(float, target), strict=True))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, longest: int) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for row, stop, data, offsets in rolling.text_slices(batch, "text"):
                for n, (found, text_of) in enumerate(feature_buckets(data, offsets, longest, len(gain))):
                    bounds = np.searchsorted(text_of, np.arange(stop - row + 1))
                    sums = np.concatenate(([0], np.cumsum(gain[found])))
                    features[row:stop] += np.diff(bounds)
                    weight[row:stop] += sums[bounds[1:]] - sums[bounds[:-1]]
                    if n == 0:
                        words[row:stop] = np.diff(bounds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, features, weight))], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def gumbel(id_, seed: int):
    """Thousandths of the Gumbel noise of an id, rounded down: from the first 32 bits of the SHA-256 of ``seed:id``."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_.cast("string")), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(uniform)))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, longest: int = 1, buckets: int = 10_000, min_words: int = 20, seed: int = 2024) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)`` of every row; drawn rows have a rank.

    Of the N rows with at least ``min_words`` words, the ``floor(percent * N / 100)`` highest scores are drawn.
    """
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    scored = weigh(docs, gain, longest).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = written(scored, "scored")
    able = F.coalesce((F.col("n_words") >= min_words) & F.col("doc_id").isNotNull(), F.lit(False))
    order = [F.desc("score"), F.asc("doc_id")]
    ranges = scored.where(able).repartitionByRange(shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    # The place of a row: the number of its range above 2**33, its place in the range below.
    ranges = written(ranges.withColumn("place", F.monotonically_increasing_id()), "ranges")
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    before, offsets = 0, []
    for row in ranges.groupBy(part.alias("part")).count().orderBy("part").collect():
        offsets.append((row["part"], before))
        before += row["count"]
    drawn = percent * before // 100
    starts = docs.sparkSession.createDataFrame(offsets, "part bigint, before bigint")
    placed = ranges.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("rank", F.col("before") + within + 1)
    names = ["doc_id", "n_words", "n_features", "weight", "score"]
    ranked = placed.select(*names, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    return ranked.unionByName(scored.where(~able).select(*names, F.lit(None).cast("bigint").alias("rank")))
