"""Language-model scores of documents, from n-gram counts in a log-frequency Bloom filter.

Tokens are the words of a text (A-Z lower-cased, parted by space and U+0009 to U+000D) and one end per text. The model
learns from the rows that a condition names and scores all rows.

* **Filter.** A count c is quantised to its level, the number of thresholds ``ceil(base ** j)`` up to c. An n-gram is stored
  by inserting the pairs (n-gram, 1) to (n-gram, level) in a Bloom filter; its level is read back by probing (n-gram, 1),
  (n-gram, 2) ... until one is missing. There are no false negatives, so a level is never too low; it is too high by one
  with the error rate of the filter (``2 ** -probes``), by two with its square. Most n-grams occur once and cost one entry.
* **Smoothing.** ``p(w | v) = (c(vw) + mu p(w)) / (c(v) + mu)``, from order to order, ending in
  ``p(w) = (c(w) + 1) / (N + V + 1)``; the counts are the levels' middles. An n-gram whose context or last token is
  not stored cannot occur and is not believed, and no n-gram counts more than its context.
* **Building.** Tasks send distinct hashes with counts (summed before the shuffle) to buckets of hashes; a bucket's bits are
  set by the task that holds it, sized by the entries it has. The number of buckets follows the number of tokens.
* **Broadcast.** The filter goes to the tasks in shards of at most ``shard_bytes``, so its size bound is a parameter. While
  there is one shard, one pass scores all texts. Beyond that, each shard is a pass that adds the levels it knows, a byte
  per n-gram, to a written table; the last pass scores. The result is the same: an n-gram's levels are all in one shard.
* **Base scores** use exact counts. The most frequent tokens, at most ``HEAD_TOKENS`` (the least count is chosen
  from a histogram of counts), are broadcast and settled inside the pass. Only a document's rarer tokens are joined with the table of
  counts, where no key is hot, because hot ones are in the head.

N-grams are told apart by 64-bit hashes (another error far below the filter's), tokens of the base score by 128 bits.

Defined results: null and empty texts are one end. Rows without a doc_id are scored, but not learnt from where the
condition is null for them. Repeated rows are learnt and scored as often as they occur. Where nothing is learnt from, N and V are 0,
the probabilities are 1 and the scores 0. Whole texts are read; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpoint.llm import rolling
from touchpoint.llm.rolling import U64
from touchpoint.llm.scratch import release, written

HEAD_TOKENS = 500_000
SHARD_BYTES = 128 << 20
#: Training tokens per bucket of the filter.
BUCKET_TOKENS = 50_000
#: N-grams a task holds before it sums and sends them.
FLUSH_NGRAMS = 2_000_000
START, END = U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F)
_SECOND_VALUES = rolling.salts(256, 23)
_NGRAM_WEIGHTS = rolling.salts(16, 31)


# --- token sequences -----------------------------------------------------------------------------


@dataclass
class Sequences:
    """Token hashes of the texts of a slice, each text between START and END."""

    hashes: np.ndarray
    second: np.ndarray
    local: np.ndarray
    owner: np.ndarray
    heads: np.ndarray

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Place of the last token and hash of every run of ``n`` tokens inside a text; single tokens keep their hash."""
        at = np.flatnonzero(self.local >= n - 1)
        if n == 1:
            return at, self.hashes
        total = np.full(len(at), U64(n))
        for j in range(n):
            total = total + self.hashes[at - (n - 1 - j)] * _NGRAM_WEIGHTS[j]
        return at, rolling.mix(total)


def sequences(data: np.ndarray, offsets: np.ndarray) -> Sequences:
    lowered = rolling.LOWER[data]
    starts, ends, text_of = rolling.word_bounds(lowered, offsets, rolling.NOT_SPACE)
    words = rolling.word_hashes(lowered, starts, ends)
    other = np.concatenate((np.zeros(1, U64), np.cumsum(_SECOND_VALUES[lowered] * rolling.Powers.up[:len(lowered)], dtype=U64)))
    texts = len(offsets) - 1
    sizes = np.bincount(text_of, minlength=texts) + 2
    heads = np.cumsum(sizes) - sizes
    hashes, second = np.full(sizes.sum(), END), np.zeros(sizes.sum(), U64)
    hashes[heads] = START
    place = np.arange(len(words)) + 2 * text_of + 1
    hashes[place] = words
    second[place] = rolling.mix(rolling.span_hashes(other, starts, ends))
    owner = np.repeat(np.arange(texts), sizes)
    return Sequences(hashes, second, np.arange(len(hashes)) - heads[owner], owner, heads)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int, Sequences]]:
    for batch in batches:
        for row, stop, data, offsets in rolling.text_slices(batch, "text"):
            with np.errstate(over="ignore"):
                yield batch, row, stop, sequences(data, offsets)


# --- levels and the filter -----------------------------------------------------------------------


def thresholds(base: float) -> np.ndarray:
    """Least count of every level."""
    steps = int(62 * math.log(2) / math.log(base))
    return np.unique(np.ceil(base ** np.arange(steps, dtype=np.float64)).astype(np.int64))


def middles(least: np.ndarray) -> np.ndarray:
    """Count that stands for a level; 0 for level 0."""
    return np.concatenate(([0.0], np.sqrt(least[:-1].astype(float) * (least[1:] - 1)), [float(least[-1])]))


def _bits_of(hashes: np.ndarray, level: int, sizes: np.ndarray | int, probes: int) -> Iterator[np.ndarray]:
    """Bit numbers of (n-gram, level) in bitmaps of the given sizes, one array per hash function."""
    with np.errstate(over="ignore"):
        first = rolling.mix(hashes + U64(level) * U64(0xD1342543DE82EF95))
        step = rolling.mix(first ^ U64(0xA0761D6478BD642F)) | U64(1)
        for i in range(probes):
            yield (first + U64(i) * step) % sizes


def bitmap(hashes: np.ndarray, counts: np.ndarray, least: np.ndarray, probes: int) -> np.ndarray:
    """Bits of all levels of distinct n-grams, sized for an error of ``2 ** -probes``."""
    levels = np.searchsorted(least, counts, "right")
    size = 8 * max(8, math.ceil(int(levels.sum()) * probes / math.log(2) / 8))
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for where in _bits_of(hashes[levels >= level], level, U64(size), probes):
            bits[where] = True
    return np.packbits(bits, bitorder="little")


@dataclass
class Shard:
    """Bitmaps of neighbouring buckets. A hash outside them has level 0 here."""

    bucket_bits: int
    first: int
    ends: np.ndarray
    data: np.ndarray
    probes: int

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.uint8)
        buckets = (hashes >> U64(64 - self.bucket_bits)).astype(np.int64) - self.first if self.bucket_bits else np.zeros(len(hashes), np.int64)
        here = np.flatnonzero((buckets >= 0) & (buckets < len(self.ends) - 1))
        here = here[self.ends[buckets[here]] < self.ends[buckets[here] + 1]]
        level = 0
        while len(here):
            level += 1
            low = self.ends[buckets[here]]
            sizes = ((self.ends[buckets[here] + 1] - low) * 8).astype(U64)
            held = np.ones(len(here), bool)
            for bit in _bits_of(hashes[here], level, sizes, self.probes):
                held &= (self.data[low + (bit >> U64(3)).astype(np.int64)] >> (bit & U64(7)).astype(np.uint8)) & 1 == 1
            here = here[held]
            out[here] = level
        return out


# --- learning ------------------------------------------------------------------------------------


def token_counts(texts: DataFrame) -> DataFrame:
    """``(h, g, c)``: both hashes and the count of every token; the end is a token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, seq in _slices(batches):
            at = seq.local > 0
            hashes, second = seq.hashes[at], seq.second[at]
            own, where, n = np.unique(hashes, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(second[where].view(np.int64)), pa.array(n)], ["h", "g", "c"])

    return texts.select("text").mapInArrow(run, "h bigint, g bigint, c bigint").groupBy("h", "g").agg(F.sum("c").alias("c"))


def ngram_counts(texts: DataFrame, order: int, bucket_bits: int) -> DataFrame:
    """``(bucket, h, c)`` of runs of 2 to ``order`` tokens; a hash comes once per flush of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def summed() -> pa.RecordBatch:
            hashes, n = np.unique(np.concatenate(held) if held else np.zeros(0, U64), return_counts=True)
            buckets = (hashes >> U64(64 - bucket_bits)).astype(np.int32) if bucket_bits else np.zeros(len(hashes), np.int32)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(hashes.view(np.int64)), pa.array(n)], ["bucket", "h", "c"])

        size = 0
        for _, _, _, seq in _slices(batches):
            for n in range(2, order + 1):
                held.append(seq.ngrams(n)[1])
                size += len(held[-1])
            if size >= FLUSH_NGRAMS:
                yield summed()
                size = 0
        yield summed()

    return texts.select("text").mapInArrow(run, "bucket int, h bigint, c bigint")


@dataclass
class Model:
    """What scoring needs beside the filter: sizes of the training text, the head of its tokens, the smoothing."""

    order: int
    mu: float
    train_tokens: int
    train_types: int
    train_texts: int
    least: np.ndarray
    head_h: np.ndarray = field(repr=False)
    head_g: np.ndarray = field(repr=False)
    head_c: np.ndarray = field(repr=False)

    @property
    def mass(self) -> float:
        return float(self.train_tokens + self.train_types + 1)

    def known(self, hashes: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Exact counts of the tokens in the head, 0 for others."""
        if not len(self.head_h):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.head_h, hashes), len(self.head_h) - 1)
        return np.where((self.head_h[at] == hashes) & (self.head_g[at] == second), self.head_c[at], 0)

    def log_probability(self, seq: Sequences, levels: list[np.ndarray]) -> np.ndarray:
        """log10 probability of every text of a slice; ``levels[n - 1]`` are those of its runs of n tokens."""
        middle = middles(self.least)
        count = middle[levels[0]]
        p = (count + 1) / self.mass
        held = levels[0] > 0
        for n in range(2, self.order + 1):
            at = np.flatnonzero(seq.local >= n - 1)
            level = np.zeros(len(p), np.uint8)
            level[at] = levels[n - 1]
            # A run that the filter claims although one of its parts is missing is an error of the filter.
            now = np.zeros(len(p), bool)
            now[at] = (level[at] > 0) & held[at] & held[at - 1]
            context = np.zeros(len(p))
            context[at] = count[at - 1]
            count_now = np.where(now, np.minimum(middle[level], context), 0.0)
            p[at] = (count_now[at] + self.mu * p[at]) / (context[at] + self.mu)
            count, held = count_now, now
        logs = np.where(seq.local > 0, np.log10(p), 0.0)
        return np.add.reduceat(logs, seq.heads) if len(seq.heads) else np.zeros(0)


def head_of(tokens: DataFrame, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent tokens, at most ``HEAD_TOKENS``, sorted by hash: all tokens from some level of counts on."""
    level = F.lit(0)
    for c in least.tolist():
        level = level + (F.col("c") >= c).cast("int")
    by_level = {r["level"]: r["n"] for r in tokens.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}
    total, floor = 0, None
    for lv in sorted(by_level, reverse=True):
        total += by_level[lv]
        if total > HEAD_TOKENS:
            break
        floor = int(least[lv - 1])
    if floor is None:
        return np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int64)
    found = tokens.where(F.col("c") >= floor).select("h", "g", "c").toArrow()
    h, g, c = (found[n].to_numpy() for n in ("h", "g", "c"))
    order = np.argsort(h.view(U64), kind="stable")
    return h.view(U64)[order], g.view(U64)[order], c[order]


@dataclass
class Learnt:
    """A model, the exact counts of its tokens, and the written bitmaps of its filter."""

    model: Model
    tokens: DataFrame
    bitmaps: DataFrame
    bucket_bits: int
    probes: int

    def shards(self, shard_bytes: int) -> Iterator[Shard]:
        """The filter in pieces of about ``shard_bytes`` at most; only one is in the driver at a time."""
        total = self.bitmaps.agg(F.sum(F.octet_length("bits"))).first()[0] or 0
        number = min(max(1, -(-total // shard_bytes)), 1 << self.bucket_bits)
        # Buckets are dealt by hash, so equal ranges of them are equal in size but for a few per cent.
        cuts = [(i << self.bucket_bits) // number for i in range(number + 1)]
        for first, stop in zip(cuts[:-1], cuts[1:], strict=True):
            rows = self.bitmaps.where((F.col("bucket") >= first) & (F.col("bucket") < stop)).select("bucket", "bits").toArrow()
            order = np.argsort(rows["bucket"].to_numpy())
            sizes = np.zeros(stop - first, np.int64)
            bits = [np.frombuffer(b.as_buffer(), np.uint8) for b in (rows["bits"][int(i)] for i in order)]
            sizes[rows["bucket"].to_numpy()[order] - first] = [len(b) for b in bits]
            yield Shard(self.bucket_bits, first, np.concatenate(([0], np.cumsum(sizes))), np.concatenate(bits) if bits else np.zeros(0, np.uint8), self.probes)


def learn(texts: DataFrame, order: int = 2, base: float = 1.5, probes: int = 5, mu: float = 200.0) -> Learnt:
    """Counts of all tokens and n-grams of ``texts``."""
    least = thresholds(base)
    tokens = written(token_counts(texts), "tokens")
    total, types = tokens.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    end = int(END.view(np.int64))
    ends = tokens.where((F.col("h") == end) & (F.col("g") == 0)).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    bucket_bits = max(0, math.ceil(math.log2(max(total, 1) / BUCKET_TOKENS)))
    bucket = F.shiftrightunsigned("h", 64 - bucket_bits).cast("int") if bucket_bits else F.lit(0)
    begin = texts.sparkSession.createDataFrame([(int(START.view(np.int64)), ends)] if ends else [], "h bigint, c bigint")
    singles = tokens.select("h", "c").unionByName(begin).select(bucket.alias("bucket"), "h", "c")
    rows = ngram_counts(texts, order, bucket_bits).unionByName(singles)

    def build(group: pa.Table) -> pa.Table:
        hashes, counts = group["h"].to_numpy().view(U64), group["c"].to_numpy()
        own, back = np.unique(hashes, return_inverse=True)
        total = np.zeros(len(own), np.int64)
        np.add.at(total, back, counts)
        bits = bitmap(own, total, least, probes)
        return pa.table([pa.array([group["bucket"][0].as_py()], pa.int32()), pa.array([bits.tobytes()], pa.binary()), pa.array([len(own)], pa.int64())], ["bucket", "bits", "n_ngrams"])

    bitmaps = written(rows.groupBy("bucket").applyInArrow(build, "bucket int, bits binary, n_ngrams bigint"), "bitmaps")
    release(texts.sparkSession)
    return Learnt(Model(order, mu, total, types, ends, least, *head_of(tokens, least)), tokens, bitmaps, bucket_bits, probes)


# --- scoring -------------------------------------------------------------------------------------


def _distinct_levels(shard: Shard, hashes: np.ndarray) -> np.ndarray:
    own, back = np.unique(hashes, return_inverse=True)
    return shard.levels(own)[back]


def _add_levels(rows: DataFrame, shard, order: int) -> DataFrame:
    """The rows with the levels that a shard knows added to the column ``levels``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, stop, seq in _slices(batches):
            found = [_distinct_levels(shard.value, seq.ngrams(n)[1]) for n in range(1, order + 1)]
            owners = [seq.owner[seq.ngrams(n)[0]] for n in range(1, order + 1)]
            owner, level = np.concatenate(owners), np.concatenate(found)
            by_text = np.argsort(owner, kind="stable")
            ends = np.searchsorted(owner[by_text], np.arange(stop - row + 1))
            level = level[by_text]
            old = batch.column(3).slice(row, stop - row)
            lists = [(level[a:b] + np.frombuffer(o.as_buffer(), np.uint8) if o.is_valid else level[a:b]).tobytes() for a, b, o in zip(ends[:-1], ends[1:], old, strict=True)]
            part = batch.slice(row, stop - row)
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(lists, pa.binary())], ["row", "doc_id", "text", "levels"])

    return rows.mapInArrow(run, "row bigint, doc_id bigint, text string, levels binary")


def _old_levels(column: pa.Array, seq: Sequences, order: int) -> list[np.ndarray]:
    """Levels from earlier passes, as one array per order."""
    runs = [np.bincount(seq.owner[seq.local >= n - 1], minlength=len(seq.heads)) for n in range(1, order + 1)]
    out: list[list[np.ndarray]] = [[] for _ in runs]
    for i, held in enumerate(column):
        at, values = 0, np.frombuffer(held.as_buffer(), np.uint8)
        for n, sizes in enumerate(runs):
            out[n].append(values[at:at + sizes[i]])
            at += sizes[i]
    return [np.concatenate(x) if x else np.zeros(0, np.uint8) for x in out]


def _rare(seq: Sequences, at: np.ndarray, texts: int) -> pa.Array:
    """Per text the distinct tokens at the given places, with their number of occurrences."""
    own, back = np.unique(seq.hashes[at], return_inverse=True)
    second = np.zeros(len(own), U64)
    second[back] = seq.second[at]
    pairs, n = np.unique(seq.owner[at] * max(len(own), 1) + back, return_counts=True)
    token = pairs % max(len(own), 1)
    ends = np.searchsorted(pairs // max(len(own), 1), np.arange(texts + 1)).astype(np.int32)
    fields = [pa.array(x.view(np.int64)) for x in (own[token], second[token])] + [pa.array(n.astype(np.int64))]
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, ["h", "g", "n"]))


def _score_pass(rows: DataFrame, shard, shared_model) -> DataFrame:
    """Sizes, base scores of the head and model scores of all rows, and the tokens outside the head."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared_model.value
        for batch, row, stop, seq in _slices(batches):
            part, texts = batch.slice(row, stop - row), stop - row
            levels = [_distinct_levels(shard.value, seq.ngrams(n)[1]) for n in range(1, model.order + 1)]
            if part.num_columns == 4:
                levels = [a + b for a, b in zip(levels, _old_levels(part.column(3), seq, model.order), strict=True)]
            score = model.log_probability(seq, levels)
            counts = model.known(seq.hashes, seq.second)
            ends = seq.hashes == END
            counts[ends] = model.train_texts
            settled = (seq.local > 0) & ((counts > 0) | ends)
            base = np.bincount(seq.owner[settled], np.log10((counts[settled] + 1) / model.mass), texts)
            n_known = np.bincount(seq.owner[settled & (counts > 0)], minlength=texts)
            n_tokens = np.bincount(seq.owner, minlength=texts) - 1
            rare = _rare(seq, np.flatnonzero((seq.local > 0) & ~settled), texts)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(n_tokens), pa.array(n_known), pa.array(base), pa.array(score), rare],
                ["row", "doc_id", "n_tokens", "n_known", "base_score", "score", "rare"],
            )

    return rows.mapInArrow(run, "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double, rare array<struct<h bigint, g bigint, n bigint>>")


def score(docs: DataFrame, learnt: Learnt, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` of every row."""
    context, model = docs.sparkSession.sparkContext, learnt.model
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    shared_model, held = context.broadcast(model), None
    for shard in learnt.shards(shard_bytes):
        if held is not None:
            # Another shard follows: what the last one knows is written beside the texts.
            if "levels" not in rows.columns:
                rows = rows.withColumn("levels", F.lit(None).cast("binary"))
            rows = written(_add_levels(rows, held, model.order), "levels")
            held.destroy()
        held = context.broadcast(shard)
        del shard
    scored = written(_score_pass(rows, held, shared_model), "scored")
    held.destroy()
    shared_model.destroy()
    per_token = F.col("n") * F.log10((F.coalesce(F.col("c"), F.lit(0)) + 1) / F.lit(model.mass))
    rare = scored.select("row", F.inline("rare")).join(learnt.tokens, ["h", "g"], "left").groupBy("row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"), F.sum(per_token).alias("rare_score")
    )
    return scored.join(rare, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(model.train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("rare_score", F.lit(0.0))).alias("base_score"), "score",
    )


def score_documents(docs: DataFrame, learn_from: Column, order: int = 2, **how) -> DataFrame:
    """Learn from the rows that meet the condition, score all rows."""
    return score(docs, learn(docs.where(learn_from), order, **how))
