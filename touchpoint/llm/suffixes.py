"""Exact removal of long repeated substrings by hash-compared suffix sorting.

A byte goes if some string of ``length`` bytes that covers it starts at two or more places of the input,
overlaps and the same text included. Every such place is a window; windows never cross texts.

1. **Anchors.** The anchor of a window is its smallest k-gram hash, leftmost on ties, so equal windows have
   equal anchors at equal offsets. Neighbouring windows share anchors: a *run* is a maximal series of windows
   with one anchor, about one run per 75 bytes. Only a hash of the anchor and one of the run's bytes move.
2. **Runs.** An anchor that occurs once has no repeated window. Runs with equal anchors and equal bytes (two
   unrelated 64-bit hashes, and the same offset) are repeated as a whole. What is left are runs whose anchor
   recurs with other surroundings: the ends of repeated passages.
3. **Suffix sort.** The bytes of those runs, and of one run for each distinct surrounding, are sent to their
   anchor. There the suffixes that start at the windows are merge-sorted; two suffixes are compared by a
   binary search over prefix polynomial hashes for their common extension, so a comparison takes a
   logarithmic number of steps. Neighbours in the sorted order that agree on ``length`` bytes are compared
   byte by byte, so a hash collision removes nothing.
4. **Hot anchors** (more than ``GROUP_LIMIT`` distinct surroundings) are not sorted in one task: their windows
   are counted by 128-bit digest with partial aggregation, which is exact as well.

Nothing is gathered per anchor but distinct surroundings below that limit; copies are counted by partial
aggregates, and joins with tables of repeated anchors are plain, so adaptive execution can split them. Texts
are shuffled only for the documents that have a repeated anchor.

Null texts count as empty, and come back as empty; rows are identified by content, so doc_id may be null or
repeated. Texts shorter than ``length`` bytes lose nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpoint.llm import rolling
from touchpoint.llm.rolling import U64, mix
from touchpoint.llm.scratch import broadcast_if_few, few_rows, shuffle_partitions, written

GRAM = 48
#: Distinct surroundings of one anchor that are sorted in one task.
GROUP_LIMIT = 2_000
#: Bytes of surroundings that are sorted at once, unless one anchor has more.
SORT_BYTES = 1 << 20
#: Bits for a place in a chunk; hashes are compared by the bits above.
PLACE_BITS = 21
CHUNK = (1 << PLACE_BITS - 1) - 4096


# --- runs of windows with one anchor -------------------------------------------------------------


def window_anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Place of the anchor of every window of a chunk, and the hash of every k-gram."""
    width = length - gram + 1
    prefix = rolling.prefix_hashes(data)
    begin = np.arange(len(data) - gram + 1)
    grams = mix(rolling.span_hashes(prefix, begin, begin + gram))
    ranked = ((grams >> U64(PLACE_BITS)) << U64(PLACE_BITS)) | begin.astype(U64)
    padded = np.full(-(-len(ranked) // width) * width, ~U64(0), U64)
    padded[: len(ranked)] = ranked
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(data) - length + 1
    least = np.minimum(behind[:n], ahead[width - 1: width - 1 + n])
    return (least & U64((1 << PLACE_BITS) - 1)).astype(np.int64), grams


def text_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of a slice of texts: ``(text, place added, first window, last window, anchor)`` arrays, chunk by chunk.

    The first two are arrays and numbers for the chunk; windows and anchors count from the text's start.
    """
    total = int(offsets[-1])
    for at in range(0, max(total - length + 1, 0), CHUNK):
        chunk = data[at: at + CHUNK + length - 1]
        if len(chunk) < length:
            break
        anchor, grams = window_anchors(chunk, length, gram)
        window = np.arange(len(anchor)) + at
        text = np.searchsorted(offsets, window, "right") - 1
        valid = window + length <= offsets[text + 1]
        change = np.ones(len(anchor), bool)
        change[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(change & valid)
        if not len(first):
            continue
        stop = np.flatnonzero(np.concatenate((change, [True])) | np.concatenate((~valid, [True])))
        last = stop[np.searchsorted(stop, first, "right")] - 1
        yield text[first], first + at, last + at, anchor[first] + at, grams[anchor[first]]


def _occurrences(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """One row per run: row key, first window, number of windows, offset of the anchor, hashes of anchor and bytes."""
    names = ["row_key", "first", "n_windows", "lead", "anchor", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for row, _, data, offsets in rolling.text_slices(batch, "text"):
                raw = memoryview(data)
                with np.errstate(over="ignore"):
                    for text, first, last, anchor, grams in text_runs(data, offsets, length, gram):
                        lead = anchor - first
                        digest = [
                            xxhash.xxh3_64_intdigest(raw[a:b], int(o))
                            for a, b, o in zip(first.tolist(), (last + length).tolist(), lead.tolist(), strict=True)
                        ]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(keys[row + text]), pa.array(first - offsets[text]), pa.array((last - first + 1).astype(np.int32)),
                                pa.array(lead.astype(np.int32)), pa.array(grams.view(np.int64)), pa.array(np.array(digest, U64).view(np.int64)),
                            ],
                            names,
                        )

    return docs.select("row_key", "text").mapInArrow(run, "row_key bigint, first bigint, n_windows int, lead int, anchor bigint, bytes bigint")


# --- suffix sort ---------------------------------------------------------------------------------


class Suffixes:
    """Suffixes of one buffer, compared on their first ``length`` bytes through prefix hashes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length = data, length
        self.prefix = rolling.prefix_hashes(data)
        self.steps = [1 << b for b in range(length.bit_length() - 1, -1, -1)]

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of each pair of places, at most ``length``: binary search over hashes."""
        got = np.zeros(len(x), np.int64)
        for step in self.steps:
            fits = np.minimum(got + step, self.length)
            same = rolling.span_hashes(self.prefix, x + got, x + fits) == rolling.span_hashes(self.prefix, y + got, y + fits)
            got = np.where(same & (got + step <= self.length), fits, got)
        return got

    def less(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether suffix x sorts before y, and whether they are equal."""
        got = self.common(x, y)
        equal = got == self.length
        at = np.minimum(got, self.length - 1)
        return ~equal & (self.data[x + at] < self.data[y + at]), equal

    def merge_sort(self, place: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes by group and, inside a group, by bytes. ``group`` must be sorted.

        All groups are merged together: in each round every suffix finds its rank in the neighbouring run of
        its own group by binary search. Groups no longer than a run are finished.
        """
        order = np.arange(len(place))
        begin = np.searchsorted(group, group, "left")
        size = np.searchsorted(group, group, "right") - begin
        width = 1
        while (active := np.flatnonzero(size > width)).size:
            inside = active - begin[active]
            run = inside // width
            other = begin[active] + (run ^ 1) * width
            low = np.minimum(other, begin[active] + size[active])
            high = np.minimum(other + width, begin[active] + size[active])
            other, later = low.copy(), (run & 1) == 1
            mine = place[order[active]]
            while (open_ := np.flatnonzero(low < high)).size:
                middle = (low[open_] + high[open_]) // 2
                before, equal = self.less(place[order[middle]], mine[open_])
                before |= equal & later[open_]
                low[open_] = np.where(before, middle + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle)
            target = begin[active] + (run & ~1) * width + inside % width + (low - other)
            moved = order.copy()
            moved[target] = order[active]
            order = moved
            width *= 2
        return order


def repeated_windows(data: np.ndarray, place: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """For each window start: whether another window of its group has the same bytes. ``group`` must be sorted."""
    with np.errstate(over="ignore"):
        suffixes = Suffixes(data, length)
        order = suffixes.merge_sort(place, group)
        x, y = order[:-1], order[1:]
        near = np.flatnonzero(group[x] == group[y])
        near = near[suffixes.common(place[x[near]], place[y[near]]) == length]
    found = np.zeros(len(place), bool)
    reach = np.arange(length)
    for at in range(0, len(near), 20_000):
        i, j = x[near[at:at + 20_000]], y[near[at:at + 20_000]]
        same = (data[place[i][:, None] + reach] == data[place[j][:, None] + reach]).all(axis=1)
        if not same.all():
            return _counted_windows(data, place, group, length)
        found[i] = found[j] = True
    return found


def _counted_windows(data: np.ndarray, place: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """The same by counting the bytes themselves, for buffers in which two different spans have one hash."""
    raw = data.tobytes()
    keys = [(g, raw[p:p + length]) for g, p in zip(group.tolist(), place.tolist(), strict=True)]
    count: dict[tuple[int, bytes], int] = {}
    for key in keys:
        count[key] = count.get(key, 0) + 1
    return np.array([count[key] > 1 for key in keys], bool)


def _ranges(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Repeated ranges of the open runs; rows come sorted by anchor, and whole groups are sorted together."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(r[5] for r in rows), np.uint8)
        start = np.cumsum([0] + [len(r[5]) for r in rows[:-1]])
        n = np.array([r[3] for r in rows])
        run = np.repeat(np.arange(len(rows)), n)
        inside = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
        anchors = np.unique(np.array([r[0] for r in rows]), return_inverse=True)[1]
        offset = np.array([r[4] for r in rows])[run] - inside
        group = anchors[run] * (length + 1) + offset
        order = np.argsort(group, kind="stable")
        found = np.zeros(len(run), bool)
        found[order] = repeated_windows(data, (start[run] + inside)[order], group[order], length)
        found &= np.array([r[6] for r in rows])[run]
        edge = found & np.concatenate(([True], ~found[:-1] | (run[1:] != run[:-1])))
        close = found & np.concatenate((~found[1:] | (run[1:] != run[:-1]), [True]))
        a, b = np.flatnonzero(edge), np.flatnonzero(close)
        key = np.array([r[1] for r in rows], np.int64)[run[a]]
        first = np.array([r[2] for r in rows], np.int64)[run[a]]
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(first + inside[a]), pa.array(first + inside[b] + length)], ["row_key", "start", "stop"])

    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and size >= SORT_BYTES and row[0] != held[-1][0]:
                yield solve(held)
                held, size = [], 0
            held.append(row)
            size += len(row[5])
    if held:
        yield solve(held)


# --- the operator --------------------------------------------------------------------------------


def with_row_key(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("row_key", F.xxhash64("doc_id", "text"))


def repeated_spans(docs: DataFrame, length: int = 200, gram: int = GRAM) -> DataFrame:
    """``(row_key, spans)`` of the rows of ``with_row_key(docs)`` that lose something; spans are sorted window unions."""
    runs = written(_occurrences(docs.where(F.octet_length("text") >= length), length, gram), "runs")
    anchors = runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("bytes").alias("one"), F.max("bytes").alias("two"))
    anchors = written(anchors.where("n > 1").select("anchor", (F.col("one") != F.col("two")).alias("mixed")), "anchors")
    shared = written(runs.join(anchors, "anchor"), "shared")
    window_range = [F.col("first").alias("start"), (F.col("first") + F.col("n_windows") - 1 + length).alias("stop")]

    kinds = shared.where("mixed").groupBy("anchor", "bytes", "lead", "n_windows").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("row_key", "first")).alias("at")
    )
    kinds = written(kinds, "kinds")
    whole = shared.where("not mixed").select("row_key", *window_range)
    several = written(kinds.where("n > 1").select("anchor", "bytes", "lead"), "several")
    whole = whole.unionByName(shared.where("mixed").join(several, ["anchor", "bytes", "lead"], "left_semi").select("row_key", *window_range))

    crowded = written(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > GROUP_LIMIT).select("anchor", F.lit(True).alias("hot")), "crowded")
    places = kinds.join(crowded, "anchor", "left").select(
        "at.row_key", F.struct("anchor", "at.first", "n_windows", "lead", (F.col("n") == 1).alias("open"), F.coalesce("hot", F.lit(False)).alias("hot")).alias("place")
    )
    places = written(places.groupBy("row_key").agg(F.collect_list("place").alias("places")), "places")
    surroundings = written(_surroundings(docs, places, length), "surroundings")

    normal = surroundings.where("not hot").select("anchor", "row_key", "first", "n_windows", "lead", "bytes", "open")
    normal = normal.repartition(shuffle_partitions(docs.sparkSession), "anchor").sortWithinPartitions("anchor", "row_key", "first")
    sorted_out = normal.mapInArrow(lambda b: _ranges(b, length), "row_key bigint, start bigint, stop bigint")
    spans = whole.unionByName(sorted_out).unionByName(_hot_ranges(surroundings.where("hot"), length))
    return spans.groupBy("row_key").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def _surroundings(docs: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """The bytes of the runs at the given places."""
    wanted = docs.select("row_key", "text").join(broadcast_if_few(places.select("row_key")), "row_key", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode()
                cut = [data[p["first"]:p["first"] + p["n_windows"] - 1 + length] for p in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key] * len(found), pa.int64()), pa.array([p["anchor"] for p in found], pa.int64()), pa.array([p["first"] for p in found], pa.int64()),
                        pa.array([p["n_windows"] for p in found], pa.int32()), pa.array([p["lead"] for p in found], pa.int32()), pa.array(cut, pa.binary()),
                        pa.array([p["open"] for p in found]), pa.array([p["hot"] for p in found]),
                    ],
                    ["row_key", "anchor", "first", "n_windows", "lead", "bytes", "open", "hot"],
                )

    schema = "row_key bigint, anchor bigint, first bigint, n_windows int, lead int, bytes binary, open boolean, hot boolean"
    return wanted.join(places, "row_key").select("row_key", "text", "places").mapInArrow(run, schema)


def _hot_ranges(rows: DataFrame, length: int) -> DataFrame:
    """Repeated windows of crowded anchors, by counting 128-bit digests of the windows."""
    places = F.sequence(F.lit(1), F.col("n_windows"))
    windows = rows.select("row_key", "first", "open", "bytes", F.explode(places).alias("i"))
    piece = F.expr(f"substring(bytes, i, {length})")
    windows = windows.select("row_key", "open", (F.col("first") + F.col("i") - 1).alias("start"), F.substring(F.sha2(piece, 256), 1, 32).alias("digest"))
    twice = written(windows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"), "twice")
    found = windows.where("open").join(twice, "digest", "left_semi")
    return found.select("row_key", "start", (F.col("start") + length).alias("stop"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Union of sorted spans; spans that touch become one."""
    out: list[list[int]] = []
    for span in spans:
        if out and span["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], span["stop"])
        else:
            out.append([span["start"], span["stop"]])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """Every input row with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``kept`` (the bytes left) and ``kept_text``.

    ``kept_text`` leaves out characters of which only some bytes are kept.

    The columns of ``docs`` are kept, but those of these names, ``row_key`` and ``spans`` are replaced.
    """
    added = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "kept_text"]
    docs = with_row_key(docs.drop(*added, "row_key", "spans"))
    spans = written(repeated_spans(docs, length), "spans")
    names = [c for c in docs.columns if c != "row_key"]
    if few_rows(spans):
        keys = F.broadcast(spans.select("row_key"))
        clean, cut = docs.join(keys, "row_key", "left_anti"), docs.join(keys, "row_key", "left_semi").join(spans, "row_key")
    else:
        both = docs.join(spans, "row_key", "left")
        clean, cut = both.where("spans is null").drop("spans"), both.where("spans is not null")
    clean = clean.select(
        *names, F.octet_length("text").cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"), F.encode("text", "UTF-8").alias("kept"), F.col("text").alias("kept_text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            spans_of = batch.column(batch.schema.get_field_index("spans"))
            rows = []
            for text, found in zip(texts, spans_of, strict=True):
                data = text.as_py().encode()
                gone = merged(found.as_py())
                edges = [0, *(e for span in gone for e in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept, kept.decode(errors="ignore")))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()]
            columns += [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(columns, [*names, *added])

    return clean.unionByName(cut.select(*names, "spans").mapInArrow(run, clean.schema))
