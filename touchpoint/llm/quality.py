"""Document quality: histogram gradient-boosted trees over document statistics.

Statistics are computed over the whole text, many texts at a time, from byte classes, words and lines.
The trees are trained on at most ``max_rows`` labelled rows (the smallest by a digest of their doc_id; the
bound is a parameter): features are cut into at most 64 bins by quantiles, a tree is grown level by level
from histograms of gradients and hessians, and the finished trees are flattened into arrays (feature,
threshold, left, right, value) that score a whole batch with a few numpy steps per level. Training data is
bounded by the parameter, so it is done in the driver; statistics and scores cover every row in the tasks.

Labels, language, source and doc_id are no features. Null texts count as empty and are scored like
empty ones. If there is no labelled row, or only one class, every score is the share of good labels (0.5 without
any). Repeated rows get equal scores; columns beside doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpoint.llm import rolling
from touchpoint.llm.rolling import U64

#: Bound on the training rows.
MAX_ROWS = 60_000

#: Byte classes whose share of the text is a statistic.
CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t\r\x0b\x0c",
    "line": b"\n",
    "stop": b".!?",
    "comma": b",;:",
    "bracket": b"()[]{}<>",
    "symbol": b"#$%&*+=@^_`|~\\/",
    "quote": b"\"'-",
    "control": bytes([*range(0, 9), *range(14, 32), 127]),
    "high": bytes(range(128, 256)),
}
STATISTICS = [
    "log_bytes", "log_words", "log_lines", "bytes_per_word", "words_per_line", "longest_word", "word_length_spread",
    "distinct_words", "top_word", "distinct_pairs", "distinct_lines", "repeated_line_bytes", "words_per_stop", "short_words", "long_words",
    *[f"share_{c}" for c in CLASSES],
]
_CLASS_OF = np.full(256, 255, np.uint8)
for _i, _members in enumerate(CLASSES.values()):
    _CLASS_OF[np.frombuffer(_members, np.uint8)] = _i
_NOT_LINE = rolling.byte_class((0x0A, 0x0A))


def _per_text(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, values, n)


def _distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct hashes of each text and the count of its most frequent one."""
    if not len(hashes):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (o[1:] != o[:-1]))))
    count = np.diff(np.concatenate((first, [len(h)])))
    most = np.zeros(n)
    np.maximum.at(most, o[first], count)
    return np.bincount(o[first], minlength=n).astype(float), most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` for each text of a slice."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    text_of_byte = np.repeat(np.arange(n), np.diff(offsets))
    n_classes = len(CLASSES) + 1
    kind = np.minimum(_CLASS_OF[data], len(CLASSES))
    classes = np.bincount(text_of_byte * n_classes + kind, minlength=n * n_classes).reshape(n, n_classes)[:, :-1]
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        lowered = rolling.LOWER[data]
        starts, ends, owner = rolling.word_bounds(lowered, offsets, rolling.NOT_SPACE)
        prefix = rolling.prefix_hashes(lowered)
        length = (ends - starts).astype(float)
        words = rolling.mix(rolling.span_hashes(prefix, starts, ends) + length.astype(U64))
        n_words = np.bincount(owner, minlength=n).astype(float)
        distinct, most = _distinct(words, owner, n)
        pair = owner[1:] == owner[:-1]
        pairs = rolling.mix(words[:-1] + rolling.mix(words[1:]))[pair] if len(words) else words
        distinct_pairs, _ = _distinct(pairs, owner[:-1][pair] if len(words) else owner, n)
        l_start, l_end, l_owner = rolling.word_bounds(data, offsets, _NOT_LINE)
        l_size = (l_end - l_start).astype(float)
        lines = rolling.mix(rolling.span_hashes(prefix, l_start, l_end) + l_size.astype(U64))
        n_lines = np.bincount(l_owner, minlength=n).astype(float)
        distinct_lines, _ = _distinct(lines, l_owner, n)
        order = np.lexsort((lines, l_owner))
        again = np.zeros(len(lines), bool)
        again[order[1:]] = (lines[order[1:]] == lines[order[:-1]]) & (l_owner[order[1:]] == l_owner[order[:-1]])
        longest = np.zeros(n)
        np.maximum.at(longest, owner, length)
        mean = _per_text(length, owner, n) / n_words
        spread = np.sqrt(np.maximum(_per_text(length**2, owner, n) / n_words - mean**2, 0))
        columns = [
            np.log1p(size), np.log1p(n_words), np.log1p(n_lines), mean, n_words / n_lines, np.log1p(longest), spread,
            distinct / n_words, most / n_words, distinct_pairs / np.maximum(n_words - 1, 1), distinct_lines / n_lines,
            _per_text(l_size[again], l_owner[again], n) / size, n_words / (classes[:, 5] + 1),
            _per_text(length <= 3, owner, n) / n_words, _per_text(length >= 12, owner, n) / n_words,
            *(classes / size[:, None]).T,
        ]
    return np.nan_to_num(np.stack(columns, axis=1), nan=0.0, posinf=0.0, neginf=0.0)


@dataclass
class Trees:
    """Flattened trees: node k of tree t splits ``feature <= threshold`` to ``left``, else to ``right``; a leaf leads to itself."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), np.int32)
            for _ in range(self.depth):
                down = x[rows, self.feature[t][node]] <= self.threshold[t][node]
                node = np.where(down, self.left[t][node], self.right[t][node])
            total += self.value[t][node]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, n_trees: int = 80, depth: int = 4, rate: float = 0.1, bins: int = 64, least: int = 20, smoothing: float = 1.0) -> Trees:
    """Train on the logistic loss. Without rows or with one class only, the trees are empty."""
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) and 0 < y.sum() < len(y) else (float(y.mean()) if len(y) else 0.5)
    base = float(np.log(np.clip(share, 1e-6, 1 - 1e-6) / np.clip(1 - share, 1e-6, 1)))
    n_nodes = 2 ** (depth + 1) - 1
    if not len(y) or y.min() == y.max():
        return Trees(base, np.zeros((0, n_nodes), int), np.zeros((0, n_nodes)), np.zeros((0, n_nodes), int), np.zeros((0, n_nodes), int), np.zeros((0, n_nodes)), depth)
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T, strict=True)], axis=1)
    n, m = x.shape
    cell = binned + np.arange(m) * bins
    total = np.full(n, base)
    out: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-total))
        gradient, hessian = y - p, np.maximum(p * (1 - p), 1e-9)
        feature, threshold = np.zeros(n_nodes, int), np.zeros(n_nodes)
        left, right, value = np.arange(n_nodes), np.arange(n_nodes), np.zeros(n_nodes)
        node = np.zeros(n, int)
        for level in range(depth + 1):
            begin, width = 2**level - 1, 2**level
            here = node >= begin
            at = node[here] - begin
            g_all, h_all = np.bincount(at, gradient[here], width), np.bincount(at, hessian[here], width)
            value[begin:begin + width] = rate * g_all / (h_all + smoothing)
            if level == depth:
                break
            where = (at[:, None] * (m * bins) + cell[here]).ravel()
            shape = (width, m, bins)
            g = np.bincount(where, np.repeat(gradient[here], m), width * m * bins).reshape(shape).cumsum(2)
            h = np.bincount(where, np.repeat(hessian[here], m), width * m * bins).reshape(shape).cumsum(2)
            c = np.bincount(where, minlength=width * m * bins).reshape(shape).cumsum(2)
            g_end, h_end, c_end = g[:, :, -1:], h[:, :, -1:], c[:, :, -1:]
            gain = g**2 / (h + smoothing) + (g_end - g) ** 2 / (h_end - h + smoothing) - g_end**2 / (h_end + smoothing)
            gain[(c < least) | (c_end - c < least)] = 0
            best = gain.reshape(width, -1).argmax(1)
            for k in np.flatnonzero(gain.reshape(width, -1)[np.arange(width), best] > 1e-9):
                f, b = divmod(int(best[k]), bins)
                feature[begin + k], threshold[begin + k] = f, edges[f][b]
                left[begin + k], right[begin + k] = 2 * (begin + k) + 1, 2 * (begin + k) + 2
            split = left[node] != node
            goes_left = x[np.arange(n), feature[node]] <= threshold[node]
            node = np.where(split, np.where(goes_left, left[node], right[node]), node)
        total += value[node]
        for k, v in (("feature", feature), ("threshold", threshold), ("left", left), ("right", right), ("value", value)):
            out[k].append(v)
    return Trees(base, *(np.array(out[k]) for k in ("feature", "threshold", "left", "right", "value")), depth)


def _statistics_of(docs: DataFrame) -> DataFrame:
    """``docs`` must have ``doc_id``, ``label`` and ``text``; returns id, label and statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, data, offsets in rolling.text_slices(batch, "text", rolling.SMALL_SLICE_BYTES):
                values = statistics(data, offsets)
                lists = pa.ListArray.from_arrays(np.arange(len(values) + 1) * values.shape[1], pa.array(values.ravel()))
                part = batch.slice(row, stop - row)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], ["doc_id", "label", "statistics"])

    return docs.select("doc_id", "label", "text").mapInArrow(run, "doc_id bigint, label int, statistics array<double>")


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> DataFrame:
    """``(label, statistics)`` of at most ``max_rows`` labelled ids, one row an id: those with the smallest digests of the id.

    Of labels that disagree about an id the smallest counts. Of rows that repeat an id, that with the smallest
    statistics stays; they are reduced in the tasks, before anything is shuffled or sent to the driver.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    marked = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    found = _statistics_of(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    return found.groupBy("doc_id").agg(F.min(F.struct("label", "statistics")).alias("row")).select("row.label", "row.statistics")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> Trees:
    """Fit on the training rows, of which there are at most ``max_rows``."""
    rows = training_rows(docs, labels, label, max_rows).toArrow()
    x = np.array(rows.column("statistics").combine_chunks().flatten()).reshape(-1, len(STATISTICS))
    order = np.lexsort(x.T) if len(x) else np.zeros(0, int)
    y = np.array(rows.column("label"), float)
    return fit(x[order], y[order])


def score(docs: DataFrame, trees: Trees, name: str = "score") -> DataFrame:
    """Add the score, in tasks; every column of ``docs`` is passed through, but one called ``name`` is replaced."""
    docs = docs.drop(name)
    names = [*docs.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, data, offsets in rolling.text_slices(batch, "text", rolling.SMALL_SLICE_BYTES):
                part = batch.slice(row, stop - row)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(trees.score(statistics(data, offsets)))], names)

    return docs.mapInArrow(run, docs.select("*", F.lit(0.5).alias(name)).schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
