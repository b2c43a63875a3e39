"""Hard negatives of anchors: other labels' rows that score close to, but below, the anchor's positives.

Components are quantised to ``floor(scale * x)`` and a row's score is its integer inner product with the anchor; higher
scores come first, ties by smaller id. An anchor's positives are its first ``n_positives`` other rows of its label.
For a positive with score p, the negatives are the first ``n_negatives`` rows of other labels with
``low * p <= 100 * score <= high * p``.

* **Slots.** The windows of an anchor overlap, so they are not searched one by one. The positives' upper limits cut the
  scores into disjoint slots; slot j reaches from the limit of positive j down to that of positive j + 1. A combiner in
  each block keeps the first ``n_negatives`` rows per slot, above the lower limit of the slot's own window, which is the
  lowest of all windows that reach into it.
* **Suffix merges.** The rows up to a positive's upper limit are its own slot and all slots below. Slots are merged in
  descending order, and the first rows at or above the lower limit answer the window; at most ``n_positives`` times
  ``n_negatives`` rows meet per anchor.
* **Blocks.** Anchors (a stated query set) meet all rows in blocks of at most ``BLOCK_ROWS`` rows and ``BLOCK_ANCHORS``
  anchors, dealt by hashes of ids: a frequent label or a vector with many copies does not load one task. A block
  sends on only what its combiners keep.

Rows with a null id, label or vector, or with a null or non-finite component, take no part. Vectors of different
lengths never meet; empty vectors score 0. A row that repeats an id counts once, with the smallest label, then the smallest
vector. Scores are exact; those beyond the range of a bigint are set to its ends. Anchors without positives, and windows without rows, give
nothing. Labels are whole numbers. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchpoint.llm.scratch import shuffle_partitions, written

BLOCK_ROWS = 20_000
BLOCK_ANCHORS = 2_000
#: Anchors whose scores against a block are in memory at once.
SCORED_ANCHORS = 128
_LARGEST = (1 << 63) - 1
_KEYS = ["row_block", "anchor_block", "size"]


def entries(vectors: DataFrame, id_: str, label: str, vector: str) -> DataFrame:
    """``(id, label, vector, size)`` of the rows that take part, one per id."""
    rows = vectors.select(F.col(id_).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    again = written(rows.groupBy("id").count().where("count > 1").select("id"), "again")
    if not again.isEmpty():
        one = rows.join(again, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.label", "row.vector")
        rows = rows.join(again, "id", "left_anti").select("id", "label", "vector").unionByName(one)
    return rows.withColumn("size", F.size("vector"))


def _quantised(column: pa.ChunkedArray, size: int, scale: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.floor(scale * flat.reshape(len(column), size))


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered vectors, as int64."""
    if a.size == 0 or b.size == 0:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0**53:
        return (a @ b.T).astype(np.int64)
    whole = [[sum(int(x) * int(y) for x, y in zip(u, v, strict=True)) for v in b.tolist()] for u in a.tolist()]
    return np.array([[max(-_LARGEST, min(_LARGEST, x)) for x in row] for row in whole], np.int64).reshape(len(a), len(b))


def first_rows(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` rows by score, ties by smaller id."""
    if len(scores) > n:
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        near = np.flatnonzero(scores >= least)
        return near[np.lexsort((ids[near], -scores[near]))[:n]]
    return np.lexsort((ids, -scores))


def limits(positive_score: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest whole score of a positive's window."""
    return -(-low * positive_score // 100), high * positive_score // 100


class Blocks:
    """The rows and how anchors meet them."""

    def __init__(self, rows: DataFrame, n_rows: int, n_anchors: int, scale: int):
        self.rows, self.scale = rows, scale
        self.parts = shuffle_partitions(rows.sparkSession)
        self.row_blocks = max(-(-n_rows // BLOCK_ROWS), min(self.parts, -(-n_rows // 1_000)), 1)
        self.anchor_blocks = max(-(-n_anchors // BLOCK_ANCHORS), 1)

    def meet(self, anchors: DataFrame, pick, schema: str) -> DataFrame:
        """``pick(anchor row, scores, ids, labels)`` for every anchor and block; it gives the columns after the anchor's id."""
        row_block, anchor_block = (F.pmod(F.xxhash64("id"), F.lit(n)).cast("int") for n in (self.row_blocks, self.anchor_blocks))
        every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (self.row_blocks, self.anchor_blocks)]
        rows = self.rows.select(row_block.alias("row_block"), every[1].alias("anchor_block"), "size", "id", "label", "vector")
        asking = anchors.select(every[0].alias("row_block"), anchor_block.alias("anchor_block"), "size", *[c for c in anchors.columns if c != "size"])
        scale, names = self.scale, [f.split()[0] for f in schema.split(", ")]

        def run(key: tuple, block: pa.Table, asked: pa.Table) -> pa.Table:
            out: list[list] = [[] for _ in names]
            if block.num_rows and asked.num_rows:
                size = key[2].as_py()
                ids, labels = block["id"].to_numpy(), block["label"].to_numpy()
                matrix = _quantised(block["vector"], size, scale)
                own = _quantised(asked["vector"], size, scale)
                about = asked.drop_columns(["vector", *_KEYS]).to_pylist()
                for at in range(0, len(own), SCORED_ANCHORS):
                    scores = inner_products(own[at:at + SCORED_ANCHORS], matrix)
                    for anchor, line in zip(about[at:at + SCORED_ANCHORS], scores, strict=True):
                        for columns in pick(anchor, line, ids, labels):
                            out[0].append(np.full(len(columns[0]), anchor["id"]))
                            for held, column in zip(out[1:], columns, strict=True):
                                held.append(column)
            arrays = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out]
            return pa.Table.from_arrays(arrays, names)

        dealt = [df.repartition(self.parts, *_KEYS).groupBy(*_KEYS) for df in (rows, asking)]
        return dealt[0].cogroup(dealt[1]).applyInArrow(run, schema)


def mine(
    vectors: DataFrame, is_anchor: Column, id_: str = "vec_id", label: str = "label", vector: str = "embedding",
    n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``; ``is_anchor`` is a condition on the column ``id``."""
    rows = written(entries(vectors, id_, label, vector), "entries")
    anchors = written(rows.where(is_anchor), "anchors")
    blocks = Blocks(rows, rows.count(), anchors.count(), scale)

    def positives(anchor: dict, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        same = np.flatnonzero((labels == anchor["label"]) & (ids != anchor["id"]))
        best = same[first_rows(scores[same], ids[same], n_positives)]
        yield ids[best], scores[best]

    def slots(anchor: dict, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        windows = [limits(p["score"], low, high) for p in anchor["positives"]]
        other = labels != anchor["label"]
        for j, (least, most) in enumerate(windows):
            inside = other & (scores >= least) & (scores <= most)
            if j + 1 < len(windows):
                inside &= scores > windows[j + 1][1]
            found = np.flatnonzero(inside)
            kept = found[first_rows(scores[found], ids[found], n_negatives)]
            yield np.full(len(kept), j), ids[kept], scores[kept]

    def first(df: DataFrame, keys: list[str], n: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
        return df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)

    near = blocks.meet(anchors, positives, "anchor bigint, id bigint, score bigint")
    listed = F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("positives")
    near = first(near, ["anchor"], n_positives).groupBy("anchor").agg(listed)
    asking = written(anchors.join(near.withColumnRenamed("anchor", "id"), "id"), "asking")

    kept = first(blocks.meet(asking, slots, "anchor bigint, slot bigint, id bigint, score bigint"), ["anchor", "slot"], n_negatives)
    merged = kept.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "id", "slot"))).alias("found"))
    windows = asking.select(F.col("id").alias("anchor"), F.posexplode("positives").alias("slot", "positive")).join(merged, "anchor")
    exact = "decimal(20,0)"
    reached = (F.col("positive.score").cast(exact) * low).alias("reached")
    windows = windows.select("anchor", "slot", "positive", reached, "found")
    # From the own slot downwards, at or above the lower limit.
    window = F.filter("found", lambda x: (x["slot"] >= F.col("slot")) & (-x["down"].cast(exact) * 100 >= F.col("reached")))
    negatives = windows.select("anchor", "positive", F.posexplode(F.slice(window, 1, n_negatives)).alias("rank", "negative"))
    return negatives.select(
        F.col("anchor").alias("anchor_id"), F.col("positive.id").alias("positive_id"), (F.col("rank") + 1).alias("rank"),
        F.col("negative.id").alias("negative_id"), F.col("positive.score").alias("positive_score"), (-F.col("negative.down")).alias("negative_score"),
    )
