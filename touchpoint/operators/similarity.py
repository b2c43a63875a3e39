"""Top-k rows by cosine similarity."""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpoint.operators.keys import latest_per_key
from touchpoint.sources.tables import spread

# Query vectors up to this many float values are shipped to every task; beyond it, blocks are joined.
QUERY_VALUES = 8_000_000
SCORE_DIGITS = 6
# Scores held at once: queries are cut so that a block of corpus rows times a block of queries stays below.
SCORE_VALUES = 4_000_000
# Rows of a piece of the corpus whose scores are screened together, of the first piece, and queries that meet a piece at once.
SCREENED_ROWS = 2048
FIRST_ROWS = 512
SCREENED_QUERIES = 512
# Values of a block: every row is copied once for each block of the other side, so blocks are large.
BLOCK_VALUES = 4_000_000
# Pairs of blocks for each slot of the session, at least, where there are enough rows.
PAIRS_A_SLOT = 4
LEAST_BLOCK = 256
_OUT = "query_id bigint, neighbor_id bigint, score double"


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


class _Nearest:
    """The k best corpus rows of every query, by rounded score, then by id, over any number of blocks; bounded in memory.

    A block's scores are screened in single precision, and only what may be among the k best is scored in double precision.
    """

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int, values: int | None = None):
        self.query_ids, self.queries, self.k = query_ids, queries, k
        self.single = queries.astype("float32")
        self.values = SCORE_VALUES if values is None else values
        self.ids = np.full((len(query_ids), k), np.iinfo(np.int64).max)
        self.scores = np.full((len(query_ids), k), -np.inf)
        # What rounding to six digits and single precision may add.
        self.slack = 2 * 10.0**-SCORE_DIGITS + (queries.shape[1] + 8) * 2.4e-7

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids, unit = ids[order], _unit(vectors[order])
        at = 0
        while at < len(ids) and len(self.query_ids):
            # The first rows give every query a limit, which the screen of the others needs.
            width = FIRST_ROWS if np.isneginf(self.scores[:, -1]).any() else SCREENED_ROWS
            cut = slice(at, at + width)
            self._add(ids[cut], unit[cut])
            at += width

    def _add(self, ids: np.ndarray, unit: np.ndarray) -> None:
        single = np.ascontiguousarray(unit.T, "float32")
        step = max(1, min(SCREENED_QUERIES, self.values // len(ids)))
        for i in range(0, len(self.query_ids), step):
            limit = self.scores[i:i + step, -1]
            scores = self.single[i:i + step] @ single
            least = (limit - self.slack).astype("float32")
            open_ = np.flatnonzero(scores.max(axis=1) >= least)
            if not open_.size:
                continue
            few = scores if open_.size == len(scores) else scores[open_]
            row, place = np.divmod(np.flatnonzero(few >= least[open_][:, None]), few.shape[1])
            if len(row) > few.size // 16:
                self._dense(i + open_, ids, unit)
            else:
                self._sparse(i + open_[row], place, ids, unit)

    def _dense(self, rows: np.ndarray, ids: np.ndarray, unit: np.ndarray) -> None:
        scores = np.round(self.queries[rows] @ unit.T, SCORE_DIGITS)
        own = np.searchsorted(ids, self.query_ids[rows]), np.searchsorted(ids, self.query_ids[rows], "right")
        for r in np.flatnonzero(own[0] < own[1]):
            scores[r, own[0][r]:own[1][r]] = -np.inf
        kept = min(self.k, len(ids))
        at = np.arange(len(rows))
        found, score = np.empty((len(rows), kept), np.int64), np.empty((len(rows), kept))
        for rank in range(kept):
            # The first of equal scores, which has the smallest id.
            best = scores.argmax(axis=1)
            found[:, rank], score[:, rank] = ids[best], scores[at, best]
            scores[at, best] = -np.inf
        self._merge(np.repeat(rows, kept), found.ravel(), score.ravel())

    def _sparse(self, rows: np.ndarray, places: np.ndarray, ids: np.ndarray, unit: np.ndarray) -> None:
        apart = self.query_ids[rows] != ids[places]
        rows, places = rows[apart], places[apart]
        step = max(1, self.values // (8 * unit.shape[1]))
        parts = [np.einsum("ij,ij->i", self.queries[rows[i:i + step]], unit[places[i:i + step]]) for i in range(0, len(rows), step)]
        if parts:
            self._merge(rows, ids[places], np.round(np.concatenate(parts), SCORE_DIGITS))

    def _merge(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        last, last_id = self.scores[rows, -1], self.ids[rows, -1]
        better = (scores > last) | ((scores == last) & (ids < last_id))
        rows, ids, scores = rows[better], ids[better], scores[better]
        changed = np.unique(rows)
        rows = np.concatenate((rows, np.repeat(changed, self.k)))
        ids = np.concatenate((ids, self.ids[changed].ravel()))
        scores = np.concatenate((scores, self.scores[changed].ravel()))
        order = np.lexsort((ids, -scores, rows))
        first = np.searchsorted(rows[order], changed)
        kept = order[first[:, None] + np.arange(self.k)]
        self.ids[changed], self.scores[changed] = ids[kept], scores[kept]

    def frame(self) -> pd.DataFrame:
        kept = np.isfinite(self.scores)
        rows, _ = np.nonzero(kept)
        return pd.DataFrame({"query_id": self.query_ids[rows], "neighbor_id": self.ids[kept], "score": self.scores[kept]})


def _best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, values: int | None = None) -> pd.DataFrame:
    """The k best rows of one block for every query."""
    nearest = _Nearest(query_ids, queries, k, values)
    nearest.add(ids, vectors)
    return nearest.frame()


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype("float64")


def cosine_topk(
    corpus: DataFrame, queries: DataFrame, k: int, dim: int, block_rows: int | None = None, max_values: int = QUERY_VALUES
) -> DataFrame:
    """The k nearest corpus rows of every query; both frames have (id bigint, vector array<float>).

    A row is not its own neighbour. Each task multiplies a block of corpus rows with a block of
    queries and keeps k rows per query, so only k rows per query and block reach the shuffle, which
    again keeps k per query and task. Queries are shipped to the tasks when they are few (checked);
    otherwise both sides are cut into blocks that meet in an equi join on the pair of block numbers. Every row is copied once for
    each block of the other side, so without ``block_rows`` blocks are as large as a task may hold, but not fewer than keep all slots busy.
    """
    few = queries.limit(max_values // dim + 1).count() <= max_values // dim
    local = _shipped(corpus, queries, k) if few else _blocked(corpus, queries, k, dim, block_rows)
    return latest_per_key(local, ["query_id"], [F.desc("score"), F.asc("neighbor_id")], k)


def _shipped(corpus: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    listed = queries.toPandas()
    if listed.empty:
        return corpus.sparkSession.createDataFrame([], _OUT)
    query_ids = listed["id"].to_numpy()
    shipped = corpus.sparkSession.sparkContext.broadcast((query_ids, _unit(_matrix(listed["vector"]))))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nearest = _Nearest(*shipped.value, k)
        for frame in frames:
            if len(frame):
                nearest.add(frame["id"].to_numpy(), _matrix(frame["vector"]))
        yield nearest.frame()

    return spread(corpus.select("id", "vector")).mapInPandas(run, _OUT)


def _blocked(corpus: DataFrame, queries: DataFrame, k: int, dim: int, block_rows: int | None) -> DataFrame:
    slots = corpus.sparkSession.sparkContext.defaultParallelism
    least = isqrt(PAIRS_A_SLOT * slots - 1) + 1

    def blocks(df: DataFrame) -> int:
        n = df.count()
        if block_rows:
            return max(1, -(-n // block_rows))
        return max(1, -(-n * dim // BLOCK_VALUES), min(least, n // LEAST_BLOCK))

    n_corpus, n_queries = blocks(corpus), blocks(queries)

    def cut(df: DataFrame, own: int, other: int, own_name: str, other_name: str) -> DataFrame:
        return df.select(
            "id",
            "vector",
            F.pmod(F.xxhash64("id"), F.lit(own)).alias(own_name),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(other - 1).cast("bigint"))).alias(other_name),
        )

    left = cut(corpus, n_corpus, n_queries, "corpus_block", "query_block")
    right = cut(queries, n_queries, n_corpus, "query_block", "corpus_block")

    def pair(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or asked.empty:
            return pd.DataFrame({"query_id": [], "neighbor_id": [], "score": []})
        unit = _unit(_matrix(asked["vector"]))
        return _best(asked["id"].to_numpy(), unit, rows["id"].to_numpy(), _matrix(rows["vector"]), k)

    keys = ["corpus_block", "query_block"]
    # One shuffle partition for about every pair: sizes in bytes say little about the work of one.
    parts = n_corpus * n_queries
    return left.repartition(parts, *keys).groupBy(*keys).cogroup(right.repartition(parts, *keys).groupBy(*keys)).applyInPandas(pair, _OUT)
