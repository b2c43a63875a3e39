"""Approximate nearest neighbours by cosine, with a forest of hash-prefix trees.

Every vector gets, per tree, a string of ``BITS`` bits: the sides of random hyperplanes. A tree is the sorted array
of these strings. A query descends every tree to its longest matching prefixes; while the trees together offer
fewer than ``budget`` vectors, all trees ascend by one bit at the same time. What is below the reached prefixes is
scored exactly.

On Spark a sorted array is cut into cells, the vectors that share the first ``floor`` bits in a tree, and cells into
chunks of at most ``CHUNK_ROWS`` rows; rows are dealt by cell and chunk and sorted by string. Two passes run over them:
the first counts, for each query, tree and prefix length, what a cell offers (binary search in the sorted array), which
after a sum over trees gives the length each query ascends to; the second scores what lies below it and keeps the
best per cell.

The floor comes from the probes. A query that the trees offer less than the budget at the floor, or that ends with fewer
distinct vectors than asked for (an entry may be offered by all trees), is scored against all vectors of its length in
blocks: every query meets the budget or has seen every candidate.

``budget`` and ``floor`` are measured, not guessed: the true neighbours of at most ``PROBES`` queries are found by brute
force against all vectors (linear, the probes are a bounded broadcast), and the smallest budget on a doubling scale whose
recall on them reaches ``recall`` is taken. On vectors without structure this can be a large part of all vectors.

Equal vectors are one entry of the index with its smallest ids (as many as a result can hold), so copies neither
crowd a cell nor multiply candidates; all vectors are indexed. Null, empty and zero vectors, and those with null or
non-finite components, take no part, as queries or candidates; vectors of different lengths never meet. Rows with a
null id are left out, repeated rows of one id and vector count once. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchpoint.llm.rolling import U64
from touchpoint.llm.scratch import shuffle_partitions, written

TREES = 24
BITS = 48
PROBES = 192
CHUNK_ROWS = 50_000
#: Queries of a block that is scored against all vectors.
BLOCK_QUERIES = 4_000


@lru_cache(maxsize=8)
def planes(length: int) -> np.ndarray:
    """Random hyperplanes for vectors of a length: bit b of tree t is column t * BITS + b."""
    return np.random.default_rng(length).standard_normal((length, TREES * BITS))


def strings(vectors: np.ndarray) -> np.ndarray:
    """Hash strings of unit vectors, one column per tree, first bit highest."""
    weights = (U64(1) << np.arange(BITS - 1, -1, -1, dtype=U64))
    sides = (vectors @ planes(vectors.shape[1]) > 0).reshape(len(vectors), TREES, BITS)
    return (sides * weights).sum(axis=2, dtype=U64).view(np.int64)


def common_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of hash strings."""
    differ = (a ^ b).astype(np.float64)
    return np.where(differ == 0, BITS, BITS - 1 - np.floor(np.log2(np.maximum(differ, 1)))).astype(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosines in double precision."""
    return _unit(vectors) @ _unit(query[None])[0]


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0))


def build_index(vectors: DataFrame, id_: str, vector: str, top: int) -> DataFrame:
    """Distinct vectors: uid (smallest id), the ``top`` + 1 smallest ids, the vector, its length and hash strings."""
    rows = usable(vectors.select(F.col(id_).alias("id"), F.col(vector).cast("array<double>").alias("vector")).where(F.col(id_).isNotNull()), "vector")
    numbered = rows.withColumn("n", F.dense_rank().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("n") <= top + 1)
    entries = numbered.groupBy("vector").agg(F.min("id").alias("uid"), F.array_sort(F.collect_set("id")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column(2).value_lengths())
            for size in np.unique(sizes):
                for at in range(0, batch.num_rows, 4_000):
                    part = batch.slice(at, 4_000).filter(pa.array(sizes[at:at + 4_000] == size))
                    if part.num_rows:
                        keys = strings(_unit(_matrix(part.column(2))))
                        lists = pa.ListArray.from_arrays(np.arange(len(keys) + 1) * TREES, pa.array(keys.ravel()))
                        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(len(keys), size, np.int32)), lists], ["uid", "ids", "vector", "size", "keys"])

    return entries.select("uid", "ids", "vector").mapInArrow(run, "uid bigint, ids array<bigint>, vector array<double>, size int, keys array<bigint>")


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Whole groups of rows that come sorted by the named columns."""
    held: list[pa.RecordBatch] = []

    def whole() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names], axis=1)
        if held:
            last = held[-1].slice(held[-1].num_rows - 1)
            if any(last.column(last.schema.get_field_index(n))[0].as_py() != k for n, k in zip(names, keys[0], strict=True)):
                yield whole()
                held = []
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            held.append(batch.slice(a, b - a))
            if b < len(keys):
                yield whole()
                held = []
    if held:
        yield whole()


# --- measuring -----------------------------------------------------------------------------------


def measure(index: DataFrame, queries: DataFrame, top: int, recall: float) -> tuple[int, int, float]:
    """``(budget, floor, measured recall)`` from brute force on a bounded number of queries."""
    probes = queries.orderBy(F.xxhash64("uid"), "uid").limit(PROBES).select("uid", "size", "vector", "keys").collect()
    if not probes:
        return 1, 0, 1.0
    sizes = np.array([p["size"] for p in probes])
    p_keys = np.array([p["keys"] for p in probes], np.int64)
    p_vectors = {s: _unit(np.array([p["vector"] for p in probes if p["size"] == s])) for s in set(sizes.tolist())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0), np.zeros(0, np.int64), np.zeros((0, TREES), np.int64)) for _ in probes]
        offered = np.zeros((len(probes), BITS + 2), np.int64)
        for batch in batches:
            row_sizes = batch.column(1).to_numpy()
            for size, own in p_vectors.items():
                part = batch.filter(pa.array(row_sizes == size))
                for at in range(0, part.num_rows, 2_000):
                    piece = part.slice(at, 2_000)
                    uid, keys = piece.column(0).to_numpy(), np.asarray(piece.column(3).flatten()).reshape(-1, TREES)
                    scores = own @ _unit(_matrix(piece.column(2))).T
                    for i, q in enumerate(np.flatnonzero(sizes == size)):
                        offered[q] += np.bincount(common_bits(keys, p_keys[q]).ravel(), minlength=BITS + 2)
                        s, u, k = (np.concatenate(x) for x in zip(best[q], (scores[i], uid, keys), strict=True))
                        order = np.lexsort((u, -s))[: top + 1]
                        best[q] = s[order], u[order], k[order]
        rows = [(q, float(s), int(u), int(common_bits(k, p_keys[q]).max()), None) for q, found in enumerate(best) for s, u, k in zip(*found, strict=True)]
        rows += [(q, None, None, d, int(offered[q, d])) for q in range(len(probes)) for d in range(BITS + 1) if offered[q, d]]
        kinds = [pa.int32(), pa.float64(), pa.int64(), pa.int32(), pa.int64()]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["q", "score", "uid", "depth", "n"])

    seen = written(index.select("uid", "size", "vector", "keys").mapInArrow(run, "q int, score double, uid bigint, depth int, n bigint"), "probes")
    nearest = Window.partitionBy("q").orderBy(F.desc("score"), "uid")
    true = seen.where("n is null").withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= top + 1)
    true = [(r["q"], r["depth"]) for r in true.select("q", "uid", "depth").collect() if r["uid"] != probes[r["q"]]["uid"]]
    offered = np.zeros((len(probes), BITS + 1))
    for row in seen.where("n is not null").groupBy("q", "depth").agg(F.sum("n").alias("n")).collect():
        offered[row["q"], row["depth"]] = row["n"]
    offered = offered[:, ::-1].cumsum(axis=1)[:, ::-1]
    budget = 64
    while True:
        reached = reach(offered, budget)
        got = np.mean([depth >= reached[q] for q, depth in true]) if true else 1.0
        if got >= recall or not reached.any():
            return budget, int(reached.min()), float(got)
        budget *= 2


def reach(offered: np.ndarray, budget: int, floor: int = 0) -> np.ndarray:
    """Longest prefix at which the trees together offer the budget; ``offered`` counts vectors by prefix length from the floor on."""
    enough = offered >= budget
    return np.where(enough.any(axis=1), enough.shape[1] - 1 - enough[:, ::-1].argmax(axis=1), 0) + floor


# --- searching -----------------------------------------------------------------------------------


def _bounds(sorted_keys: np.ndarray, keys: np.ndarray, depth: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Range of the sorted array that shares ``depth`` bits with each key."""
    span = np.int64(1) << (BITS - np.asarray(depth, np.int64))
    low = keys & ~(span - 1)
    return np.searchsorted(sorted_keys, low, "left"), np.searchsorted(sorted_keys, low + (span - 1), "right")


def search(vectors: DataFrame, is_query, id_: str = "vec_id", vector: str = "embedding", top: int = 5, recall: float = 0.95) -> DataFrame:
    """``(query_id, rank, <id>, score)``: the ``top`` nearest found of every query; ``is_query`` is a condition on the id column."""
    spark = vectors.sparkSession
    index = written(build_index(vectors, id_, vector, top), "index")
    asked = usable(vectors.select(F.col(id_).alias("query_id"), F.col(vector).cast("array<double>").alias("vector")).where(F.col(id_).isNotNull() & is_query), "vector")
    asked = written(asked.distinct().join(index.select("uid", "vector"), "vector").select("query_id", "uid"), "asked")
    queries = written(index.join(asked.select("uid").distinct(), "uid", "left_semi"), "queries")
    budget, floor, _ = measure(index, queries, top, recall)
    chunks = max(1, -(-index.count() // ((1 << floor) * CHUNK_ROWS)))
    parts = shuffle_partitions(spark)

    cell = (F.shiftright("key", BITS - floor) * TREES + F.col("tree")).alias("cell")
    base = index.select("uid", "size", "vector", F.posexplode("keys").alias("tree", "key")).select(
        cell, F.pmod(F.xxhash64("uid"), F.lit(chunks)).cast("int").alias("chunk"), "size", F.lit(False).alias("query"), "key", "uid", "vector", F.lit(0).alias("depth")
    )
    probe = queries.select("uid", "size", "vector", F.posexplode("keys").alias("tree", "key")).select(
        cell, F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "size", F.lit(True).alias("query"), "key", "uid", "vector"
    )
    names = ["cell", "chunk", "size"]

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(parts, *names).sortWithinPartitions(*names, "query", "key")

    def split(group: pa.RecordBatch) -> tuple[pa.RecordBatch, pa.RecordBatch]:
        n = int(np.searchsorted(group.column(3).to_numpy(zero_copy_only=False), True))
        return group.slice(0, n), group.slice(n)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, names):
            rows, asking = split(group)
            keys, own = rows.column(4).to_numpy(), asking.column(4).to_numpy()
            if not len(own):
                continue
            offered = np.stack([np.subtract(*_bounds(keys, own, d)[::-1]) for d in range(floor, BITS + 1)], axis=1)
            q, d = np.nonzero(offered)
            yield pa.RecordBatch.from_arrays([asking.column(5).take(pa.array(q)), pa.array((d + floor).astype(np.int32)), pa.array(offered[q, d])], ["uid", "depth", "n"])

    thin = [c for c in names] + ["query", "key", "uid"]
    offered = dealt(base.select(*thin).unionByName(probe.select(*thin))).mapInArrow(count, "uid bigint, depth int, n bigint")
    depths = offered.groupBy("uid", "depth").agg(F.sum("n").alias("n")).groupBy("uid").agg(
        F.coalesce(F.max(F.when(F.col("n") >= budget, F.col("depth"))), F.lit(floor)).alias("depth"), (F.max("n") < budget).alias("short")
    )
    depths = written(depths, "depths")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, names):
            rows, asking = split(group)
            if not (rows.num_rows and asking.num_rows):
                continue
            keys, uids, unit = rows.column(4).to_numpy(), rows.column(5).to_numpy(), _unit(_matrix(rows.column(6)))
            low, high = _bounds(keys, asking.column(4).to_numpy(), asking.column(7).to_numpy())
            own = _unit(_matrix(asking.column(6)))
            out = []
            for i, uid in enumerate(asking.column(5).to_pylist()):
                got = unit[low[i]:high[i]] @ own[i]
                ids = uids[low[i]:high[i]]
                best = np.flatnonzero(got >= np.partition(got, -top - 1)[-top - 1]) if len(got) > top + 1 else np.arange(len(got))
                best = best[np.lexsort((ids[best], -got[best]))][: top + 1]
                out.append((np.full(len(best), uid), ids[best], got[best]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["asked", "uid", "score"])

    full = [*thin, "vector", "depth"]
    kind, best = "asked bigint, uid bigint, score double", Window.partitionBy("asked").orderBy(F.desc("score"), "uid")

    def nearest(scored: DataFrame) -> DataFrame:
        return scored.groupBy("asked", "uid").agg(F.max("score").alias("score")).withColumn("n", F.row_number().over(best)).where(F.col("n") <= top + 1)

    met = depths.where(~F.col("short")).select("uid", "depth")
    found = written(nearest(dealt(base.select(*full).unionByName(probe.join(met, "uid").select(*full))).mapInArrow(score, kind)), "near")
    enough = found.groupBy("asked").count().where(F.col("count") > top).select(F.col("asked").alias("uid"))
    short = written(queries.select("uid", "size", "vector").join(enough, "uid", "left_anti"), "short")
    if n_short := short.count():
        n_rows, n_asking = -(-index.count() // CHUNK_ROWS), -(-n_short // BLOCK_QUERIES)
        block = {n: F.pmod(F.xxhash64("uid"), F.lit(n)) for n in (n_rows, n_asking)}
        each = {n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (n_rows, n_asking)}
        rest = [F.lit(0).cast("bigint").alias("key"), "uid", "vector", F.lit(0).alias("depth")]
        rows = index.select(block[n_rows].cast("bigint").alias("cell"), each[n_asking].alias("chunk"), "size", F.lit(False).alias("query"), *rest)
        asking = short.select(each[n_rows].alias("cell"), block[n_asking].cast("int").alias("chunk"), "size", F.lit(True).alias("query"), *rest)
        every = nearest(dealt(rows.unionByName(asking)).mapInArrow(score, kind))
        found = found.join(enough.select(F.col("uid").alias("asked")), "asked", "left_semi").unionByName(every)
    found = written(found.join(index.select("uid", "ids"), "uid").select("asked", "score", F.explode("ids").alias("id")), "found")
    pairs = asked.join(found, asked["uid"] == found["asked"]).where("query_id <> id").select("query_id", "id", "score")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = pairs.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_), "score")


def recall_against(found: DataFrame, vectors: dict[int, np.ndarray], top: int) -> float:
    """Share of the true nearest neighbours that were found, for tests on bounded tables."""
    ids = np.array(sorted(vectors))
    unit = _unit(np.array([vectors[i] for i in ids]))
    hits = total = 0
    by_query: dict[int, set[int]] = {}
    for row in found.collect():
        by_query.setdefault(row[0], set()).add(row[2])
    for query, got in by_query.items():
        scores = unit @ _unit(np.asarray(vectors[query])[None])[0]
        order = [i for i in ids[np.lexsort((ids, -scores))] if i != query][:top]
        hits, total = hits + len(got & set(order)), total + len(order)
    return hits / max(total, 1)
