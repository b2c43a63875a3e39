"""N-gram Jaccard join by parity sketches.

The words of a text are cut into shingles and every document becomes a set of 64-bit hashes. Two
sets of sizes a and b are similar (100 * intersection >= percent * union) only if their symmetric
difference is at most t = (100 - percent) * (a + b) / (100 + percent).

* **Size bands.** Band c + 1 starts above 1 / similarity ** 2 times the start of band c, so similar
  documents lie in the same band or in neighbouring ones. A document is sketched in the layout of its
  own band, and in that of the next one if it could have a partner there.
* **Parity sketch.** The layout of a band deals the shingles to W > t words and XORs their hashes word
  by word. A shingle that two documents do not share changes one word, so the number of differing
  words never exceeds the symmetric difference, and of more than t words at least one is equal
  (pigeonhole). Every non-empty word is a join key. A document with t or fewer non-empty words also
  has all its shingles as keys, so that two such documents still meet. No similar pair is lost.
* **A second, 512-bit parity sketch** per document (each shingle flips one bit) has a Hamming distance
  that never exceeds the symmetric difference either; pairs above t are dropped before verification.
  Then all parity words of the larger document's layout are compared, by 16 bits each: pairs that differ in more than t
  words are dropped as well. Both bounds are exact, so they drop no similar pair.
* **Verification** intersects the whole shingle sets of the pairs that remain.

Groups: documents with the same shingle set are one class, represented by its smallest doc_id. Under a
key, a task links its documents to its first one and sends only that one on, so a key has at most one
row per flush of a task in the shuffle, and n documents under a key make n - 1 pairs. Pairs that fail, and may hide
others, send their neighbourhood into a second search. Its first turns are stars again: per key, one member of the key's main
component, another one in every key and turn, against the members outside of it; so a document meets many different members of the
component at a cost linear in its keys, and what they link is no longer compared. Only documents that are then still
outside a key's main component are compared with all of its members; the parity sketches decide inside that join, and
few pairs leave it. Pairs inside a component are not needed for membership.

Rows whose doc_id is null link with nothing and have no component. Texts without words have no
shingles and are their own component. Repeated rows are returned as often as they come.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchpoint.llm import rolling
from touchpoint.llm.components import components
from touchpoint.llm.rolling import U64, mix
from touchpoint.llm.scratch import BROADCAST_ROWS, broadcast_if_few, release, written

SKETCH_WORDS = 8
SKETCH = [f"s{i}" for i in range(SKETCH_WORDS)]
#: Keys held by a task before it sends them on.
FLUSH_KEYS = 300_000
#: Documents described by a task before it sends them on.
FLUSH_ROWS = 5_000
#: Turns of the second search that compare with one member per key.
STAR_TURNS = 1
#: Candidate pairs from a failed pair to a document that it may have hidden from another, at most.
HOPS = 3


class Layouts:
    """Size bands and the parity layouts of a similarity, in percent."""

    def __init__(self, percent: int, largest: int = 1 << 40):
        growth = (100 / percent) ** 2
        starts = [1]
        while starts[-1] <= largest:
            starts.append(int(starts[-1] * growth) + 1)
        self.percent = percent
        self.starts = np.array(starts, np.int64)
        top = self.starts[1:] - 1
        self.most = (100 - percent) * 2 * top // (100 + percent)
        self.words = self._words(self.starts[:-1] * percent / 100)

    def _words(self, least: np.ndarray) -> np.ndarray:
        """Words per band: more than t by the empty words to be expected in a set of the least size, at most by a quarter."""
        words = self.most + 1
        for _ in range(8):
            empty = words * np.exp(-np.maximum(least, 1) / words)
            words = np.minimum(np.ceil(self.most + 1 + empty + 2 * np.sqrt(empty)), (self.most + 1) * 5 // 4 + 1).astype(np.int64)
        return np.where(self.most > 0, words, 1)

    def _dealt(self, hashes: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
        """Non-empty words of a set: their numbers and the XOR of their hashes."""
        word = ((hashes >> U64(32)) * U64(int(self.words[band]))) >> U64(32)
        order = np.argsort(word, kind="stable")
        word = word[order]
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        return word[first], np.bitwise_xor.reduceat(hashes[order], first)

    def short_words(self, hashes: np.ndarray, band: int) -> np.ndarray:
        """All words of a layout by 16 bits; empty ones are 0."""
        out = np.zeros(int(self.words[band]), np.int16)
        number, parity = self._dealt(hashes, band)
        out[number.astype(np.int64)] = (mix(parity) >> U64(48)).astype(np.uint16).view(np.int16)
        return out

    def of(self, size: int) -> list[int]:
        """Layouts of a set: its own band's, and the next one's if a partner may be there."""
        own = int(np.searchsorted(self.starts, size, "right")) - 1
        return [own, own + 1] if 100 * size >= self.percent * int(self.starts[own + 1]) else [own]

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """Join keys of a distinct, non-empty shingle set."""
        out = []
        for band in self.of(len(hashes)):
            number, parity = self._dealt(hashes, band)
            out.append(mix(parity ^ mix(number * U64(4096) + U64(2 * band + 2))))
            if len(number) <= self.most[band]:
                out.append(mix(hashes + U64(2 * band + 1)))
        return np.concatenate(out)


def bit_sketch(hashes: np.ndarray) -> np.ndarray:
    """Parity bits of a set, as 64-bit words."""
    n = 64 * SKETCH_WORDS
    bits = np.bincount((hashes >> U64(13)) & U64(n - 1), minlength=n).astype(np.uint8) & 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch], k: int, table: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(doc_id, distinct shingle hashes)`` of every row with a doc_id, and None as doc_id for the others."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for row, stop, data, offsets in rolling.text_slices(batch, "text", rolling.SMALL_SLICE_BYTES):
            yield from zip(ids[row:stop], rolling.sliced_shingle_sets(data, offsets, k, table), strict=True)


def _digest(hashes: np.ndarray) -> tuple[int, int]:
    one, two = mix(hashes + U64(3)), mix(hashes ^ U64(0x5DEECE66D1234567))
    return int(one.sum().view(np.int64)), int(np.bitwise_xor.reduce(two).view(np.int64)) if len(two) else 0


def describe(docs: DataFrame, k: int, table: np.ndarray) -> DataFrame:
    """Set size, set digest, bit sketch of every row, and the smallest doc_id with the same set among rows sent together."""

    def send(rows: list, least: dict) -> pa.RecordBatch:
        sketch = np.stack([r[2] for r in rows])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1][2] for r in rows], pa.int64()),
                pa.array([r[1][0] for r in rows], pa.int64()),
                pa.array([r[1][1] for r in rows], pa.int64()),
                pa.array([None if r[0] is None else least.get(r[1], r[0]) for r in rows], pa.int64()),
                *[pa.array(sketch[:, i]) for i in range(SKETCH_WORDS)],
            ],
            ["doc_id", "n_shingles", "d1", "d2", "local", *SKETCH],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, least = [], {}
        for doc_id, hashes in _sets(batches, k, table):
            one, two = _digest(hashes)
            key = (one, two, len(hashes))
            rows.append((doc_id, key, bit_sketch(hashes)))
            if doc_id is not None and len(hashes):
                least[key] = min(least.get(key, doc_id), doc_id)
            if len(rows) >= FLUSH_ROWS:
                yield send(rows, least)
                rows, least = [], {}
        if rows:
            yield send(rows, least)

    schema = "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, local bigint, " + ", ".join(f"{s} bigint" for s in SKETCH)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _candidates(docs: DataFrame, layouts: Layouts, k: int, table: np.ndarray) -> DataFrame:
    """Pairs ``(a, b)`` that join every document under a key to one document of the key."""

    def send(keys: list[np.ndarray], owners: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, owner = np.concatenate(keys), np.concatenate(owners)
        order = np.lexsort((owner, key))
        key, owner = key[order], owner[order]
        head = np.concatenate(([True], key[1:] != key[:-1]))
        leader = owner[head][np.cumsum(head) - 1]
        pairs = np.unique(np.stack((owner, leader), axis=1)[owner != leader], axis=0)
        with np.errstate(over="ignore"):
            pair_key = mix(mix(pairs[:, 0].astype(U64)) + pairs[:, 1].astype(U64))
        out_key = np.concatenate((key[head], pair_key)).view(np.int64)
        a = np.concatenate((owner[head], pairs[:, 0]))
        b = np.concatenate((np.zeros(head.sum(), np.int64), pairs[:, 1]))
        known = np.concatenate((np.zeros(head.sum(), bool), np.ones(len(pairs), bool)))
        for at in range(0, len(a), 100_000):
            cut = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_key[cut]), pa.array(a[cut]), pa.array(b[cut], mask=~known[cut])], ["key", "a", "b"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners, held, seen = [], [], 0, set()
        for doc_id, hashes in _sets(batches, k, table):
            if doc_id is None or not len(hashes) or (digest := _digest(hashes)) in seen:
                continue
            seen.add(digest)
            with np.errstate(over="ignore"):
                keys.append(layouts.keys(hashes))
            owners.append(np.full(len(keys[-1]), doc_id, np.int64))
            held += len(keys[-1])
            if held >= FLUSH_KEYS:
                yield from send(keys, owners)
                keys, owners, held = [], [], 0
        if held:
            yield from send(keys, owners)

    rows = docs.select("doc_id", "text").mapInArrow(run, "key bigint, a bigint, b bigint")
    leader = F.min("a").over(Window.partitionBy("key"))
    found = rows.select("a", F.coalesce("b", leader).alias("b")).where("a <> b")
    return found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _classes(described: DataFrame) -> DataFrame:
    """Every row with the representative of its class: the smallest doc_id with the same shingle set.

    A class first has one row per flush of a task (``local``), so a hot class is small in the window.
    """
    heads = described.where("doc_id = local and n_shingles > 0").select("local", "d1", "d2").distinct()
    heads = written(heads.withColumn("rep", F.min("local").over(Window.partitionBy("d1", "d2"))), "heads")
    return described.join(heads, ["local", "d1", "d2"], "left").select("doc_id", "n_shingles", *SKETCH, F.coalesce("rep", "doc_id").alias("rep"))


def _as_classes(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of documents as pairs of class representatives, with what is known of both sets."""
    known = ["n_shingles", *SKETCH]
    for side in ("a", "b"):
        of = classes.select(F.col("doc_id").alias(side), F.col("rep").alias(f"rep_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in known])
        pairs = pairs.join(of, side)
    swap = F.col("rep_a") < F.col("rep_b")
    columns = []
    for name in ("rep", *known):
        columns += [F.when(swap, F.col(f"{name}_b")).otherwise(F.col(f"{name}_a")).alias(f"{name}_a"), F.when(swap, F.col(f"{name}_a")).otherwise(F.col(f"{name}_b")).alias(f"{name}_b")]
    return pairs.where("rep_a <> rep_b").select(*columns).withColumnsRenamed({"rep_a": "a", "rep_b": "b"}).dropDuplicates(["a", "b"])


def _near(percent: int):
    """The parity bits and the sizes allow the pair to be similar."""
    distance = sum((F.bit_count(F.col(f"{s}_a").bitwiseXOR(F.col(f"{s}_b"))) for s in SKETCH), F.lit(0))
    return distance * (100 + percent) <= (F.col("n_shingles_a") + F.col("n_shingles_b")) * (100 - percent)


def _batch(rows: list[tuple[int, int, np.ndarray]], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    """One batch of ``(doc_id, number, values)`` rows."""
    offsets = np.cumsum([0, *(len(v) for _, _, v in rows)])
    values = pa.array(np.concatenate([v for _, _, v in rows]), kind)
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)], names)


def _of_needed(docs: DataFrame, pairs: DataFrame, make, kind: pa.DataType, spark_kind: str, k: int, table: np.ndarray) -> DataFrame:
    """``(doc_id, number, values)`` rows that ``make`` gives for the shingle sets of the documents in a pair."""
    needed = written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "needed")
    names = ["doc_id", "number", "values"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for doc_id, hashes in _sets(batches, k, table):
            for number, values in make(hashes):
                rows.append((doc_id, number, values))
                size += len(values)
            if size >= 200_000:
                yield _batch(rows, kind, names)
                rows, size = [], 0
        if rows:
            yield _batch(rows, kind, names)

    wanted = docs.select("doc_id", "text").join(broadcast_if_few(needed), "doc_id", "left_semi")
    return written(wanted.mapInArrow(run, f"doc_id bigint, number int, values array<{spark_kind}>"), "values")


def _plausible(docs: DataFrame, pairs: DataFrame, layouts: Layouts, k: int, table: np.ndarray) -> DataFrame:
    """The pairs that do not differ in more than t parity words of the larger document's layout.

    Words are compared by 16 bits: equal bits of different words only let a pair pass.
    """

    def make(hashes: np.ndarray) -> list[tuple[int, np.ndarray]]:
        with np.errstate(over="ignore"):
            return [(band, layouts.short_words(hashes, band)) for band in layouts.of(len(hashes))] if len(hashes) else []

    words = _of_needed(docs, pairs, make, pa.int16(), "smallint", k, table)
    starts = F.array(*[F.lit(int(x)) for x in layouts.starts])
    number = (F.size(F.filter(starts, lambda x: x <= F.col("largest"))) - 1).alias("number")
    both = pairs.select("a", "b", "total", number)
    for side, name in (("a", "x"), ("b", "y")):
        both = both.join(words.select(F.col("doc_id").alias(side), "number", F.col("values").alias(name)), [side, "number"])
    differ = F.size(F.filter(F.zip_with("x", "y", lambda x, y: x != y), lambda z: z))
    return both.where(differ * (100 + layouts.percent) <= F.col("total") * (100 - layouts.percent)).select("a", "b").distinct()


def _verified(docs: DataFrame, pairs: DataFrame, layouts: Layouts, k: int, table: np.ndarray) -> DataFrame:
    """The pairs whose whole shingle sets are similar; only sets of plausible pairs are read and sent."""
    pairs = written(_plausible(docs, pairs, layouts, k, table), "plausible")
    sets = _of_needed(docs, pairs, lambda hashes: [(0, hashes.view(np.int64))], pa.int64(), "bigint", k, table)
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("values").alias("x")), "a")
    both = both.join(sets.select(F.col("doc_id").alias("b"), F.col("values").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    both = both.select("a", "b", shared.alias("shared"), (F.size("x") + F.size("y") - shared).alias("union"))
    return both.where(F.col("shared") * 100 >= F.col("union") * layouts.percent).select("a", "b")


def _sizes() -> list:
    """What the filters need to know of the two set sizes."""
    one, two = F.col("n_shingles_a"), F.col("n_shingles_b")
    return [(one + two).alias("total"), F.greatest(one, two).alias("largest")]


def _rest(docs: DataFrame, pairs: DataFrame, links: DataFrame, classes: DataFrame, layouts: Layouts, k: int, table: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """The links with those that failed pairs have hidden, and their components.

    Looks only at the documents within ``HOPS`` candidate pairs of a failed pair across components. That is enough: two documents
    under a key are joined by at most four candidate pairs (to their leaders in a flush, and from there to that of the key), and if
    they are in different components one of these pairs failed.
    """
    joined = written(components(links), "joined")
    label = {side: joined.select(F.col("node").alias(side), F.col("component").alias(f"c{side}")) for side in ("a", "b")}
    split = pairs.select("a", "b").join(label["a"], "a", "left").join(label["b"], "b", "left")
    split = split.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    if split.isEmpty():
        return links, joined
    near = written(split.select(F.explode(F.array("a", "b")).alias("a")).distinct(), "near")
    both = pairs.select("a", "b").union(pairs.select("b", "a"))
    for _ in range(HOPS):
        reached = both.join(broadcast_if_few(near), "a", "left_semi").select(F.col("b").alias("a"))
        near = written(near.union(reached).distinct(), "near")
    nodes = near.withColumnRenamed("a", "doc_id")
    nodes = nodes.join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", F.coalesce("component", "doc_id").alias("component"))
    nodes = broadcast_if_few(written(nodes, "open"))
    wanted = docs.select("doc_id", "text").join(nodes, "doc_id").select("doc_id", "text", "component")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, int, int]]:
        for batch in batches:
            component = iter(batch.column(2).to_pylist())
            for doc_id, hashes in _sets(iter([batch]), k, table):
                with np.errstate(over="ignore"):
                    keys = np.unique(layouts.keys(hashes)).view(np.int64) if len(hashes) else np.zeros(0, np.int64)
                yield keys, doc_id, next(component)

    def labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each key and component once per task, so that a hot key has few rows."""
        held, size = [], 0

        def send() -> pa.RecordBatch:
            key, component = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.lexsort((component, key))
            key, component = key[order], component[order]
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (component[1:] != component[:-1]))) if len(key) else np.zeros(0, bool)
            return pa.RecordBatch.from_arrays([pa.array(key[new]), pa.array(component[new])], ["key", "component"])

        for keys, _, component in keyed(batches):
            held.append((keys, np.full(len(keys), component)))
            size += len(keys)
            if size >= FLUSH_KEYS:
                yield send()
                held, size = [], 0
        if held:
            yield send()

    def members_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, doc_id, _ in keyed(batches):
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), doc_id))], ["key", "doc_id"])

    spread = wanted.mapInArrow(labels, "key bigint, component bigint").groupBy("key").agg(F.min("component").alias("one"), F.max("component").alias("two"))
    mixed = written(spread.where("one <> two").select("key"), "mixed")
    rows = written(wanted.mapInArrow(members_of, "key bigint, doc_id bigint").join(broadcast_if_few(mixed, BROADCAST_ROWS), "key", "left_semi"), "open_keys")
    del spread, wanted
    release(docs.sparkSession)
    sketches = classes.where("doc_id = rep").select("doc_id", "n_shingles", *SKETCH).distinct()
    known = pairs.select("a", "b")
    for turn in range(STAR_TURNS + 1):
        members = _open_members(rows, joined)
        if members.isEmpty():
            break
        met = _met_leaders(members, sketches, layouts.percent, turn) if turn < STAR_TURNS else _met_all(members, sketches, layouts.percent)
        met = written(met.join(known, ["a", "b"], "left_anti"), "hidden")
        if met.isEmpty():
            continue
        found = written(_verified(docs, met, layouts, k, table), "found")
        known = known.union(met.select("a", "b"))
        if not found.isEmpty():
            links = written(links.union(found), "verified")
            joined = written(components(links), "joined")
        release(docs.sparkSession)
    return links, joined


def _open_members(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """``(key, main, component, doc_id)`` of the keys whose members are in several components; ``main`` is the component with most of them."""
    of = joined.withColumnRenamed("node", "doc_id")
    labelled = written(rows.join(of, "doc_id", "left").select("key", "doc_id", F.coalesce("component", "doc_id").alias("component")), "labelled")
    counts = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return written(labelled.join(main.select("key", "main"), "key").select("key", "main", "component", "doc_id"), "members")


def _ordered(one: str, two: str) -> list:
    return [F.greatest(one, two).alias("a"), F.least(one, two).alias("b")]


def _near_pairs(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes and sketches allow them to be similar, with what verification needs of the sizes."""
    for side in ("a", "b"):
        pairs = pairs.join(sketches.select(F.col("doc_id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n_shingles", *SKETCH)]), side)
    return pairs.where(_fits(percent) & _near(percent)).select("a", "b", *_sizes())


def _fits(percent: int):
    return F.least("n_shingles_a", "n_shingles_b") * 100 >= F.greatest("n_shingles_a", "n_shingles_b") * percent


def _met_leaders(members: DataFrame, sketches: DataFrame, percent: int, turn: int) -> DataFrame:
    """Every member outside the main component of a key with one member of it, another one in every key and turn."""
    leaders = members.where("component = main").groupBy("key").agg(F.min_by("doc_id", F.xxhash64("doc_id", "key", F.lit(turn))).alias("leader"))
    pairs = members.where("component <> main").join(leaders, "key").select(*_ordered("doc_id", "leader")).distinct()
    return _near_pairs(pairs, sketches, percent)


def _met_all(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Every member outside the main component of a key with all members of other components."""
    known = members.join(sketches, "doc_id")
    sides = {s: known.select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("main", "component", "doc_id", "n_shingles", *SKETCH)]) for s in ("a", "b")}
    minor = sides["a"].where("component_a <> main_a")
    on = (minor["key"] == sides["b"]["key"]) & (F.col("component_a") != F.col("component_b")) & _fits(percent) & _near(percent)
    return minor.join(sides["b"], on).select(*_ordered("doc_id_a", "doc_id_b"), *_sizes()).distinct()


def similar_classes(docs: DataFrame, percent: int = 80, k: int = 5, table: np.ndarray = rolling.NOT_SPACE) -> tuple[DataFrame, DataFrame]:
    """``(rows, links)`` of a Jaccard self-join over word shingles.

    ``rows`` has one row per input row: doc_id, n_shingles, rep (smallest doc_id with the same shingle set)
    and component_id (smallest doc_id reachable by links). ``links`` has verified pairs of representatives;
    pairs of representatives that are in one component anyway need not all be listed.
    """
    layouts = Layouts(percent)
    classes = written(_classes(written(describe(docs, k, table), "described")), "classes")
    known = written(_as_classes(_candidates(docs, layouts, k, table), classes), "pairs")
    release(docs.sparkSession)
    pairs = known.select("a", "b")
    links = written(_verified(docs, known.where(_near(percent)).select("a", "b", *_sizes()), layouts, k, table), "verified")
    release(docs.sparkSession)
    links, joined = _rest(docs, pairs, links, classes, layouts, k, table)
    rows = classes.join(joined, classes["rep"] == joined["node"], "left").select(
        "doc_id", "n_shingles", "rep", F.coalesce("component", "rep").alias("component_id")
    )
    return rows, links
