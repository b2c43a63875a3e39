"""Lookups and frame alignment."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpoint.operators.keys import latest_per_key
from touchpoint.session import scratch_path

# A dimension is broadcast only below both limits; beyond them the hot keys of its join are salted.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024
SALTS = 32
HOT_KEYS = 1_000
TRACKED_KEYS = 20_000


def is_small(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None, required: str | None = None) -> bool:
    """Whether ``df`` is proven to fit both limits; at most ``max_rows + 1`` of its rows are looked at.

    With ``required`` an empty frame is an error of that text.
    """
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = BROADCAST_BYTES if max_bytes is None else max_bytes
    rows = df.limit(max_rows + 1).select(F.octet_length(F.to_json(F.struct("*"))).alias("size"))
    measured = rows.agg(F.count("size").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("b")).first()
    if required and measured["n"] == 0:
        raise ValueError(required)
    return measured["n"] <= max_rows and measured["b"] <= max_bytes


def hot_keys(df: DataFrame, key: str) -> list[int]:
    """Hashes of the keys with many rows, at most ``HOT_KEYS``, from a frequent-items sketch that tasks build and merge.

    A key is hot when it has more than a quarter of an even partition. Its count in the sketch is never
    too low by more than ``rows / TRACKED_KEYS``, so none of the keys that could slow a task is missed.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = df.agg(F.count(key).alias("n"), F.expr(f"approx_top_k(xxhash64(`{key}`), {HOT_KEYS}, {TRACKED_KEYS})").alias("top")).first()
    return [x["item"] for x in found["top"] or [] if x["count"] * 4 * parts > found["n"] and x["count"] > 1]


def lookup_join(df: DataFrame, dimension: DataFrame, key: str, required: str | None = None) -> DataFrame:
    """Left join to a dimension with one row per key.

    A small dimension is broadcast. A larger one is shuffled once and joined plainly, but for the hot keys of ``df``: their
    rows get a salt, the number of their partition (the same when a task is repeated), and only the dimension's rows of hot keys
    are copied once per salt. Adaptive execution alone would not do: a dimension that was just reduced to one row per key
    is joined without a shuffle of its own, and then Spark splits neither side.
    """
    if is_small(dimension, required=required):
        return df.join(F.broadcast(dimension), key, "left")
    hot = F.xxhash64(key).isin(hot_keys(df, key))
    salted = df.withColumn("_salt", F.when(hot, F.pmod(F.spark_partition_id(), F.lit(SALTS))).otherwise(0))
    every, own = F.sequence(F.lit(0), F.lit(SALTS - 1)), F.array(F.lit(0))
    copies = dimension.withColumn("_salt", F.explode(F.when(hot, every).otherwise(own)))
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")


def alias_map(speakers: DataFrame, position: str) -> DataFrame:
    """Lower-cased name or alias → mail address; of two equal names the later one counts.

    Later means: the later speaker, then aliases after the name, then the later alias.
    """
    names = F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))
    listed = speakers.select(position, "email", F.posexplode(names).alias("_place", "_name"))
    keyed = listed.select(F.lower("_name").alias("lookup_name"), "email", position, "_place")
    newest = latest_per_key(keyed, ["lookup_name"], [F.desc(position), F.desc("_place")])
    return newest.select("lookup_name", "email")


def resolve_names(df: DataFrame, name: str, speakers: DataFrame, position: str, out: str) -> DataFrame:
    """Replace a speaker name by the mail address found for it; unknown names stay as they are.

    The name is compared in lower case and is not trimmed. An empty speaker list is an error.
    """
    lookup = alias_map(speakers, position).withColumnRenamed("email", "_email")
    named = df.withColumn("lookup_name", F.lower(name))
    found = lookup_join(named, lookup, "lookup_name", "the speaker dimension is empty")
    return found.withColumn(out, F.coalesce("_email", name)).drop("lookup_name", "_email")


def stack_frames(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def align_frames(frames: list[DataFrame]) -> DataFrame:
    """Combine frames on the columns they all share; the others are filled with null.

    The result is that of chained full outer joins. Rows with a null in a shared column match nothing and are kept, and so are
    copies of a row. A column that several frames have, but not all, takes the first value that is not null, in frame order.

    All frames go through one shuffle by the shared columns, as one tagged union, whatever their number; keys that no
    frame repeats are paired there. Where a frame repeats a key, pairing multiplies rows: those keys alone are joined frame by
    frame (``_join_frames``), so that Spark can split a hot one.
    """
    shared = [c for c in frames[0].columns if all(c in f.columns for f in frames)]
    if not shared:
        raise ValueError("the frames share no column")
    spark = frames[0].sparkSession
    keyed = reduce(and_, [F.col(c).isNotNull() for c in shared])
    extra = {i: [c for c in f.columns if c not in shared] for i, f in enumerate(frames)}
    tagged = [
        f.where(keyed).select(*shared, *[(F.struct(F.lit(True).alias("_there"), *extra[j]) if i == j else F.lit(None)).alias(f"_frame{j}") for j in extra])
        for i, f in enumerate(frames)
    ]
    picked = [F.any_value(f"_frame{i}", True).alias(f"_frame{i}") for i in extra]
    repeats = reduce(or_, [F.count(f"_frame{i}") > 1 for i in extra]).alias("_repeats")
    path = scratch_path(spark, "aligned")
    reduce(DataFrame.union, tagged).groupBy(*shared).agg(*picked, repeats).write.parquet(path)
    grouped = spark.read.parquet(path)
    names = list(dict.fromkeys(c for i in extra for c in extra[i]))
    values = [F.coalesce(*[F.col(f"_frame{i}.`{c}`") for i in extra if c in extra[i]]).alias(c) for c in names]
    paired = grouped.where("not _repeats").select(*shared, *values)
    parts = [paired, *[f.where(~keyed) for f in frames]]
    again = grouped.where("_repeats").select(*shared)
    if not again.isEmpty():
        again = F.broadcast(again) if is_small(again) else again
        parts.append(_join_frames([f.join(again, shared, "left_semi").select(*f.columns) for f in frames], shared))
    return stack_frames(parts)


def _join_frames(frames: list[DataFrame], shared: list[str]) -> DataFrame:
    """Chained full outer joins, each written as a left outer join plus the unmatched right rows.

    Spark can split a skewed left side in both, but no side of a full outer join. A pair uses its
    left side twice, so in a chain of more than two frames each result but the last is written to the
    shared scratch folder; otherwise the plan would double with every frame.
    """
    def pair(left: DataFrame, right: DataFrame) -> DataFrame:
        extra = [c for c in right.columns if c not in shared]
        clash = [c for c in extra if c in left.columns]
        right = right.withColumnsRenamed({c: f"_right_{c}" for c in clash})
        matched = left.join(right, shared, "left")
        unmatched = right.join(left.select(*shared), shared, "left_anti")
        both = matched.unionByName(unmatched, allowMissingColumns=True)
        merged = {c: F.coalesce(F.col(c), F.col(f"_right_{c}")) for c in clash}
        return both.withColumns(merged).drop(*[f"_right_{c}" for c in clash])

    combined = frames[0]
    for i, frame in enumerate(frames[1:], 1):
        combined = pair(combined, frame)
        if 1 < len(frames) - 1 != i:
            path = scratch_path(combined.sparkSession, "aligned")
            combined.write.parquet(path)
            combined = combined.sparkSession.read.schema(combined.schema).parquet(path)
    return combined


def pair_receipts(receipts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Receipts with the transaction of the same id."""
    chosen: list[Column] = [
        F.col("r.id").alias("id"), F.col("r.body").alias("body"), F.col("t.amount").alias("amount"),
        F.col("t.description").alias("description"), F.col("t.user_id").alias("user_id"),
    ]
    return receipts.alias("r").join(transactions.alias("t"), F.col("r.id") == F.col("t.id")).select(*chosen)
