"""Keys: newest row per key, new keys only, merges, ledgers, running numbers.

Sizes: every operator here shuffles on the key and keeps at most one row per key and task before
the shuffle (``row_number() <= k`` gets a partial group limit, ``distinct`` a partial aggregate), so
a key that holds a large part of the rows does not load one task. Joins are plain equi joins: with
adaptive execution Spark broadcasts a side it has measured to be small and splits skewed left sides.
It can split only when both sides are shuffled for the join, so pass key tables as they are scanned,
repeated keys included, rather than their distinct keys.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from math import isqrt
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from touchpoint.session import scratch_path


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key in ``order``, which must name the newest row first."""
    newest = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= n).drop("_rank")


def key_set(df: DataFrame, key: str) -> DataFrame:
    """The distinct keys of a table; only the key column is read."""
    return df.select(key).distinct()


def new_keys_only(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key the target lacks. Rows without a key cannot be stored and are left out."""
    return df.where(F.col(key).isNotNull()).join(existing.select(key), key, "left_anti")


def resume(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the ledger; repeated rows stay repeated, and so does a null key."""
    return df.join(done.select(key), key, "left_anti")


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Bag difference on a key: removes every row with a matching key, keeps duplicates."""
    return resume(left, right, key)


def key_union(ledger: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Set union of two key tables."""
    return ledger.select(key).union(new.select(key)).distinct()


def merge_rows(target: DataFrame, source: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Target after an upsert: matched rows replaced, the others added.

    The source is first reduced to its newest row per key, also when the target is empty.
    """
    newest = latest_per_key(source.where(F.col(key).isNotNull()), [key], order)
    kept = target.join(newest.select(key), key, "left_anti")
    return kept.select(*target.columns).unionByName(newest.select(*target.columns))


def next_id(df: DataFrame, key: str) -> DataFrame:
    """One row with the next free id; an empty table, or one whose largest id is 0, starts at 1."""
    top = F.coalesce(F.max(key), F.lit(0))
    return df.agg(F.when(top == 0, 1).otherwise(top + 1).cast("bigint").alias("next_id"))


def allocate_ids(rows: DataFrame, table: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Give a small sample of rows the ids after the table's largest one.

    The rows are a sample of at most a handful (see ``sample_rows``), so one unpartitioned window
    is enough; for large inputs use ``running_total``.
    """
    position = F.row_number().over(Window.orderBy(*order))
    return rows.withColumn(key, next_id(table, key).scalar() + position - 1)


#: Rows of a range block, at least; beyond that a block has about as many rows as there are blocks.
MIN_BLOCK_ROWS = 20_000


def range_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column) -> DataFrame:
    """The rows in blocks of about equal size along (keys, order), written to the shared scratch folder.

    Adds ``_part``, the number of the block, ``_value``, and ``_inside``, the running sum of the value over a key's rows in its block.
    Blocks are cut by range, from the counted number of rows, so a key with many rows fills several of them and no
    block grows with a key. A block is one sorted partition; its running sums take one pass in Arrow batches.
    """
    n = df.count()
    blocks = max(1, -(-n // max(MIN_BLOCK_ROWS, isqrt(n))))
    places = [*keys, *[c for c in order if c not in keys]]
    ranged = df.withColumn("_value", value.cast("bigint")).repartitionByRange(blocks, *places).sortWithinPartitions(*places)
    names = ranged.columns
    schema = StructType([*ranged.schema.fields, StructField("_part", IntegerType()), StructField("_inside", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, total = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(names.index(k)) for k in keys]
            starts = np.zeros(batch.num_rows, bool)
            for column in columns:
                here, there = column.slice(1), column.slice(0, batch.num_rows - 1)
                differ = pc.fill_null(pc.not_equal(here, there), pc.xor(pc.is_null(here), pc.is_null(there)))
                starts[1:] |= differ.to_numpy(zero_copy_only=False)
            first = [c[0].as_py() for c in columns]
            starts[0] = last is None or first != last
            values = pc.fill_null(batch.column(names.index("_value")), 0).to_numpy(zero_copy_only=False)
            sums = np.cumsum(values) + (0 if starts[0] else total)
            # A key that starts in this batch counts from its own first row.
            at = np.flatnonzero(starts)
            base = np.zeros(len(sums), np.int64)
            if at.size:
                base[at] = np.diff(np.concatenate(([0], sums[at] - values[at])))
            sums = sums - np.cumsum(base)
            last, total = [c[batch.num_rows - 1].as_py() for c in columns], int(sums[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(sums), part, np.int32)), pa.array(sums)], [*names, "_part", "_inside"])

    path = scratch_path(df.sparkSession, "blocks")
    ranged.mapInArrow(run, schema).write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Running sum of a whole-numbered ``value`` per key along ``order``, which must tell the rows of a key apart.

    Two levels: sums inside range blocks, then sums of whole blocks. Only a key that reaches from one block into another
    has sums to add, so there are no more of them than blocks, and they are broadcast. No task sorts or
    sums a whole key. Null keys form a group, null values count as 0.
    """
    blocked = range_blocks(df, keys, order, value)
    sums = blocked.groupBy(*keys, "_part").agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.withColumn("_before", F.sum("_sum").over(before)).where("_before <> 0").select(
        "_before", F.col("_part").alias("_of_part"), *[F.col(k).alias(f"_of_{k}") for k in keys]
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys], F.col("_part") == F.col("_of_part"))
    total = F.col("_inside") + F.coalesce("_before", F.lit(0))
    return blocked.join(F.broadcast(carried), same, "left").select(*df.columns, total.alias(name))


def batch_numbers(df: DataFrame, key: str, order: Sequence[str], size: int, name: str = "batch") -> DataFrame:
    """0-based number of the fixed-size batch a row falls into, per key."""
    counted = running_total(df, [key], order, F.lit(1), "_number")
    return counted.withColumn(name, F.floor((F.col("_number") - 1) / size)).drop("_number")


def sample_rows(df: DataFrame, key: str, seed: str, size: int) -> DataFrame:
    """``size`` rows without replacement, the same ones for the same seed.

    Rows are ranked by a seeded digest of their key, which Spark does as a top-k per task.
    """
    digest = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))
    return df.orderBy(digest, F.col(key)).limit(size)


def page(df: DataFrame, order: Sequence[Column], offset: int, size: int) -> DataFrame:
    """``size`` rows after the first ``offset``, in the given order."""
    return df.orderBy(*order).offset(offset).limit(size)


def counts_by_source(df: DataFrame, source: str) -> DataFrame:
    """Rows per source, and a row with a null source for the total and the number of sources.

    Rows without a source count in the total only. Rows are counted once per source; only the counts are rolled up.
    """
    counted = df.groupBy(source).agg(F.count(F.lit(1)).alias("_n"))
    rolled = counted.rollup(source).agg(
        F.sum("_n").alias("n_rows"), F.count(source).alias("n_sources"), F.grouping(source).alias("_total")
    )
    return rolled.where((F.col("_total") == 1) | F.col(source).isNotNull()).drop("_total")
