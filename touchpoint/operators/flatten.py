"""Nested records → flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType, TimestampType

from touchpoint.functions.calls import message_key
from touchpoint.functions.dates import iso


def flatten_structs(df: DataFrame, sep: str = "_") -> DataFrame:
    """Struct fields, at any depth, as columns named by their path."""
    def leaves(kind: DataType, path: list[str]) -> list[Column]:
        if isinstance(kind, StructType):
            return [leaf for f in kind.fields for leaf in leaves(f.dataType, [*path, f.name])]
        quoted = ".".join(f"`{p}`" for p in path)
        return [F.col(quoted).alias(sep.join(path))]

    return df.select(*[leaf for f in df.schema.fields for leaf in leaves(f.dataType, [f.name])])


def explode_lists(df: DataFrame, lists: list[str], number: str) -> DataFrame:
    """One row per combination of the elements of the lists, first list outermost.

    A null or empty list counts as one null element. ``number`` is the 1-based place of the row in
    its record, computed from the element positions, so rows need no sorting or shuffle.
    """
    place: Column = F.lit(0)
    exploded = df
    for name in lists:
        exploded = exploded.withColumn("_size", F.greatest(F.coalesce(F.size(name), F.lit(0)), F.lit(1)))
        kept = [c for c in exploded.columns if c not in (name, "_size")]
        exploded = exploded.select(
            *kept, "_size", F.posexplode_outer(name).alias("_pos", f"_item_{name}")
        ).withColumnRenamed(f"_item_{name}", name)
        place = F.col("_place") if "_place" in exploded.columns else F.lit(0)
        exploded = exploded.withColumn("_place", place * F.col("_size") + F.coalesce("_pos", F.lit(0)))
        exploded = exploded.drop("_size", "_pos")
    return exploded.withColumn(number, F.col("_place") + 1).drop("_place")


def keyed_rows(df: DataFrame, recording: Column, number: str) -> DataFrame:
    """Add ``id`` from recording id and row number; an existing ``recording_id`` is kept."""
    known = F.coalesce("recording_id", recording) if "recording_id" in df.columns else recording
    return df.withColumn("recording_id", known).withColumn("id", message_key(recording, F.col(number)))


def drop_large(df: DataFrame, names: list[str]) -> tuple[DataFrame, int]:
    """Frame without the named columns, and how many of them it had."""
    present = [n for n in names if n in df.columns]
    return df.drop(*[F.col(f"`{n}`") for n in present]), len(present)


def drop_json_keys(payload: Column, names: list[str]) -> tuple[Column, Column]:
    """JSON object without the named keys, and how many of them it had. Other values keep their type and shape."""
    fields = F.from_json(payload, "map<string,variant>")
    kept = F.map_filter(fields, lambda key, _: ~key.isin(*names))
    removed = F.size(F.map_keys(fields)) - F.size(F.map_keys(kept))
    return F.to_json(kept, {"ignoreNullFields": "false"}), removed


def iso_datetimes(df: DataFrame) -> DataFrame:
    """Timestamps at any depth as ISO-8601 strings; every other value unchanged."""
    def convert(value: Column, kind: DataType) -> Column:
        if isinstance(kind, TimestampType):
            return iso(value)
        if isinstance(kind, ArrayType) and holds_time(kind.elementType):
            return F.transform(value, lambda item: convert(item, kind.elementType))
        if isinstance(kind, StructType) and holds_time(kind):
            fields = [convert(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
            return F.when(value.isNotNull(), F.struct(*fields))
        return value

    def holds_time(kind: DataType) -> bool:
        if isinstance(kind, ArrayType):
            return holds_time(kind.elementType)
        if isinstance(kind, StructType):
            return any(holds_time(f.dataType) for f in kind.fields)
        return isinstance(kind, TimestampType)

    return df.select(*[convert(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
