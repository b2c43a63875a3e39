"""Projections: constants, alignment, spellings, defaults, events, warehouse rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpoint.operators.validate import Checked, check
from touchpoint.schemas import MENTION_SPELLINGS, column_names, struct_type, table_columns

ISO_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ssXXX"}


def with_constants(df: DataFrame, model: str, constants: dict[str, Column]) -> DataFrame:
    """Add or replace columns, which must be fields of the model."""
    unknown = set(constants) - set(column_names(model))
    if unknown:
        raise ValueError(f"not fields of the model: {sorted(unknown)}")
    return df.withColumns(constants)


def align_schema(df: DataFrame, model: str) -> DataFrame:
    """The model's columns in order: absent ones null, others dropped."""
    present = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f'`{f.name}`' if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in struct_type(model).fields
        ]
    )


def resolve_spellings(df: DataFrame, spellings: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Rename columns to their field names; of several accepted spellings the first present counts."""
    chosen = []
    for field, names in (spellings or MENTION_SPELLINGS).items():
        present = [n for n in names if n in df.columns]
        if present:
            chosen.append(F.col(f"`{present[0]}`").alias(field))
    return df.select(*chosen)


def spelled_fields(df: DataFrame, payload: str, spellings: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Fields of a JSON object column by their accepted spellings, as strings; other columns are kept.

    The object is parsed once. Of several spellings the first one with a value counts: an earlier
    spelling that is there but null is passed over.
    """
    kept = [c for c in df.columns if c != payload]
    parsed = df.withColumn("_fields", F.from_json(payload, "map<string,string>"))
    chosen = [
        f"coalesce({', '.join(f"try_element_at(_fields, '{n}')" for n in names)}) AS `{field}`"
        for field, names in (spellings or MENTION_SPELLINGS).items()
    ]
    return parsed.selectExpr(*[f"`{c}`" for c in kept], *chosen)


def mention_defaults(df: DataFrame) -> DataFrame:
    """A mention without ``bookmarked`` is not bookmarked."""
    given = F.col("bookmarked").try_cast("boolean") if "bookmarked" in df.columns else F.lit(None).cast("boolean")
    return df.withColumn("bookmarked", F.coalesce(given, F.lit(False)))


def event_defaults(df: DataFrame) -> DataFrame:
    """An event without an action is a newly created mention."""
    given = F.col("action") if "action" in df.columns else F.lit(None).cast("string")
    return df.withColumn("action", F.coalesce(given, F.lit("mention_created")))


def wrap_event(df: DataFrame, action: str = "mention_created") -> DataFrame:
    """Rows as ``{action, data}`` events."""
    return df.select(F.lit(action).alias("action"), F.struct("*").alias("data"))


def unwrap_event(events: DataFrame) -> DataFrame:
    return events.select("data.*")


def json_line(df: DataFrame) -> Column:
    """A row as one JSON line, nulls and zones printed."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), ISO_JSON)


def warehouse_rows(df: DataFrame, table: dict[str, tuple[str, bool]]) -> DataFrame:
    """Rows cast to a warehouse table."""
    return df.selectExpr(*table_columns(df, table))


def receipts_of(transactions: DataFrame) -> Checked:
    """Receipt of each transaction: same id, time and user, body from the description.

    A transaction whose id, time or user does not cast, or without a description, is a reject that names the columns.
    """
    receipts = {
        "id": F.col("id").try_cast("bigint"),
        "at": F.col("at").try_cast("timestamp"),
        "user_id": F.col("user_id").try_cast("bigint"),
        "description": F.concat(F.lit("Transaction: "), F.col("description")),
    }
    checked = check(transactions, [(value.isNotNull(), name) for name, value in receipts.items()])
    columns = [value.alias("body" if name == "description" else name) for name, value in receipts.items()]
    return checked.then(lambda valid: valid.select(*columns))
